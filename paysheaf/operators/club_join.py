"""Club lookup as joins: the club of a token list, for dimensions of any size.

``ClubLookup`` holds the dimension as literals, which suits the clubs of a league. Here nothing of the
dimension reaches the driver but the different numbers of words of its names: every leading run of tokens
is an equality join against the names of as many words, codes are one more, and the longest hit wins. A side
is broadcast only below a row and a byte bound; beyond it Spark shuffles, and AQE splits hot prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse_ws
from ..session import cut_lineage, sized_broadcast

MAX_BROADCAST_CLUBS = 200_000


def club_keys(club_dim: DataFrame) -> DataFrame:
    """(kind, key, words, canonical): one row per key, names in lower case with single blanks, codes in upper
    case. A key listed twice takes its largest name; blank keys are no keys."""
    key = F.when(F.col("kind") == "code", F.upper(collapse_ws("key"))).otherwise(F.lower(collapse_ws("key")))
    keyed = club_dim.select("kind", key.alias("key"), "canonical").filter("key <> '' AND kind IN ('code', 'name')")
    words = F.when(F.col("kind") == "name", F.size(F.split("key", " "))).otherwise(F.lit(0))
    return keyed.groupBy("kind", "key").agg(F.max("canonical").alias("canonical")).select("kind", "key", words.alias("words"), "canonical")


def match_clubs(rows: DataFrame, tokens: str, club_dim: DataFrame, compat: bool = False,
                max_broadcast: int = MAX_BROADCAST_CLUBS) -> DataFrame:
    """``rows`` with club and consumed: the longest known name at the start of the tokens (several words first,
    then a code, then one word), else the first token; ('', 0) for no tokens. ``compat`` tries the code first.

    Every row stays once, whatever the dimension repeats. NULL tokens give NULL and 0."""
    keys = cut_lineage(club_keys(club_dim))
    counts = [r[0] for r in keys.filter("kind = 'name'").select("words").distinct().orderBy(F.desc("words")).collect()]
    t = F.col(tokens)
    low = F.transform(t, lambda x: F.lower(x))
    out, hits = rows, []

    def lookup(out: DataFrame, kind: str, words: int, key: Column) -> tuple[DataFrame, str]:
        name = f"_club_{kind}_{words}"
        side = keys.filter((F.col("kind") == kind) & (F.col("words") == words)).select(F.col("key").alias(f"{name}_key"), F.col("canonical").alias(name))
        side = sized_broadcast(side, max_broadcast)
        return out.join(side, key == F.col(f"{name}_key"), "left").drop(f"{name}_key"), name

    for k in counts:
        prefix = F.when(F.size(t) >= k, F.array_join(F.slice(low, 1, k), " "))
        out, name = lookup(out, "name", k, prefix)
        hits.append((name, k))
    out, code = lookup(out, "code", 0, F.upper(F.get(t, 0)))
    several, single = [h for h in hits if h[1] > 1], [h for h in hits if h[1] == 1]
    order = [(code, 1), *hits] if compat else [*several, (code, 1), *single]
    club = F.coalesce(*[F.col(h) for h, _ in order], F.get(t, 0))
    consumed = F.lit(1)
    for h, k in reversed(order):
        consumed = F.when(F.col(h).isNotNull(), F.lit(k)).otherwise(consumed)
    empty = F.coalesce(F.size(t), F.lit(0)) <= 0
    return out.select(*rows.columns, F.when(F.size(t) == 0, F.lit("")).otherwise(club).alias("club"),
                      F.when(empty, F.lit(0)).otherwise(consumed).alias("consumed"))
