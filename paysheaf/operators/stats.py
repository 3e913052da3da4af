"""Player statistics tables -> long stats records, profile enrichment and flattening.

* ``stats_rows``: first table of a stats page; headers keyed by CSS class; body rows with
  at least three cells and a player link; a cell's first non-framework class is its key;
  'player' and 'club' cells are left out; keys get the stat-type prefix.
* ``stats_normalize``: key normalisation, value cleaning, defaults.
* ``enrich_left``: stats ⟕ profiles on the player URL, one profile per URL (first fetched).
* ``flatten_map``: open maps -> sorted wide columns with a prefix.

Maps are built from (key, value) entry arrays after keeping the **last** entry of each
key, so duplicate keys behave like Python dict assignment instead of raising.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, collapse_ws, let, normalize_key, strip_or_null
from ..schemas import STATS_BASE_FIELDS
from .rosters import absolute_url, first_per_key

# --- fixed values: framework classes that never name a column -----------------------------
HEADER_FRAMEWORK_CLASSES = ("mls-o-table__header", "mls-o-table__header--sorted", "stats-type")
CELL_FRAMEWORK_CLASSES = ("mls-o-table__cell", "mls-o-table__cell--sorted")
NON_STAT_KEYS = ("player", "club")
MIN_CELLS = 3
# ---------------------------------------------------------------------------------------------


def first_class(classes: Column, skip: tuple[str, ...]) -> Column:
    """First class of a space-separated class attribute that is not in ``skip`` (NULL when
    there is none): one regular expression, the skipped names as a negative lookahead."""
    import re
    skipped = "|".join(re.escape(c) for c in skip)
    pat = r"(?:^|\s)(?!(?:" + skipped + r")(?:\s|$))(\S+)"
    return F.nullif(F.regexp_extract(F.coalesce(classes, F.lit("")), pat, 1), F.lit(""))


def last_wins_map(entries: Column) -> Column:
    """array<struct(k, v)> -> map, a later entry replacing an earlier one with the same key."""
    def last(es: Column) -> Column:
        n = F.size(es)
        kept = F.filter(es, lambda e, i: e["k"].isNotNull() & ~F.exists(
            F.slice(es, i + 2, F.greatest(n - i - 1, F.lit(0))), lambda x: x["k"] == e["k"]))
        return F.map_from_entries(kept)

    return let(entries, last)


PAGE_FIELDS = ("team_name", "team_slug", "season", "stat_type")


def stats_rows(rows: DataFrame, pages: DataFrame | None, base_url: str, key: str = "page_id") -> DataFrame:
    """rows: ``html_tables.table_rows`` of stats pages; pages: (key, team_name, team_slug,
    season, stat_type), or None when ``rows`` carries those columns. Returns raw stats rows: team_name, team_slug, season, stat_type,
    player_name, player_url, player_image, club, stats MAP<STRING,STRING>."""
    header_keys = F.filter(F.transform("header_classes", lambda c: first_class(c, HEADER_FRAMEWORK_CLASSES)),
                           lambda k: k.isNotNull())
    body = F.when(F.col("has_tbody"), F.col("in_tbody")).otherwise(F.col("row_no") >= 2)
    r = rows.filter((F.col("table_no") == 0) & (F.size(header_keys) > 0) & body
                    & (F.size("cells") >= MIN_CELLS)
                    & F.coalesce(F.col("link_href").contains("/players/"), F.lit(False)))
    if pages is not None:
        r = r.join(pages.select(key, *PAGE_FIELDS), key)
    pairs = F.arrays_zip(F.transform("cell_classes", lambda c: first_class(c, CELL_FRAMEWORK_CLASSES)).alias("k"),
                         F.col("cells").alias("v"))
    stat_pairs = F.filter(pairs, lambda e: e["k"].isNotNull() & ~e["k"].isin(*NON_STAT_KEYS))
    entries = F.transform(stat_pairs, lambda e: F.struct(
        F.concat(F.col("stat_type"), F.lit("_"), e["k"]).alias("k"),
        F.nullif(e["v"], F.lit("")).alias("v")))
    club = F.get(F.filter(F.arrays_zip(F.col("cell_classes").alias("c"), F.col("cells").alias("t")),
                          lambda e: F.array_contains(F.split(F.coalesce(e["c"], F.lit("")), r"\s+"), "club")),
                 0)["t"]
    return r.select(
        "team_name", "team_slug", "season", "stat_type",
        F.coalesce("name_text", "link_text").alias("player_name"),
        absolute_url(F.col("link_href"), base_url).alias("player_url"),
        F.col("thumb").alias("player_image"),
        club.alias("club"),
        last_wins_map(entries).alias("stats"),
        key, "row_no")


def one_profile_per_url(profiles: DataFrame, order: str = "fetch_order") -> DataFrame:
    """(player_url, profile): the first fetched profile of every URL."""
    return first_per_key(profiles.select("player_url", order, "profile"), ["player_url"], [order]) \
        .select("player_url", "profile")


def enrich_left(stats: DataFrame, profiles: DataFrame) -> DataFrame:
    """Stats rows ⟕ one profile per URL (``profile_details``; empty map when none).

    The profile side has one row per URL, so the join never multiplies stats rows."""
    one = one_profile_per_url(profiles).withColumnRenamed("profile", "profile_details")
    out = stats.join(one, "player_url", "left")
    return out.withColumn("profile_details", F.coalesce("profile_details",
                                                        F.create_map().cast("map<string,string>")))


def profile_entries(details: Column, image: Column) -> Column:
    """Profile map of a record: cleaned details, and the row's image as ``player_image_thumb``."""
    prof = F.coalesce(details, F.create_map().cast("map<string,string>"))
    entries = F.transform(F.map_entries(prof), lambda e: F.struct(
        e["key"].alias("k"), blank_to_null(e["value"]).alias("v")))
    img = F.when(F.coalesce(image, F.lit("")) != "",
                 F.array(F.struct(F.lit("player_image_thumb").alias("k"), image.alias("v"))))\
        .otherwise(F.array().cast("array<struct<k:string,v:string>>"))
    return last_wins_map(F.concat(entries, img))


def page_profiles(facts: DataFrame) -> DataFrame:
    """Profile facts of captured pages -> (player_url, fetch_order, profile): the detail items with the
    masthead's large image, full name and club logo, where the page has them; a detail item of the same
    name wins. Feeds ``enrich_left``."""
    masthead = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in (
        ("player_image_large", "player_image"), ("full_name", "full_name"), ("team_logo", "team_logo"))]),
        lambda e: e["v"].isNotNull())
    items = F.transform(F.map_entries("profile"), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")))
    return facts.select("player_url", F.col("page_id").alias("fetch_order"), last_wins_map(F.concat(masthead, items)).alias("profile"))


def stats_normalize(raw: DataFrame) -> DataFrame:
    """Raw stats rows -> player-stats records (7 base fields + ``stats`` + ``profile``).

    Stat keys are normalised (lower case, no punctuation, '_' for spaces; colliding keys:
    the later one wins), values stripped with blank -> NULL; profile values cleaned, the
    row image added as ``player_image_thumb``; missing club -> '', season -> 0; rows with
    a blank name dropped."""
    stats = F.coalesce(F.col("stats"), F.create_map().cast("map<string,string>"))
    entries = F.transform(F.map_entries(stats), lambda e: F.struct(
        normalize_key(e["key"]).alias("k"), strip_or_null(e["value"]).alias("v")))
    out = raw.select(
        F.coalesce("team_name", F.lit("")).alias("team_name"),
        F.coalesce("team_slug", F.lit("")).alias("team_slug"),
        F.coalesce("season", F.lit(0)).alias("season"),
        F.coalesce("stat_type", F.lit("")).alias("stat_type"),
        collapse_ws(F.col("player_name")).alias("player_name"),
        F.coalesce("player_url", F.lit("")).alias("player_url"),
        F.coalesce("club", F.lit("")).alias("club"),
        last_wins_map(entries).alias("stats"),
        profile_entries(F.col("profile_details"), F.col("player_image")).alias("profile"))
    return out.filter(F.col("player_name") != "")


def map_keys_of(df: DataFrame, columns: list[str] | str) -> dict[str, list[str]]:
    """Sorted distinct keys of one or more map columns, found in one distributed distinct. They
    become column names, so they are read to the driver; where they are known, give them instead."""
    cols = [columns] if isinstance(columns, str) else list(columns)

    def tag(name: str):
        return lambda k: F.struct(F.lit(name).alias("c"), k.alias("k"))
    tagged = F.concat(*[F.transform(F.map_keys(c), tag(c)) for c in cols])
    found = df.select(F.explode(tagged).alias("e")).select("e.c", "e.k").distinct().collect()
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in found:
        out[r["c"]].append(r["k"])
    return {c: sorted(ks) for c, ks in out.items()}


def flatten_map(df: DataFrame, column: str, prefix: str, keys: list[str] | None = None) -> DataFrame:
    """Replace a map column by one column per key (``prefix + key``), keys sorted."""
    keys = map_keys_of(df, column)[column] if keys is None else sorted(keys)
    others = [c for c in df.columns if c != column]
    return df.select(*others, *[F.col(column).getItem(k).alias(prefix + k) for k in keys])


def flatten_stats(records: DataFrame, keys: dict[str, list[str]] | None = None) -> DataFrame:
    """Player-stats records -> 7 base columns + sorted ``stat_*`` + sorted ``profile_*``
    (keys of both maps found in one pass unless given)."""
    d = records.select(*STATS_BASE_FIELDS, "stats", "profile")
    keys = map_keys_of(d, ["stats", "profile"]) if keys is None else keys
    flat = flatten_map(d, "stats", "stat_", keys["stats"])
    return flatten_map(flat, "profile", "profile_", keys["profile"])


def union_by_type(records: DataFrame) -> DataFrame:
    """Records flattened per stat type, each type with its own columns, unioned by name (missing
    columns NULL). Every stat type that occurs is a part, whatever its name and keys."""
    # Distinct (type, map, key) rows: no task holds the keys of a type, only the driver that names columns after them.
    def keys_of(c: str) -> Column:
        named = F.coalesce(c, F.create_map().cast("map<string,string>"))
        return F.transform(F.map_keys(named), lambda k: F.struct(F.lit(c).alias("map"), k.alias("key")))

    each = F.explode_outer(F.concat(keys_of("stats"), keys_of("profile")))
    pairs = records.select("stat_type", each.alias("e")).select("stat_type", "e.map", "e.key").distinct()
    found: dict = {}
    for r in pairs.orderBy("stat_type", "map", "key").collect():
        keys = found.setdefault(r["stat_type"], {"stats": [], "profile": []})
        if r["map"] is not None:
            keys[r["map"]].append(r["key"])
    parts = [flatten_stats(records.filter(F.col("stat_type").eqNullSafe(F.lit(t))), keys) for t, keys in found.items()]
    if not parts:
        return flatten_stats(records, {"stats": [], "profile": []})
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
