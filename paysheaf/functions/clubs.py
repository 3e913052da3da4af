"""Club dimension and token -> club lookups (longest known prefix, code, verbatim).

The dimension is a DataFrame ``club_dim(kind, key, canonical)``: ``kind='code'`` rows map an
upper-case code to a display name, ``kind='name'`` rows map a lower-case full name. It is
small by nature (one row per club and code), so it is read once and becomes one literal map
of the parsing stage — no join and no shuffle per token row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CLUB_DIM

# --- fixed values: the league's club codes and club names --------------------------------
# Code -> display name.
CLUB_CODES = {
    "ATL": "Atlanta United",
    "ATX": "Austin FC",
    "CHI": "Chicago Fire",
    "CHV": "Chivas USA",
    "CIN": "FC Cincinnati",
    "CLB": "Columbus Crew",
    "COL": "Colorado Rapids",
    "DAL": "FC Dallas",
    "DC": "DC United",
    "HOU": "Houston Dynamo",
    "KC": "Sporting Kansas City",
    "LA": "LA Galaxy",
    "LAFC": "Los Angeles FC",
    "MIA": "Inter Miami",
    "MIN": "Minnesota United",
    "MTL": "CF Montreal",
    "NE": "New England Revolution",
    "NSH": "Nashville SC",
    "NY": "New York Red Bulls",
    "NYC": "New York City FC",
    "ORL": "Orlando City",
    "PHI": "Philadelphia Union",
    "POR": "Portland Timbers",
    "RSL": "Real Salt Lake",
    "SEA": "Seattle Sounders",
    "SJ": "San Jose Earthquakes",
    "SKC": "Sporting Kansas City",
    "TFC": "Toronto FC",
    "VAN": "Vancouver Whitecaps",
}
# Lower-case full name -> display name.
CLUB_NAMES = {
    "atlanta united": "Atlanta United",
    "austin fc": "Austin FC",
    "cf montreal": "CF Montréal",
    "chicago fire": "Chicago Fire",
    "chivas usa": "Chivas USA",
    "colorado rapids": "Colorado Rapids",
    "columbus crew": "Columbus Crew",
    "dc united": "D.C. United",
    "fc cincinnati": "FC Cincinnati",
    "fc dallas": "FC Dallas",
    "houston dynamo": "Houston Dynamo",
    "inter miami": "Inter Miami CF",
    "la galaxy": "LA Galaxy",
    "los angeles fc": "Los Angeles FC",
    "minnesota united": "Minnesota United",
    "nashville sc": "Nashville SC",
    "new england revolution": "New England Revolution",
    "new york city fc": "New York City FC",
    "new york red bulls": "New York Red Bulls",
    "orlando city": "Orlando City SC",
    "philadelphia union": "Philadelphia Union",
    "portland timbers": "Portland Timbers",
    "real salt lake": "Real Salt Lake",
    "san jose earthquakes": "San Jose Earthquakes",
    "seattle sounders": "Seattle Sounders FC",
    "sporting kansas city": "Sporting Kansas City",
    "toronto fc": "Toronto FC",
    "vancouver whitecaps": "Vancouver Whitecaps FC",
}
# Words that start a club in names-first rows, as the original lookup lists them
# (used only in compat mode; otherwise the first words are derived from the dimension).
CLUB_FIRST_WORDS_COMPAT = (
    "atlanta", "austin", "chicago", "colorado", "columbus", "dc", "fc", "houston", "inter",
    "la", "los", "minnesota", "nashville", "new", "orlando", "philadelphia", "portland",
    "real", "san", "seattle", "sporting", "toronto", "vancouver",
)
# ------------------------------------------------------------------------------------------


def reference_club_dim(spark: SparkSession) -> DataFrame:
    """The league's club dimension built from the fixed tables above, with one display name per
    club: a code whose club is also listed by name gets that name's spelling."""
    rows = ([("code", k, CLUB_NAMES.get(v.lower(), v)) for k, v in CLUB_CODES.items()]
            + [("name", k, v) for k, v in CLUB_NAMES.items()])
    return spark.createDataFrame(rows, CLUB_DIM)


@dataclass(frozen=True)
class ClubLookup:
    codes: dict[str, str]
    names: dict[str, str]
    first_words: tuple[str, ...]
    max_words: int

    @staticmethod
    def from_dim(club_dim: DataFrame, first_words: tuple[str, ...] | None = None) -> "ClubLookup":
        rows = club_dim.select("kind", "key", "canonical").collect()
        codes = {r["key"].upper(): r["canonical"] for r in rows if r["kind"] == "code"}
        names = {r["key"].lower(): r["canonical"] for r in rows if r["kind"] == "name"}
        if first_words is None:
            first_words = tuple(sorted({k.split()[0] for k in names if k.split()}))
        max_words = max([len(k.split()) for k in names] + [1])
        return ClubLookup(codes, names, tuple(first_words), max_words)

    def _map(self, d: dict[str, str]) -> Column:
        # One literal, whatever the number of clubs: the plan does not grow with the dimension.
        return F.from_json(F.lit(json.dumps(d)), "map<string,string>")

    def code_map(self) -> Column:
        return self._map(self.codes)

    def name_map(self) -> Column:
        return self._map(self.names)

    def starts_club(self, t: Column) -> Column:
        """Token is a club code or the first word of a club name."""
        words = F.from_json(F.lit(json.dumps(self.first_words)), "array<string>")
        return (F.map_contains_key(self.code_map(), F.upper(t))
                | F.array_contains(words, F.lower(t)))


def club_parts(tokens: Column, lookup: ClubLookup, compat: bool = False) -> tuple[Column, Column]:
    """Leading club of a token list -> (club, consumed) as two scalar columns.

    Tries the longest known full name first (up to ``max_words`` tokens, case-insensitive),
    then a code on the first token, else the first token verbatim (1 consumed); an empty
    list gives ('', 0). ``compat`` tries the code before the names, which reads
    'LA Galaxy' as code 'LA' followed by a name token.
    """
    n = F.size(tokens)
    names, codes = lookup.name_map(), lookup.code_map()
    name_hits = []
    for k in range(lookup.max_words, 0, -1):
        cand = F.lower(F.array_join(F.slice(tokens, 1, k), " "))
        name_hits.append((F.when(n >= k, F.try_element_at(names, cand)), k))
    code_hit = (F.try_element_at(codes, F.upper(F.get(tokens, 0))), 1)
    order = [code_hit] + name_hits if compat else name_hits[:-1] + [code_hit, name_hits[-1]]
    club = F.coalesce(*[h for h, _ in order], F.get(tokens, 0))
    consumed = F.lit(1)
    for h, k in reversed(order):
        consumed = F.when(h.isNotNull(), F.lit(k)).otherwise(consumed)
    empty = n == 0
    return (F.when(empty, F.lit("")).otherwise(club),
            F.when(empty, F.lit(0)).otherwise(consumed))


def club_from_tokens(tokens: Column, lookup: ClubLookup, compat: bool = False) -> Column:
    """``club_parts`` as struct(club, consumed)."""
    club, consumed = club_parts(tokens, lookup, compat)
    return F.struct(club.alias("club"), consumed.alias("consumed"))


def club_start(tokens: Column, lookup: ClubLookup) -> Column:
    """0-based index of the first token that starts a club, -1 when none does."""
    return F.array_position(F.transform(tokens, lookup.starts_club), True).cast("int") - 1
