"""Header-row search and column map of salary documents.

``find_headers`` keeps only rows that score as a header, then takes the first such row
per source with ``min_by`` — a partial (map-side) aggregate, so a source with millions
of rows sends one candidate per map task, and the result has one small row per source.
The column map is computed with array expressions on that row, no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

# --- fixed values: header vocabulary ---------------------------------------------------
# Words whose presence (as substrings of the lower-cased joined row) marks a header row.
HEADER_KEYWORDS = ("club", "team", "last", "first", "name", "salary", "position", "pos",
                   "base", "guaranteed", "comp", "compensation")
# Words that mark a title or metadata row.
EXCLUDE_KEYWORDS = ("mls", "player", "salaries", "alphabetical", "guide", "list", "as", "of",
                    "fall", "winter", "spring", "summer", "source")
# A row with at least STRONG_SCORE header words is a header; with at least WEAK_SCORE
# only when no exclude word occurs.
STRONG_SCORE = 5
WEAK_SCORE = 3
# Header cell texts per field.
CLUB_CELLS = ("club", "team", "team name")
LAST_CELLS = ("last", "last name")
FIRST_CELLS = ("first", "first name")
POSITION_CELLS = ("pos", "position")
COMP_CELLS = ("compensation", "comp", "comp.")
# ------------------------------------------------------------------------------------------

FIELDS = ("club", "last_name", "first_name", "position", "base_salary", "guaranteed_comp")


def _count_in(text: Column, words: tuple[str, ...]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda k: F.contains(text, k)))


def header_score(tokens: Column) -> Column:
    """struct(score, excludes, is_header) of one row."""
    text = F.lower(F.array_join(tokens, " "))
    score = _count_in(text, HEADER_KEYWORDS)
    excl = _count_in(text, EXCLUDE_KEYWORDS)
    ok = (F.size(tokens) > 0) & ((score >= STRONG_SCORE) | ((score >= WEAK_SCORE) & (excl == 0)))
    return F.struct(score.alias("score"), excl.alias("excludes"), ok.alias("is_header"))


def find_headers(raw_rows: DataFrame) -> DataFrame:
    """(source_id, header_row_no, header) — the first header-like row of each source."""
    cand = raw_rows.filter(header_score(F.col("tokens"))["is_header"])
    return cand.groupBy("source_id").agg(
        F.min("row_no").alias("header_row_no"),
        F.min_by("tokens", "row_no").alias("header"))


def _positions(header: Column, pred) -> Column:
    idx = F.transform(header, lambda h, i: F.when(pred(F.lower(strip(h))), i))
    return F.filter(idx, lambda i: i.isNotNull())


def column_map(header: Column) -> Column:
    """struct of 0-based indexes (NULL when unmapped) for the six fields.

    The last matching cell wins; bare 'compensation'/'comp'/'comp.' cells only fill
    ``guaranteed_comp`` when no 'guaranteed' cell exists, and then the first of them wins.
    """
    def last(pred) -> Column:
        return F.array_max(_positions(header, pred))

    def isin(words):
        return lambda h: h.isin(*words)

    # Each cell maps to one field: the first rule that matches it.
    def rule(name: str):
        rules = [
            ("club", isin(CLUB_CELLS)),
            ("last_name", isin(LAST_CELLS)),
            ("first_name", isin(FIRST_CELLS)),
            ("position", isin(POSITION_CELLS)),
            ("base_salary", lambda h: (h.contains("base") & h.contains("salary")) | (h == "base")),
            ("guaranteed_comp", lambda h: h.contains("guaranteed")),
            ("comp_weak", isin(COMP_CELLS)),
        ]
        names = [r[0] for r in rules]
        k = names.index(name)

        def pred(h):
            cond = rules[k][1](h)
            for _, earlier in rules[:k]:
                cond = cond & ~earlier(h)
            return cond
        return pred

    strong_guar = last(rule("guaranteed_comp"))
    weak_guar = F.array_min(_positions(header, rule("comp_weak")))
    return F.struct(
        last(rule("club")).alias("club"),
        last(rule("last_name")).alias("last_name"),
        last(rule("first_name")).alias("first_name"),
        last(rule("position")).alias("position"),
        last(rule("base_salary")).alias("base_salary"),
        F.coalesce(strong_guar, weak_guar).alias("guaranteed_comp"),
    )


def club_first(cmap: Column) -> Column:
    """Club column before the name columns (defaults: club 0, names 1)."""
    club_idx = F.coalesce(cmap["club"], F.lit(0))
    name_idx = F.coalesce(cmap["last_name"], cmap["first_name"], F.lit(1))
    return club_idx < name_idx


def header_table(raw_rows: DataFrame) -> DataFrame:
    """(source_id, header_row_no, header, cmap, club_first, last_first) per source."""
    h = find_headers(raw_rows)
    cmap = column_map(F.col("header"))
    h = h.withColumn("cmap", cmap)
    both = F.col("cmap.last_name").isNotNull() & F.col("cmap.first_name").isNotNull()
    return h.select(
        "source_id", "header_row_no", "header", "cmap",
        club_first(F.col("cmap")).alias("club_first"),
        F.when(both, F.col("cmap.last_name") < F.col("cmap.first_name"))
         .otherwise(F.lit(True)).alias("last_first"),
    )
