"""Data-quality checks over salary-record frames.

Each check is a lazy DataFrame. Scalars that other rows are compared against (the IQR
fences) are scalar subqueries, so no cross join and no driver round trip is needed.
``dq_report`` folds all checks into a long table ``(check, metric, value)`` with three
scans of the input: one for the fences, one for all counters, one for duplicate groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SALARY_FIELDS
from .analytics import dbl

SALARY = "guaranteed_comp"
IQR_FACTOR = 1.5
TOP_ROWS = 20

# Accented Latin letters folded to their base letter for the club-variant check
# (fixed values: Latin-1 and common Latin Extended-A letters).
ACCENTED = "àáâãäåāăąçćčďèéêëēėęěìíîïīįıñńňòóôõöøōőŕřśšşťùúûüūůűųýÿźżž"
UNACCENTED = "aaaaaaaaacccdeeeeeeeeiiiiiiinnnoooooooorrsssttuuuuuuuuyyzzz"
# Club words ignored when folding spellings (fixed values).
CLUB_NOISE_WORDS = ("fc", "sc", "cf")


def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


# --- D1 ---------------------------------------------------------------------------------

def _missing_counters(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.count_if(F.col(c).isNull()).alias(f"nulls__{c}"))
        empt = F.count_if(F.col(c) == "") if _is_string(df, c) else F.lit(0).cast("bigint")
        out.append(empt.alias(f"empties__{c}"))
    return out


def dq_missing(df: DataFrame, cols: Sequence[str] = tuple(SALARY_FIELDS)) -> DataFrame:
    """Per column: number of NULLs and of empty strings (0 for non-string columns)."""
    one = df.agg(*_missing_counters(df, cols))
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"nulls__{c}").alias("nulls"),
                              F.col(f"empties__{c}").alias("empties")) for c in cols])
    return one.select(F.inline(rows))


# --- D2 ---------------------------------------------------------------------------------

def snap(c: Column) -> Column:
    """Remove double noise from values that are exact at a few decimals."""
    return F.bround(c, 6)


def iqr_fences(df: DataFrame, column: str = SALARY) -> tuple[Column, Column]:
    """(lower, upper) fences as scalar subqueries: q1 - 1.5*iqr and q3 + 1.5*iqr."""
    from .quantiles import quantile_columns
    q = quantile_columns(df, column, {"q1": 0.25, "q3": 0.75})
    q1, q3 = F.col("q1"), F.col("q3")
    # One struct-valued scalar subquery for both fences (planned once, reused).
    fences = q.select(F.struct(snap(q1 - F.lit(IQR_FACTOR) * (q3 - q1)).alias("lo"),
                               snap(q3 + F.lit(IQR_FACTOR) * (q3 - q1)).alias("hi"))).scalar()
    return fences["lo"], fences["hi"]


def _outside(column: str, lower: Column, upper: Column) -> Column:
    v = dbl(column)
    return (v < lower) | (v > upper)


def dq_outliers(df: DataFrame, column: str = SALARY) -> DataFrame:
    """One row: fences, number of values strictly outside them, of zeros, of negatives."""
    lower, upper = iqr_fences(df, column)
    return df.agg(
        F.bround(lower, 2).alias("lower_bound"),
        F.bround(upper, 2).alias("upper_bound"),
        F.count_if(_outside(column, lower, upper)).alias("outlier_count"),
        F.count_if(F.col(column) == 0).alias("zero_salary_count"),
        F.count_if(F.col(column) < 0).alias("negative_salary_count"),
    )


def dq_outlier_rows(df: DataFrame, column: str = SALARY) -> DataFrame:
    """The records outside the fences."""
    lower, upper = iqr_fences(df, column)
    return df.filter(_outside(column, lower, upper))


# --- D3 ---------------------------------------------------------------------------------

def _missing_position() -> Column:
    return F.col("position").isNull() | (F.col("position") == "")


def dq_positions(df: DataFrame) -> DataFrame:
    """Missing positions (NULL or empty), their share in percent, distinct positions
    (NULL not counted, the empty string counted)."""
    return df.agg(
        F.count_if(_missing_position()).alias("missing_position_count"),
        (F.try_divide(F.count_if(_missing_position()), F.count(F.lit(1))) * F.lit(100.0))
        .alias("missing_position_pct"),
        F.count_distinct("position").alias("unique_positions"),
    )


def dq_position_top(df: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The n most frequent positions (ties by position)."""
    return (df.filter(F.col("position").isNotNull()).groupBy("position")
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "position").limit(n))


# --- D4 ---------------------------------------------------------------------------------

DUP_KEYS = ("year", "last_name", "first_name")


def duplicate_groups(df: DataFrame) -> DataFrame:
    keyed = df.filter(F.col("year").isNotNull() & F.col("last_name").isNotNull()
                      & F.col("first_name").isNotNull())
    return keyed.groupBy(*DUP_KEYS).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dq_duplicates(df: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The first n (year, last_name, first_name) groups with more than one record, in
    key order."""
    return duplicate_groups(df).orderBy(*DUP_KEYS).limit(n)


def dq_duplicate_count(df: DataFrame) -> DataFrame:
    return duplicate_groups(df).agg(F.count(F.lit(1)).alias("duplicate_count"))


# --- D5 ---------------------------------------------------------------------------------

def _complete(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def dq_summary(df: DataFrame, cols: Sequence[str] = tuple(SALARY_FIELDS)) -> DataFrame:
    """Records, complete records (no NULL in any column), completeness in percent (0 when
    empty), covered years (comma list), distinct years and clubs."""
    total = F.count(F.lit(1))
    complete = F.count_if(_complete(cols))
    return df.agg(
        total.alias("total_records"),
        complete.alias("complete_records"),
        F.coalesce(F.try_divide(complete, total) * F.lit(100.0), F.lit(0.0)).alias("completeness_pct"),
        F.array_join(F.sort_array(F.collect_set("year")), ",").alias("years_covered"),
        F.count_distinct("year").alias("year_count"),
        F.count_distinct("club").alias("club_count"),
    )


# --- D6 ---------------------------------------------------------------------------------

def dq_clubs(df: DataFrame) -> DataFrame:
    """Distinct clubs in sorted order with their record counts (NULL clubs are counted
    under a NULL key, not sorted among names)."""
    return df.groupBy("club").agg(F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_last("club"))


def fold_club(c: Column) -> Column:
    """Spelling-insensitive key: lower case, accents folded, punctuation removed,
    noise words (FC, SC, CF) dropped, whitespace collapsed."""
    s = F.translate(F.lower(c), ACCENTED, UNACCENTED)
    s = F.regexp_replace(s, r"(?U)[^\w\s]", "")
    s = F.regexp_replace(s, r"\b(" + "|".join(CLUB_NOISE_WORDS) + r")\b", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def dq_club_variants(df: DataFrame) -> DataFrame:
    """Folded club keys written in more than one way: (club_key, n_spellings, spellings).

    Spellings are deduplicated before grouping, so a group holds one row per distinct
    spelling, never one per record."""
    spell = (df.filter(F.col("club").isNotNull()).select(fold_club(F.col("club")).alias("club_key"),
                                                          "club").distinct())
    spell = spell.filter(F.col("club_key") != "")  # nothing but punctuation says nothing about the club
    return (spell.groupBy("club_key")
            .agg(F.count(F.lit(1)).alias("n_spellings"),
                 F.array_join(F.sort_array(F.collect_list("club")), " | ").alias("spellings"))
            .filter(F.col("n_spellings") > 1).orderBy("club_key"))


# --- D7 ---------------------------------------------------------------------------------

def dq_report(df: DataFrame, cols: Sequence[str] = tuple(SALARY_FIELDS),
              column: str = SALARY) -> DataFrame:
    """All checks as one long table (check, metric, value DOUBLE)."""
    lower, upper = iqr_fences(df, column)
    counts = {
        "total": F.count(F.lit(1)), "complete": F.count_if(_complete(cols)), "missing_pos": F.count_if(_missing_position()),
        "outlier": F.count_if(_outside(column, lower, upper)), "zero": F.count_if(F.col(column) == 0),
        "negative": F.count_if(F.col(column) < 0),
        **{f"null.{c}": F.count_if(F.col(c).isNull()) for c in cols},
        **{f"empty.{c}": F.count_if(F.col(c) == "") for c in cols if _is_string(df, c)},
    }
    # All counters once per (year, club, position); the distinct counts are then over that short frame.
    per = df.groupBy("year", "club", "position").agg(*[x.alias(f"n{i}") for i, x in enumerate(counts.values())])
    n = {k: F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i, k in enumerate(counts)}
    # The names of checks and metrics, here and in the parts added below.
    metrics: list[tuple[str, str, Column]] = [
        ("summary", "total_records", n["total"]),
        ("summary", "complete_records", n["complete"]),
        ("summary", "completeness_pct",
         F.coalesce(F.try_divide(n["complete"], n["total"]) * F.lit(100.0), F.lit(0.0))),
        ("summary", "year_count", F.count_distinct("year")),
        ("summary", "club_count", F.count_distinct("club")),
        ("salary_outliers", "lower_bound", F.bround(lower, 2)),
        ("salary_outliers", "upper_bound", F.bround(upper, 2)),
        ("salary_outliers", "outlier_count", n["outlier"]),
        ("salary_outliers", "zero_salary_count", n["zero"]),
        ("salary_outliers", "negative_salary_count", n["negative"]),
        ("invalid_positions", "missing_position_count", n["missing_pos"]),
        ("invalid_positions", "missing_position_pct", F.try_divide(n["missing_pos"], n["total"]) * F.lit(100.0)),
        ("invalid_positions", "unique_positions", F.count_distinct("position")),
    ]
    metrics += [("missing_values", f"null_values.{c}", n[f"null.{c}"]) for c in cols]
    metrics += [("missing_values", f"empty_strings.{c}", n[f"empty.{c}"]) for c in cols if f"empty.{c}" in n]
    counters = per.agg(*[m[2].cast("double").alias(f"m{i}") for i, m in enumerate(metrics)])
    long = counters.select(F.inline(F.array(*[
        F.struct(F.lit(chk).alias("check"), F.lit(name).alias("metric"), F.col(f"m{i}").alias("value"))
        for i, (chk, name, _) in enumerate(metrics)])))
    dups = dq_duplicate_count(df).select(
        F.lit("duplicate_players").alias("check"), F.lit("duplicate_count").alias("metric"),
        F.col("duplicate_count").cast("double").alias("value"))
    # The parts with a row per club or position: spellings of clubs, and the most frequent positions.
    clubs = df.filter(F.col("club").isNotNull()).select("club").distinct()
    unique = clubs.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("club_variations").alias("check"), F.lit("unique_clubs").alias("metric"), "value")
    variants = dq_club_variants(df).select(
        F.lit("club_variations").alias("check"), F.concat(F.lit("spellings."), "club_key").alias("metric"),
        F.col("n_spellings").cast("double").alias("value"))
    positions = (df.filter(F.col("position").isNotNull()).groupBy("position").agg(F.count(F.lit(1)).alias("n"))
                 .orderBy(F.desc("n"), "position").limit(TOP_ROWS))
    positions = positions.select(F.lit("invalid_positions").alias("check"),
                                 F.concat(F.lit("position_distribution."), "position").alias("metric"),
                                 F.col("n").cast("double").alias("value"))
    return long.unionByName(dups).unionByName(unique).unionByName(variants).unionByName(positions)
