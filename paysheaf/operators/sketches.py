"""Percentiles from stored sketches: the pay of each (year, club) is reduced once to a KLL sketch, written
beside the records, and any later question merges sketches instead of reading the records again.

A sketch holds about ``3 * k`` values at most, so the stored table grows with the groups, not with the records, and
a group holding a third of all records is reduced in every task before anything is shuffled. Sketches of
later records are appended as further rows of the same group; a question merges them like any others.

Defined results: records without pay are left out; records without a year or club form groups of their own
(null), which count where no filter names the column; an empty table has no groups and no answers; a group
answers exactly while it has at most ``k`` values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .analytics import PERCENTILE_PS

#: Accuracy of a sketch (8 to 65535).
K = 2000
GROUP = ("year", "club")


def rank_error(k: int = K) -> float:
    """Distance between the wanted and the true rank of an answer, as a share of the values, that 99 answers in
    100 stay within (fixed values, as published for KLL sketches)."""
    return 2.296 / k ** 0.9021


def pay_sketches(records: DataFrame, value: str = "guaranteed_comp", by: Sequence[str] = GROUP, k: int = K) -> DataFrame:
    """One row per group: the group's columns, n (values) and their sketch."""
    values = records.select(*by, F.col(value).cast("double").alias("value")).filter("value IS NOT NULL")
    return values.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch"))


def write_sketches(records: DataFrame, path: str, mode: str = "overwrite", value: str = "guaranteed_comp",
                   by: Sequence[str] = GROUP, k: int = K) -> str:
    """The records' sketches -> Parquet; 'append' adds those of further records."""
    pay_sketches(records, value, by, k).write.mode(mode).parquet(path)
    return path


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sketch_percentiles(sketches: DataFrame, by: Sequence[str] = (), ps: Sequence[float] = PERCENTILE_PS, k: int = K) -> DataFrame:
    """Rows (by..., p, n, value): the approximate percentiles of each group of ``by``, a part of the columns that the
    sketches were made by, or of all of them together. Filter the sketches first to ask about some groups only."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch")).filter("n > 0")
    wanted = F.array(*[F.lit(float(p)) for p in ps])
    values = F.kll_sketch_get_quantile_double("sketch", wanted)
    rows = merged.select(*by, "n", F.inline(F.arrays_zip(wanted.alias("p"), values.alias("value"))))
    return rows.select(*by, "p", "n", "value")


def rank_check(answers: DataFrame, records: DataFrame, by: Sequence[str], value: str = "guaranteed_comp", k: int = K) -> DataFrame:
    """Rows (by..., p, n, within_error): whether each answer's true rank among the records is within three times
    ``rank_error`` of the wanted one (and one record, for rounding)."""
    per = answers.groupBy(*by).agg(F.collect_list(F.struct("p", "value")).alias("answers"))
    values = records.select(*by, F.col(value).cast("double").alias("x")).filter("x IS NOT NULL")
    each = values.join(per, list(by)).select(*by, "x", F.inline("answers"))
    counts = each.groupBy(*by, "p").agg(F.expr("count_if(x < value)").alias("below"), F.expr("count_if(x <= value)").alias("upto"))
    off = 3 * rank_error(k) * F.col("n") + 1
    within = (F.col("below") <= F.col("p") * F.col("n") + off) & (F.col("upto") >= F.col("p") * F.col("n") - off)
    return answers.join(counts, [*by, "p"]).select(*by, "p", "n", within.alias("within_error"))
