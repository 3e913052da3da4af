"""Exact quantiles (linear interpolation, NULLs skipped) without a single-task merge.

``percentile`` merges the distinct values of a group in one final task — for a global
percentile over a large column that is one task holding the column. Here:

1. one mergeable sketch per group (``percentile_approx``, partial aggregation) brackets every
   wanted rank between two values;
2. one scan joins the brackets (a row per group), counts the values below each bracket and keeps
   the distinct values inside it with their counts — about 0.2 % of the ranks per percentile,
   reduced in the map tasks, so a hot group or a hot value is a few rows;
3. running counts inside each bracket give the exact values at ranks floor and ceil of
   p * (n - 1), which are interpolated.

Everything is lazy; nothing is sorted but the values inside the brackets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranks a bracket reaches to each side, as a share of the group; the sketch is ten times finer.
REACH = 0.001
ACCURACY = 10_000
# Below this many values the reach is less than the sketch's rounding: the bracket is everything.
FEW = 4_000
_G = "_qgroup"


def exact_quantiles(df: DataFrame, column: Column | str, ps: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """(*group_cols, p, value): the exact p-quantiles of ``column`` per group (DOUBLE);
    groups with no non-NULL value are absent."""
    x = (F.col(column) if isinstance(column, str) else column).cast("double")
    g = list(group_cols) if group_cols else [_G]
    src = df.select(*[F.col(c) for c in group_cols], x.alias("_x"))
    if not group_cols:
        src = src.withColumn(_G, F.lit(0))
    src = src.filter(F.col("_x").isNotNull())

    edges = [min(1.0, max(0.0, p + side * REACH)) for p in ps for side in (-1, 1)]
    sketch = src.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(
        "_x", F.array(*[F.lit(e) for e in edges]), ACCURACY).alias("_e"))
    few = F.col("_n") < FEW
    brackets = F.array(*[F.struct(
        F.lit(float(p)).alias("p"),
        F.when(few, F.lit(float("-inf"))).otherwise(F.get("_e", F.lit(2 * k))).alias("lo"),
        F.when(few, F.lit(float("inf"))).otherwise(F.get("_e", F.lit(2 * k + 1))).alias("hi")) for k, p in enumerate(ps)])
    sketch = sketch.select(*g, "_n", brackets.alias("_b"))

    upto = F.filter("_b", lambda b: F.col("_x") <= b["hi"])
    kept = src.join(sketch, g).select(*g, "_n", F.explode(F.transform(upto, lambda b: F.struct(
        b["p"].alias("p"), F.when(F.col("_x") >= b["lo"], F.col("_x")).alias("v")))).alias("k"))
    # v is NULL for the values below a bracket: one row that carries their count.
    counts = kept.groupBy(*g, "_n", F.col("k.p").alias("p"), F.col("k.v").alias("v")).agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*g, "p").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.col("p") * (F.col("_n") - 1)
    ranked = counts.withColumn("_last", F.sum("_c").over(run) - 1).withColumn("_first", F.col("_last") - F.col("_c") + 1)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank <= F.col("_last")), F.col("v")))

    vals = ranked.groupBy(*g, "p").agg(at(F.floor(pos)).alias("_vlo"), at(F.ceil(pos)).alias("_vhi"), F.max(pos).alias("_pos"))
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.floor("_pos"))
    return vals.select(*[F.col(c) for c in group_cols], "p", value.alias("value"))


def quantile_columns(df: DataFrame, column: Column | str, ps: dict[str, float],
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """(*group_cols, <name> for each entry of ``ps``): exact quantiles as columns, one row
    per group."""
    q = exact_quantiles(df, column, list(ps.values()), group_cols)
    aggs = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(name) for name, p in ps.items()]
    if group_cols:
        return q.groupBy(*group_cols).agg(*aggs)
    return q.agg(*aggs)
