"""Salary analytics over salary-record frames (year, club, last_name, first_name,
position, base_salary, guaranteed_comp, record_id).

Missing-value rules used throughout:
* group keys: NULL keys are dropped before grouping;
* sums of an all-NULL group are 0, means stay NULL;
* player counts count non-NULL last names, not rows;
* means are ``sum / count`` in DOUBLE, rounding is half-to-even (``bround``);
* descending sorts put NULL last; ties are broken by ``record_id`` (input order).

Every function returns a DataFrame and runs nothing itself (``spending_pivot`` without a club
list reads the clubs first); grouping runs as partial (map-side) plus final
hash aggregation, top-k as ``TakeOrderedAndProject`` or a per-group ``WindowGroupLimit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import TOP_EARNER_FIELDS, TOP_PER_YEAR_FIELDS

MONEY_COLS = ("base_salary", "guaranteed_comp")

# Percentiles of the salary distribution reports (fixed values).
DISTRIBUTION_PS = (0.25, 0.75, 0.90, 0.99)
PERCENTILE_PS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def money_sum(c: str) -> Column:
    """Exact decimal sum, 0 for an all-NULL group, returned as DOUBLE."""
    return F.coalesce(F.sum(c), F.lit(0)).cast("double")


def money_mean(c: str) -> Column:
    """Mean of the non-NULL values (NULL when there are none)."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def with_quantiles(agg: DataFrame, df: DataFrame, specs: dict[str, tuple[str, float]],
                   keys: Sequence[str] = ()) -> DataFrame:
    """Add exact quantile columns to a per-group aggregate: ``specs`` maps an output name
    to (column, p). All columns and percentiles are computed in one distributed pipeline
    over the stacked (key, column, value) rows, then joined on the group keys (a scalar
    subquery for a global aggregate)."""
    from .quantiles import exact_quantiles
    cols = sorted({c for c, _ in specs.values()})
    ps = sorted({p for _, p in specs.values()})
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), dbl(c).alias("_v")) for c in cols])).alias("_s")) \
        .select(*keys, "_s._col", "_s._v")
    q = exact_quantiles(stacked, "_v", ps, [*keys, "_col"])
    wide = q.groupBy(*keys).agg(*[
        F.max(F.when((F.col("_col") == c) & (F.col("p") == F.lit(float(p))), F.col("value"))).alias(name)
        for name, (c, p) in specs.items()])
    if keys:
        return agg.join(wide, list(keys), "left")
    # Global aggregate: one struct-valued scalar subquery (planned once, reused per field).
    sq = wide.select(F.struct(*[F.col(n) for n in specs]).alias("q")).scalar()
    return agg.select("*", *[sq[n].alias(n) for n in specs])


def r2(c: Column) -> Column:
    return F.bround(c, 2)


def r2q(c: Column) -> Column:
    """Round an interpolated quantile of cent values to cents, half-to-even.

    The exact interpolated value has only a few decimals; the double result carries
    noise around 1e-10, which flips ties such as x.705. Snapping to 6 places first
    restores the exact value, then the half-even rounding sees the true tie."""
    return F.bround(F.bround(c, 6), 2)


def by_year(df: DataFrame, year: int | None) -> DataFrame:
    return df if year is None else df.filter(F.col("year") == F.lit(year))


def _keyed(df: DataFrame, *keys: str) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


# --- trends ---------------------------------------------------------------------------

def salary_trends(df: DataFrame) -> DataFrame:
    """Per year: mean, median, min, max, sum of both money columns and the number of
    named players; all rounded to 2 places; ordered by year."""
    d = _keyed(df, "year")
    aggs = []
    for c in MONEY_COLS:
        aggs += [
            r2(money_mean(c)).alias(f"{c}_mean"),
            r2(F.min(c).cast("double")).alias(f"{c}_min"),
            r2(F.max(c).cast("double")).alias(f"{c}_max"),
            r2(money_sum(c)).alias(f"{c}_sum"),
        ]
    aggs.append(F.count("last_name").alias("last_name_count"))
    out = with_quantiles(d.groupBy("year").agg(*aggs), d,
                         {f"{c}_median": (c, 0.5) for c in MONEY_COLS}, ["year"])
    order = ["year"] + [f"{c}_{s}" for c in MONEY_COLS for s in ("mean", "median", "min", "max", "sum")]
    return out.select(*[r2q(F.col(c)).alias(c) if c.endswith("_median") else F.col(c) for c in order],
                      "last_name_count").orderBy("year")


def salary_growth(df: DataFrame) -> DataFrame:
    """Mean base salary per year and its change against the previous year in percent.

    The window runs over the aggregated rows (one per year), so its single partition
    holds only as many rows as there are years.
    """
    yearly = _keyed(df, "year").groupBy("year").agg(money_mean("base_salary").alias("avg_salary"))
    prev = F.lag("avg_salary").over(Window.orderBy("year"))
    growth = (F.try_divide(F.col("avg_salary"), prev) - F.lit(1.0)) * F.lit(100.0)
    return yearly.select("year", "avg_salary", r2(growth).alias("growth_pct")).orderBy("year")


# --- teams ----------------------------------------------------------------------------

def _spending_aggs() -> list[Column]:
    return [money_sum("base_salary").alias("base_salary"),
            money_sum("guaranteed_comp").alias("guaranteed_comp"),
            F.count("last_name").alias("player_count")]


def team_spending(df: DataFrame, year: int | None = None) -> DataFrame:
    """Per club: total base, total guaranteed, named players; biggest spender first."""
    return (_keyed(by_year(df, year), "club").groupBy("club").agg(*_spending_aggs())
            .orderBy(F.desc_nulls_last("guaranteed_comp"), "club"))


def team_spending_full_domain(df: DataFrame, year: int | None = None,
                              where: Column | None = None) -> DataFrame:
    """As ``team_spending`` but every club of the whole frame appears, also those with no
    record in the chosen slice (sums 0, count 0) — the categorical group-by behaviour.
    ``where`` narrows the slice further (e.g. a position)."""
    domain = _keyed(df, "club").select("club").distinct()
    sliced = by_year(df, year)
    if where is not None:
        sliced = sliced.filter(where)
    spent = _keyed(sliced, "club").groupBy("club").agg(*_spending_aggs())
    out = domain.join(spent, "club", "left").select(
        "club",
        F.coalesce("base_salary", F.lit(0.0)).alias("base_salary"),
        F.coalesce("guaranteed_comp", F.lit(0.0)).alias("guaranteed_comp"),
        F.coalesce("player_count", F.lit(0).cast("bigint")).alias("player_count"),
    )
    return out.orderBy(F.desc_nulls_last("guaranteed_comp"), "club")


def club_history(df: DataFrame, club: str) -> DataFrame:
    """Spending of one club per year."""
    return (_keyed(df.filter(F.col("club") == F.lit(club)), "year").groupBy("year")
            .agg(*_spending_aggs()).orderBy("year"))


def team_comparison(df: DataFrame, year: int) -> DataFrame:
    """Per club in one year: sum, mean and max of both money columns, named players."""
    aggs = []
    for c in MONEY_COLS:
        aggs += [money_sum(c).alias(f"{c}_sum"), money_mean(c).alias(f"{c}_mean"),
                 F.max(c).cast("double").alias(f"{c}_max")]
    aggs.append(F.count("last_name").alias("last_name_count"))
    return (_keyed(by_year(df, year), "club").groupBy("club").agg(*aggs)
            .orderBy(F.desc_nulls_last("guaranteed_comp_sum"), "club"))


def position_comparison(df: DataFrame, year: int | None = None) -> DataFrame:
    """Guaranteed pay per non-empty position: mean, median, min, max, count."""
    c = "guaranteed_comp"
    d = by_year(df, year).filter(F.col("position").isNotNull() & (F.col("position") != ""))
    agg = d.groupBy("position").agg(
        money_mean(c).alias(f"{c}_mean"),
        F.min(c).cast("double").alias(f"{c}_min"),
        F.max(c).cast("double").alias(f"{c}_max"),
        F.count(c).alias(f"{c}_count"))
    out = with_quantiles(agg, d, {f"{c}_median": (c, 0.5)}, ["position"])
    return out.select("position", f"{c}_mean", r2q(F.col(f"{c}_median")).alias(f"{c}_median"),
                      f"{c}_min", f"{c}_max", f"{c}_count") \
        .orderBy(F.desc_nulls_last(f"{c}_mean"), "position")


# --- top-k ------------------------------------------------------------------------------

def _top_order() -> list[Column]:
    return [F.desc_nulls_last("guaranteed_comp"), F.asc("record_id")]


def _money_out(cols: Sequence[str]) -> list[Column]:
    return [dbl(c).alias(c) if c in MONEY_COLS else F.col(c) for c in cols]


def top_earners(df: DataFrame, year: int | None = None, n: int = 10) -> DataFrame:
    """The n highest guaranteed packages (first of ties in input order)."""
    return by_year(df, year).orderBy(*_top_order()).limit(n).select(*_money_out(TOP_EARNER_FIELDS))


def filter_regex_ci(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Case-insensitive regular-expression 'contains'; NULL never matches."""
    return df.filter(F.coalesce(F.col(column).rlike("(?i)" + pattern), F.lit(False)))


def top_earners_position(df: DataFrame, position: str, year: int | None = None,
                         n: int = 10) -> DataFrame:
    return top_earners(filter_regex_ci(by_year(df, year), "position", position), None, n)


def top_n_per_year(df: DataFrame, n: int = 1) -> DataFrame:
    """Top n guaranteed packages of every year, in year order.

    ``row_number() <= n`` is planned as a partial ``WindowGroupLimit`` before the shuffle,
    so even a year holding a third of all rows sends only n rows per map task.
    """
    w = Window.partitionBy("year").orderBy(*_top_order())
    ranked = _keyed(df, "year").withColumn("_rn", F.row_number().over(w))
    return (ranked.filter(F.col("_rn") <= n).orderBy("year", "_rn")
            .select(*_money_out(TOP_PER_YEAR_FIELDS)))


# --- distribution -------------------------------------------------------------------------

def salary_distribution(df: DataFrame, year: int | None = None) -> DataFrame:
    """One row: count (all rows), mean, median, std (sample), min, max, q25, q75, q90, q99
    of guaranteed pay. Quantiles and std are rounded to 2 places."""
    c = "guaranteed_comp"
    d = by_year(df, year)
    agg = d.agg(
        F.count(F.lit(1)).alias("count"),
        money_mean(c).alias("mean"),
        r2(F.stddev_samp(dbl(c))).alias("std"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    )
    names = ["median", "q25", "q75", "q90", "q99"]
    specs = dict(zip(names, [(c, p) for p in (0.5, *DISTRIBUTION_PS)]))
    out = with_quantiles(agg, d, specs)
    return out.select("count", "mean", *[r2q(F.col(n)).alias(n) if n == "median" else F.col(n)
                                         for n in ("median",)], "std", "min", "max",
                      *[r2q(F.col(nm)).alias(nm) for nm in names[1:]])


def salary_percentiles(df: DataFrame, year: int | None = None) -> DataFrame:
    """Rows (p, value): guaranteed pay at the fixed percentiles, rounded to 2 places."""
    from .quantiles import exact_quantiles
    q = exact_quantiles(by_year(df, year), "guaranteed_comp", PERCENTILE_PS)
    return q.select(F.col("p").cast("double").alias("p"), r2q(F.col("value")).alias("value")).orderBy("p")


def percentiles_approx(df: DataFrame, year: int | None = None,
                       accuracy: int = 10_000) -> DataFrame:
    """Approximate version of ``salary_percentiles`` for very large frames: a mergeable
    sketch per partition, so the final task holds only the sketches, not the values.
    Relative rank error is 1/accuracy."""
    ps = F.array(*[F.lit(p) for p in PERCENTILE_PS])
    agg = by_year(df, year).agg(
        F.percentile_approx(dbl("guaranteed_comp"), ps, accuracy).alias("_v"))
    return (agg.select(F.arrays_zip(ps.alias("p"), F.col("_v").alias("value")).alias("_z"))
            .select(F.inline("_z")).orderBy("p"))


def percentile_rank_check(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Rows (p, within_error): the exact rank of each approximate percentile against p, allowed to
    be off by n / accuracy rows (and by one for rounding)."""
    d = df.select(dbl("guaranteed_comp").alias("x")).filter(F.col("x").isNotNull())
    found = percentiles_approx(df, accuracy=accuracy).agg(F.sort_array(F.collect_list(F.struct("p", "value"))))
    counts = d.withColumn("v", found.scalar()).agg(F.count(F.lit(1)).alias("n"), F.first("v").alias("v"), *[
        f for k in range(len(PERCENTILE_PS)) for f in (
            F.count_if(F.col("x") < F.get("v", F.lit(k))["value"]).alias(f"b{k}"),
            F.count_if(F.col("x") <= F.get("v", F.lit(k))["value"]).alias(f"u{k}"))])
    rows = F.array(*[F.struct(F.get("v", F.lit(k))["p"].cast("double").alias("p"), F.col(f"b{k}").alias("b"), F.col(f"u{k}").alias("u"))
                     for k in range(len(PERCENTILE_PS))])
    r = counts.select("n", F.inline(rows))
    off = F.col("n") / accuracy + 1
    want = F.col("p") * F.col("n")
    return r.select("p", ((F.col("b") <= want + off) & (F.col("u") >= want - off)).alias("within_error")).orderBy("p")


# --- SQL-style helpers --------------------------------------------------------------------

def count_by(df: DataFrame, key: str) -> DataFrame:
    """Group size per non-NULL key."""
    return _keyed(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key)


def spending_pivot(df: DataFrame, clubs: Sequence[str] | None = None) -> DataFrame:
    """Year × club table of total guaranteed pay (NULL where a club has no record).

    ``clubs`` is the value list, for example from the club dimension; without it the clubs
    that occur are read first, as they become the column names."""
    d = _keyed(df, "year", "club")
    if clubs is None:
        clubs = [r["club"] for r in d.select("club").distinct().orderBy("club").collect()]
    return (d.groupBy("year").pivot("club", list(clubs))
            .agg(F.sum("guaranteed_comp").cast("double")).orderBy("year"))


def count_records(df: DataFrame, year: int | None = None) -> DataFrame:
    return by_year(df, year).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, column: str, year: int | None = None) -> DataFrame:
    return by_year(df, year).select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
