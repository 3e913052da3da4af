"""Properties over the given tables and the shape of the physical plans."""

import os

from pyspark.sql import functions as F

from paysheaf.operators import analytics as A
from paysheaf.operators import quality as Q
from paysheaf.sources.fixtures import pay_records
from paths import SF0001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["club", "base_salary", "guaranteed_comp", "player_count"]
    qs, oracles = E.queries(), E.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 80


def test_sum_over_clubs_equals_sum_over_years(spark):
    recs = pay_records(spark, SF0001)
    by_club = A.team_spending(recs).agg(F.sum("guaranteed_comp")).collect()[0][0]
    by_year = A.salary_trends(recs).agg(F.sum("guaranteed_comp_sum")).collect()[0][0]
    assert abs(by_club - by_year) < 1e-6 * abs(by_club)


def test_top_n_subset_and_order(spark):
    recs = pay_records(spark, SF0001)
    top = A.top_earners(recs, None, 5).collect()
    vals = [r.guaranteed_comp for r in top]
    assert vals == sorted(vals, reverse=True)
    assert vals[0] == float(recs.agg(F.max("guaranteed_comp")).collect()[0][0])
    # n larger than the input returns every row
    assert A.top_earners(recs.limit(3), None, 10).count() == 3


def test_outliers_are_outside_fences(spark):
    recs = pay_records(spark, SF0001)
    o = Q.dq_outliers(recs).collect()[0]
    rows = Q.dq_outlier_rows(recs).select(F.col("guaranteed_comp").cast("double").alias("g")).collect()
    assert len(rows) == o.outlier_count
    assert all(r.g < o.lower_bound or r.g > o.upper_bound for r in rows)


def test_edge_frames(spark):
    empty = pay_records(spark, SF0001).limit(0)
    assert A.team_spending(empty).count() == 0
    d = A.salary_distribution(empty).collect()[0]
    assert d["count"] == 0 and d["mean"] is None
    s = Q.dq_summary(empty).collect()[0]
    assert s.total_records == 0 and s.completeness_pct == 0.0
    assert Q.dq_positions(empty).collect()[0].missing_position_pct is None


def test_null_keys_dropped_and_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame(
        [(2020, None, "a", "b", "", None, None), (2020, "X", "a", "b", "", None, None)],
        "year int, club string, last_name string, first_name string, position string, "
        "base_salary decimal(18,2), guaranteed_comp decimal(18,2)").withColumn("record_id", F.lit(1))
    rows = A.team_spending(df).collect()
    assert [(r.club, r.guaranteed_comp, r.player_count) for r in rows] == [("X", 0.0, 1)]


def test_top_k_plans(spark):
    recs = pay_records(spark, SF0001)
    assert "TakeOrderedAndProject" in plan(A.top_earners(recs))
    p = plan(A.top_n_per_year(recs, 3))
    assert "WindowGroupLimit" in p


def test_no_python_udf_in_etl_or_cleaners(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for k in ("salary_etl", "clean_money", "page_links", "team_spending", "dq_report"):
        p = plan(qs[k](spark, SF0001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = spark.read.parquet(os.path.join(SF0001, "orders.parquet")).filter(F.col("o_orderkey") > 5) \
        .select("o_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,5)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_header_table_is_broadcast(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["salary_etl"](spark, SF0001))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_exact_quantiles_match_percentile(spark):
    from paysheaf.operators.quantiles import exact_quantiles
    recs = pay_records(spark, SF0001)
    ps = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {(r.year, r.p): r.value for r in exact_quantiles(recs, "guaranteed_comp", ps, ["year"]).collect()}
    ref = recs.groupBy("year").agg(F.percentile(F.col("guaranteed_comp").cast("double"),
                                                F.array(*[F.lit(p) for p in ps])).alias("q")).collect()
    for r in ref:
        for p, v in zip(ps, r.q):
            assert abs(got[(r.year, p)] - v) <= 1e-6 * max(1.0, abs(v))
    assert exact_quantiles(recs.limit(0), "guaranteed_comp", [0.5]).count() == 0


def test_percentiles_approx_rank_error(spark):
    recs = pay_records(spark, SF0001)
    acc = 100
    approx = A.percentiles_approx(recs, None, acc).collect()
    vals = sorted(float(r.g) for r in recs.select(F.col("guaranteed_comp").alias("g")).collect())
    n = len(vals)
    for r in approx:
        # rank of the returned value must be within n/accuracy of the target rank
        below = sum(1 for v in vals if v < r.value)
        at_or_below = sum(1 for v in vals if v <= r.value)
        target = r.p * n
        assert below - n / acc - 1 <= target <= at_or_below + n / acc + 1, (r.p, r.value)
