"""Stored sketches against exact ranks; clustered Parquet against a plain write."""

import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from paysheaf.operators import sketches as S
from paysheaf.sinks import writers as Wr

SCHEMA = "year int, club string, last_name string, first_name string, position string, base_salary decimal(18,2), guaranteed_comp decimal(18,2)"


def records(spark, n=6000, seed=4):
    """A third of the rows belong to one club and year; some keys and pays are null."""
    from decimal import Decimal
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        year, club = (2001, "Hot") if k % 3 == 0 else (rng.choice([2000, 2001, 2002, None]), rng.choice(["A", "B", "C", "Hot", None]))
        pay = None if rng.random() < 0.05 else Decimal(rng.randrange(1, 10**8)) / 100
        rows.append((year, club, f"last{k}", "x", "M", pay, pay))
    return spark.createDataFrame(rows, SCHEMA), rows


def near(rows, p, value, k):
    xs = [float(r[6]) for r in rows if r[6] is not None]
    off = 3 * S.rank_error(k) * len(xs) + 1
    return sum(x < value for x in xs) <= p * len(xs) + off and sum(x <= value for x in xs) >= p * len(xs) - off


def test_merged_sketches_answer_any_part(spark, tmpdir_fresh):
    df, rows = records(spark)
    more, later = records(spark, 1500, 5)
    k = 400
    path = S.write_sketches(df, tmpdir_fresh + "/s", k=k)
    S.write_sketches(more, path, "append", k=k)
    kept, rows = S.read_sketches(spark, path), rows + later
    whole = S.sketch_percentiles(kept, k=k).collect()
    assert len(whole) == 7 and {r.n for r in whole} == {sum(r[6] is not None for r in rows)}
    assert all(near(rows, r.p, r.value, k) for r in whole)
    for r in S.sketch_percentiles(kept.filter("year = 2001"), ["club"], k=k).collect():
        mine = [x for x in rows if x[0] == 2001 and x[1] == r.club]
        assert r.n == sum(x[6] is not None for x in mine) and near(mine, r.p, r.value, k)


def test_small_groups_are_exact_and_empty_ones_have_no_answer(spark):
    df = spark.createDataFrame([(2000, "A", "l", "f", "M", None, v) for v in (None, 5, 1, 3, 3)] + [(2001, "B", "l", "f", "M", None, None)],
                               SCHEMA.replace("decimal(18,2)", "int"))
    got = S.sketch_percentiles(S.pay_sketches(df), ["year", "club"], [0.0, 0.5, 1.0]).collect()
    assert [(r.year, r.club, r.n, r.p, r.value) for r in got] == [(2000, "A", 4, 0.0, 1.0), (2000, "A", 4, 0.5, 3.0), (2000, "A", 4, 1.0, 5.0)]
    assert S.sketch_percentiles(S.pay_sketches(df.limit(0))).count() == 0


def test_the_check_of_ranks_sees_a_wrong_answer(spark):
    df, _ = records(spark, 900)
    right = S.sketch_percentiles(S.pay_sketches(df).filter("year IS NOT NULL"), ["year"])
    assert S.rank_check(right, df, ["year"]).filter("not within_error").count() == 0
    wrong = right.withColumn("value", F.col("value") * 0.5)
    assert S.rank_check(wrong, df, ["year"]).filter("within_error").count() < 7


def row_groups(path, club, year):
    """Row groups of the files, and those whose statistics allow the club and year."""
    groups, met = 0, 0
    for f in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = meta.schema.names
        for g in range(meta.num_row_groups):
            one = meta.row_group(g)
            y, c = (one.column(names.index(n)).statistics for n in ("year", "club"))
            groups += 1
            met += (y.has_min_max and y.min <= year <= y.max) and (c.has_min_max and c.min <= club <= c.max)
    return groups, met


def test_clustered_files_are_skipped(spark, tmpdir_fresh):
    df, rows = records(spark)
    plain, clustered = tmpdir_fresh + "/plain", tmpdir_fresh + "/clustered"
    df.repartition(24).write.parquet(plain)
    Wr.write_clustered(df, clustered, files=24)
    (n, met), (m, few) = row_groups(plain, "B", 2000), row_groups(clustered, "B", 2000)
    assert n == met == 24 and m >= 20 and few <= 4
    assert sorted(map(str, spark.read.parquet(clustered).collect())) == sorted(map(str, df.collect()))
    # The hot key is cut: no file holds much more than its share.
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(clustered + "/*.parquet")]
    assert max(sizes) < 3 * len(rows) / 24
