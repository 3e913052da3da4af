"""The table sink: a write that fails changes nothing."""

import os
from decimal import Decimal

import pytest

from paysheaf.schemas import SALARY_RECORD
from paysheaf.sinks import writers as Wr


def records(spark, names, year=2001):
    rows = [(year, "Club", n, "First", "M", Decimal(1), Decimal(2)) for n in names]
    return spark.createDataFrame(rows, SALARY_RECORD).repartition(3)


def names(spark, path):
    return sorted(r.last_name for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_failing_row_leaves_the_table(spark, tmpdir_fresh, mode):
    path = os.path.join(tmpdir_fresh, "table")
    Wr.write_table(records(spark, ["a", "b"]), path)
    bad = records(spark, ["c", "d"]).union(records(spark, ["e"], year=None))
    with pytest.raises(Exception, match="NULL in the required column"):
        Wr.write_table(bad, path, mode)
    assert names(spark, path) == ["a", "b"]
    assert os.listdir(tmpdir_fresh) == ["table"]


def test_overwrite_replaces_and_append_adds(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "table")
    Wr.write_table(records(spark, ["a", "b"]), path)
    Wr.write_table(records(spark, ["c"]), path, "append")
    assert names(spark, path) == ["a", "b", "c"]
    Wr.write_table(records(spark, ["d"]), path)
    assert names(spark, path) == ["d"]
    Wr.write_table(records(spark, []), path)
    assert names(spark, path) == [] and os.listdir(tmpdir_fresh) == ["table"]


def test_a_table_may_be_rewritten_from_itself(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "table")
    Wr.write_table(records(spark, ["a", "b", "c"]), path)
    Wr.write_table(spark.read.parquet(path).filter("last_name <> 'b'"), path)
    assert names(spark, path) == ["a", "c"]
