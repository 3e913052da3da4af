"""CSV files in blocks against the standard library's reader and the whole-file reader, at any block border."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from paysheaf.sources.csv_blocks import csv_file_records, physical_lines
from paysheaf.sources.documents import csv_records, read_text_files


@pytest.fixture()
def tiny_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "48", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cells(rng):
    plain = ["a", "", "12", "x y", 'in"side', "é", "$5"]
    quoted = ['"a,b"', '"line\nend"', '"two\r\nends\n\nhere"', '"say ""hi"""', '""', '"x"tail', '"\n"', '"long ' + "w" * 70 + '\nmore"', '"lone\rreturn"']
    return ",".join(rng.choice(plain if rng.random() < 0.6 else quoted) for _ in range(rng.randrange(1, 5)))


def by_file(df):
    out = {}
    for r in df.collect():
        out.setdefault(os.path.basename(r.path), {})[r.row_no] = r.cells
    for rows in out.values():
        assert sorted(rows) == list(range(len(rows)))
    return {f: [rows[k] for k in sorted(rows)] for f, rows in out.items()}


def test_blocks_give_the_records_of_whole_files(spark, tmpdir_fresh, tiny_blocks):
    rng = random.Random(3)
    texts = {f"f{k}.csv": "".join(cells(rng) + rng.choice(["\n", "\r\n", "\n\n"]) for _ in range(40)) for k in range(4)}
    texts |= {"open.csv": 'a,b\n"never closed\nc,d\ne', "none.csv": "", "end.csv": 'x\n"y\nz"', "one.csv": "a", "blank.csv": "\n\n",
              "returns.csv": 'a\rb,"c\rd"\r\r\ne\r', "late.csv": "q\n" * 60 + '"' + "r\n" * 60 + '"\ns\n'}
    for name, text in texts.items():
        with open(os.path.join(tmpdir_fresh, name), "wb") as f:
            f.write(text.encode("latin-1" if name == "f3.csv" else "utf-8"))
    assert physical_lines(spark, tmpdir_fresh).select("path", "block").distinct().count() > 60
    got = by_file(csv_file_records(spark, tmpdir_fresh))
    whole = by_file(csv_records(read_text_files(spark, tmpdir_fresh)))
    assert got.keys() == texts.keys() - {"none.csv"}
    for name in got:
        assert got[name] == whole[name], name
        if name not in ("open.csv", "returns.csv"):
            want = [[c.strip() for c in r] for r in csv.reader(io.StringIO(texts[name], newline=""))]
            assert got[name] == want, name


def test_an_empty_folder_has_no_records(spark, tmpdir_fresh):
    open(os.path.join(tmpdir_fresh, "a.csv"), "w").close()
    assert csv_file_records(spark, tmpdir_fresh).collect() == []


def test_one_large_file_is_read_in_many_tasks(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "big.csv")
    with open(path, "w") as f:
        for k in range(60_000):
            f.write(f'{k},"first line {k}\nsecond ""line"" {"v" * 50}",end\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 19))
    try:
        lines = physical_lines(spark, path)
        assert lines.select(F.spark_partition_id()).distinct().count() >= 10
        got = csv_file_records(spark, path)
        bad = got.filter((F.col("row_no") != F.get("cells", F.lit(0)).cast("long")) | (F.size("cells") != 3)
                         | ~F.startswith(F.get("cells", F.lit(1)), F.concat(F.lit("first line "), F.col("row_no"), F.lit('\nsecond "line" v'))))
        assert (got.count(), bad.count()) == (60_000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
