"""CSV cells and records, CSV writer round trips, flattening without caps."""

import os

from pyspark.sql import functions as F

from paysheaf.functions.clubs import ClubLookup
from paysheaf.operators.quality import dq_club_variants
from paysheaf.operators.stats import flatten_stats, union_by_type
from paysheaf.schemas import SALARY_RECORD
from paysheaf.sinks import writers as Wr
from paysheaf.sources.documents import csv_cells, csv_records, read_text_files


def test_csv_cells(spark):
    lines = [",x,y", '"' + "a" * 100_000 + '",b', '"a ""q"" b"tail,,', "", '"open, no end', "a"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string")
    got = {r.k: r.c for r in rows.select("k", csv_cells(F.col("line")).alias("c")).collect()}
    assert got == {0: ["", "x", "y"], 1: ["a" * 100_000, "b"], 2: ['a "q" btail', "", ""], 3: [], 4: ["open, no end"], 5: ["a"]}


def test_records_of_files(spark, tmpdir_fresh):
    with open(os.path.join(tmpdir_fresh, "a.csv"), "wb") as f:
        f.write('a,"x\ny",c\r\n\n,z\nlast,"q"'.encode())
    with open(os.path.join(tmpdir_fresh, "b.csv"), "wb") as f:
        f.write("Jos\xe9,1\n".encode("latin-1"))
    rows = csv_records(read_text_files(spark, tmpdir_fresh)).collect()
    got = {(os.path.basename(r.path), r.row_no): r.cells for r in rows}
    assert got == {("a.csv", 0): ["a", "x\ny", "c"], ("a.csv", 1): [], ("a.csv", 2): ["", "z"], ("a.csv", 3): ["last", "q"], ("b.csv", 0): ["Jos\xe9", "1"]}


def test_csv_round_trip_keeps_cells(spark, tmpdir_fresh):
    rows = [(1999, ' A "q" ', "line\nend", "x,y", "D", None, None), (1999, "b", 'say "hi"', "\\", "M", None, None)]
    df = spark.createDataFrame(rows, SALARY_RECORD)
    path = Wr.write_records_csv(df, os.path.join(tmpdir_fresh, "out"))
    assert sorted(map(tuple, Wr.read_records_csv(spark, path).collect())) == sorted(rows)


def test_wide_maps_and_foreign_types_lose_nothing(spark):
    keys = {f"k{i}": str(i) for i in range(3000)}
    rows = [("T", "t", 1, "general", "A", "u1", "c", keys, {"p": "1"}), ("T", "t", 1, "foreign", "B", "u2", "c", {"f": "9"}, {}),
            ("T", "t", 1, "", "C", "u3", "c", {}, {})]
    df = spark.createDataFrame(rows, "team_name string, team_slug string, season int, stat_type string, player_name string, "
                                     "player_url string, club string, stats map<string,string>, profile map<string,string>")
    wide = {r.player_name: r for r in union_by_type(df).collect()}
    assert wide["A"].stat_k2999 == "2999" and wide["B"].stat_f == "9" and wide["C"].stat_f is None and wide["A"].profile_p == "1"
    assert len(flatten_stats(df).columns) == 7 + 3001 + 1


def test_many_clubs(spark):
    dim = spark.createDataFrame([("name", f"club number {i}", f"Club {i}") for i in range(20_000)], "kind string, key string, canonical string")
    look = ClubLookup.from_dim(dim)
    row = spark.range(1).select(F.try_element_at(look.name_map(), F.lit("club number 19999")).alias("c")).first()
    assert row.c == "Club 19999"


def test_clubs_in_other_scripts_stay_apart(spark):
    clubs = ["Спартак", "Зенит", "Москва FC", "東京", "!!!", "..."]
    assert dq_club_variants(spark.createDataFrame([(c,) for c in clubs], "club string")).count() == 0
