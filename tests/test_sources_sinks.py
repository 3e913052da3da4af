"""Document readers, writers and round trips (into fresh scratch folders)."""

import os

from pyspark.sql import functions as F

from paysheaf.sinks import writers as Wr
from paysheaf.sources import documents as D
from paysheaf.sources.fixtures import pay_records
from paths import SF0001


def test_csv_cells_and_latin1_fallback(spark, tmpdir_fresh):
    with open(os.path.join(tmpdir_fresh, "a.csv"), "wb") as f:
        f.write("Club,Name\n SEA , \"Doe, J\"\n\"ab\"\"c\"x,d,\n".encode("utf-8"))
    with open(os.path.join(tmpdir_fresh, "b.csv"), "wb") as f:
        f.write("Club,Name\nMTL,Montr\xe9al\n".encode("latin-1"))
    docs = D.read_text_files(spark, tmpdir_fresh, "*.csv")
    lines = D.text_lines(docs, "text", keep=("path",))
    cells = lines.select("path", "row_no", D.csv_cells(F.col("line")).alias("c")).collect()
    got = {(os.path.basename(r.path), r.row_no): r.c for r in cells}
    assert got[("a.csv", 1)] == ["SEA", '"Doe', 'J"']
    assert got[("b.csv", 1)] == ["MTL", "Montréal"]
    assert got[("a.csv", 2)] == ['ab"cx', "d", ""]
    assert got[("a.csv", 3)] == []


def test_fragmentation(spark):
    df = spark.createDataFrame([("a b c d e f g h i j",), ("word " * 12,), ("a b",)], "t string")
    got = [tuple(r) for r in df.select(D.fragmentation(D.line_tokens(F.col("t"))).alias("f"))
           .select("f.*").collect()]
    assert got == [(1.0, True), (0.0, False), (1.0, False)]


def test_load_records_prefers_parquet(spark, tmpdir_fresh):
    recs = pay_records(spark, SF0001)
    Wr.write_records(recs, tmpdir_fresh, ["csv"])
    assert Wr.load_records(spark, tmpdir_fresh).count() == recs.count()
    Wr.write_records(recs.limit(5), tmpdir_fresh, ["parquet"])
    assert Wr.load_records(spark, tmpdir_fresh).count() == 5
    try:
        Wr.load_records(spark, os.path.join(tmpdir_fresh, "nothing"))
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_table_requires_not_null(spark, tmpdir_fresh):
    recs = pay_records(spark, SF0001).withColumn("club", F.lit(None).cast("string"))
    try:
        Wr.write_table(recs, os.path.join(tmpdir_fresh, "t"))
        raise AssertionError("expected an error")
    except Exception as e:
        assert "NULL in the required column" in str(e)
        pass


def test_players_and_teams_writers(spark, tmpdir_fresh):
    from paysheaf.schemas import PLAYER_FIELDS
    row = {c: None for c in PLAYER_FIELDS}
    row.update(team_name="A", team_slug="a", player_name="P", player_url="/p")
    schema = ", ".join(f"{c} string" for c in PLAYER_FIELDS) + ", profile map<string,string>"
    df = spark.createDataFrame([tuple(row[c] for c in PLAYER_FIELDS) + ({"height": "1.8", "age": "20"},)], schema)
    path = Wr.write_players(df, os.path.join(tmpdir_fresh, "p"))
    back = spark.read.option("header", True).csv(path)
    assert back.columns == PLAYER_FIELDS + ["profile_age", "profile_height"]
    assert Wr.write_players(df.limit(0), os.path.join(tmpdir_fresh, "q")) is None
    teams = spark.createDataFrame([("A", "a", "/s")], "name string, slug string, stats_url string")
    tp = Wr.write_teams(teams, os.path.join(tmpdir_fresh, "t"))
    assert spark.read.option("header", True).csv(tp).columns == ["name", "slug", "roster_url", "stats_url"]


def test_stats_writer_by_team(spark, tmpdir_fresh):
    from paysheaf.operators import stats as S
    recs = spark.createDataFrame(
        [("A", "a", 2024, "general", "P", "/p", "X", {"general_goals": "1"}, {"height": "1.8"}),
         ("B", "b", 2024, "passing", "Q", "/q", "", {"passing_acc": "9"}, {})],
        "team_name string, team_slug string, season int, stat_type string, player_name string, "
        "player_url string, club string, stats map<string,string>, profile map<string,string>")
    path = Wr.write_stats(recs, os.path.join(tmpdir_fresh, "s"), by_team=True)
    back = spark.read.option("header", True).csv(path)
    assert sorted(back.columns) == sorted(["team_name", "season", "stat_type", "player_name", "player_url",
                                           "club", "stat_general_goals", "stat_passing_acc",
                                           "profile_height", "team_slug"])
    assert sorted(r.team_slug for r in back.select("team_slug").collect()) == ["a", "b"]
    flat = S.flatten_stats(recs)
    assert flat.columns[:7] == ["team_name", "team_slug", "season", "stat_type", "player_name",
                                "player_url", "club"]
