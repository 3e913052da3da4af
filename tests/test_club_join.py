"""Club lookup as joins: the golden rules of the literal lookup, and large dimensions."""

import pytest
from pyspark.sql import functions as F

from paysheaf.functions.clubs import CLUB_DIM, ClubLookup, club_parts, reference_club_dim
from paysheaf.operators.club_join import match_clubs

LINES = ["LA Galaxy Keane Robbie", "LA Keane Robbie", "sea Dempsey Clint", "New York City FC Villa David", "New York Red Bulls Henry", "Unknown Club X",
         "Toronto FC", "real salt lake a", "", "NE Revolution x", "DC United y", "D.C. z"]


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("bound", [200_000, 0])  # 0: no broadcast
def test_same_rows_as_the_literal_lookup(spark, compat, bound):
    dim = reference_club_dim(spark)
    rows = spark.createDataFrame([(i, x.split()) for i, x in enumerate(LINES)] + [(99, None)], "id long, tokens array<string>")
    club, consumed = club_parts(F.col("tokens"), ClubLookup.from_dim(dim), compat)
    want = {r.id: (r.club, r.consumed) for r in rows.filter("tokens IS NOT NULL").select("id", club.alias("club"), consumed.alias("consumed")).collect()}
    got = {r.id: (r.club, r.consumed) for r in match_clubs(rows, "tokens", dim, compat, bound).collect()}
    assert got.pop(99) == (None, 0)
    assert got == want


def test_a_million_clubs_of_one_first_word(spark):
    dim = spark.range(1_000_000).select(F.lit("name").alias("kind"), F.concat(F.lit("New Club "), "id", F.when(F.col("id") % 2 == 0, F.lit(" United")).otherwise(F.lit(""))).alias("key"),
                                        F.concat(F.lit("c"), "id").alias("canonical"))
    dim = dim.union(spark.createDataFrame([("code", "nc", "code club"), ("code", "NC", "code club"), ("name", " ", "blank")], CLUB_DIM))
    rows = spark.createDataFrame([(1, "new CLUB 777 x"), (2, "New Club 778 united x"), (3, "New Club 778 x"), (4, "nc x")], "id long, line string")
    out = match_clubs(rows.withColumn("tokens", F.split("line", " ")), "tokens", dim)
    assert {r.id: (r.club, r.consumed) for r in out.collect()} == {1: ("c777", 3), 2: ("c778", 4), 3: ("New", 1), 4: ("code club", 1)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
