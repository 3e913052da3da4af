"""Fixed schemas of the record sets (salary records, players, teams, player stats)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

SALARY_RECORD = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("club", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("position", T.StringType()),
    T.StructField("base_salary", MONEY),
    T.StructField("guaranteed_comp", MONEY),
])

# Field order of the record CSV export.
SALARY_FIELDS = [f.name for f in SALARY_RECORD.fields]

# Columns the top-earner reports return.
TOP_EARNER_FIELDS = ["year", "club", "first_name", "last_name", "position",
                     "base_salary", "guaranteed_comp"]
TOP_PER_YEAR_FIELDS = ["year", "club", "first_name", "last_name", "position", "guaranteed_comp"]

RAW_ROWS = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("source_format", T.StringType()),
    T.StructField("row_no", T.LongType()),
    T.StructField("tokens", T.ArrayType(T.StringType())),
])

SOURCES = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("format", T.StringType()),
])

PLAYER_FIELDS = [
    "team_name", "team_slug", "player_name", "player_url", "jersey_number", "position",
    "roster_category", "player_category", "player_status", "player_image_thumb",
    "player_image", "team_logo",
]

TEAM_FIELDS = ["name", "slug", "roster_url", "stats_url"]

STATS_BASE_FIELDS = ["team_name", "team_slug", "season", "stat_type", "player_name",
                     "player_url", "club"]

# The five stat tables of a team-season page (fixed values).
STAT_TYPES = ["general", "passing", "attacking", "defending", "goalkeeping"]

CLUB_DIM = T.StructType([
    T.StructField("kind", T.StringType()),       # 'code' or 'name'
    T.StructField("key", T.StringType()),        # upper-case code or lower-case full name
    T.StructField("canonical", T.StringType()),  # display name
])
