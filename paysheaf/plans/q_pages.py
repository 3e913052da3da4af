"""Roster-page queries over the ``roster_pages`` fixture (one captured page per order)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import rosters as R
from ..schemas import PLAYER_FIELDS
from ..sources.fixtures import FIXTURE_BASE_URL, roster_pages
from ..sources.html_tables import table_rows
from .catalog import query
from .oracle_fixtures import PROFILE_SRC, ROSTER, with_

W = with_(ROSTER)
TEAM = "nation-7"
_RAW_COLS = ["page_id", "table_no", "row_no", "player_name", "player_url", "player_image_thumb",
             "jersey_number", "position", "roster_category", "player_category", "player_status",
             "team_slug"]


def _raw(spark, sf):
    pages = roster_pages(spark, sf)
    return R.roster_rows(table_rows(pages, keep=("team_name", "team_slug")), None, FIXTURE_BASE_URL)


@query("html_roster_rows", W + f"SELECT {', '.join(_RAW_COLS)} FROM roster_raw")
def html_roster_rows(spark, sf):
    """Roster tables -> player rows (tables without 'player' header and rows without
    a player link skipped; cells mapped by header position)."""
    return _raw(spark, sf).select(*_RAW_COLS)


_FIRST = """first_rows AS (
  SELECT * FROM roster_raw QUALIFY row_number() OVER (PARTITION BY team_slug, player_url
                                                     ORDER BY page_id, table_no, row_no) = 1
)"""


@query("dedupe_first", W[:-1] + ",\n" + _FIRST + f"\nSELECT {', '.join(_RAW_COLS)} FROM first_rows")
def dedupe_first(spark, sf):
    """First occurrence per (team, player URL)."""
    return R.dedupe_players(_raw(spark, sf)).select(*_RAW_COLS)


def _players(spark, sf):
    return R.roster_normalize(R.dedupe_players(_raw(spark, sf)))


_NORM = f"""SELECT upper(substr(team_slug, 1, 1)) || substr(replace(team_slug, '-', ' '), 2) AS team_name,
  team_slug, player_name, player_url, regexp_extract(jersey_number, '(\\d+)', 1) AS jersey_number,
  position, roster_category, replace(player_category, '  ', ' ') AS player_category, player_status,
  player_image_thumb, CAST(NULL AS VARCHAR) AS player_image, CAST(NULL AS VARCHAR) AS team_logo
FROM first_rows"""


@query("roster_normalize", W[:-1] + ",\n" + _FIRST + "\n" + _NORM)
def roster_normalize(spark, sf):
    """T19 (+T7, T8, T5): player records from the deduplicated roster rows."""
    return _players(spark, sf).select(*PLAYER_FIELDS)


@query("roster_count_by_position", W[:-1] + ",\n" + _FIRST + """
SELECT position, COUNT(*) AS n FROM first_rows WHERE position IS NOT NULL GROUP BY position ORDER BY position""")
def roster_count_by_position(spark, sf):
    """Players per position on the rosters."""
    return A.count_by(_players(spark, sf), "position")


@query("filter_eq", W[:-1] + ",\n" + _FIRST + f"""
SELECT player_url, player_name FROM first_rows WHERE team_slug = '{TEAM}'""")
def filter_eq(spark, sf):
    """the players of one team (slug equality)."""
    return _players(spark, sf).filter(F.col("team_slug") == TEAM).select("player_url", "player_name")


def _facts(spark, sf):
    from ..sources.fixtures import profile_pages
    from ..sources.profiles import profile_facts
    return profile_facts(profile_pages(spark, sf), keep=("player_url",))


@query("html_profile_map", with_(PROFILE_SRC) + """
SELECT page_id, details AS profile, player_image, full_name, team_logo, club_slug, jersey_number_profile
FROM profile_src""")
def html_profile_map(spark, sf):
    """Profile pages -> detail map (keys normalised, blanks dropped, last wins),
    image, full name, club logo and slug, jersey number."""
    from .q_stats import map_text
    f = _facts(spark, sf)
    return f.select("page_id", map_text(F.col("profile")).alias("profile"), "player_image", "full_name",
                    "team_logo", "club_slug", "jersey_number_profile")


@query("roster_with_profile", W[:-1] + ",\n" + _FIRST + ",\n" + PROFILE_SRC + """
SELECT f.player_url, p.jersey_number_profile AS jersey_number, p.c_mktsegment AS position,
  f.roster_category, p.player_image, p.team_logo,
  'club_slug=' || p.club_slug || ';'
    || replace(p.details, ';height_cm=', ';full_name=' || p.full_name || ';height_cm=') AS profile
FROM first_rows f JOIN profile_src p ON f.player_url = p.player_url""")
def roster_with_profile(spark, sf):
    """Roster players ⟕ their profile facts; profile values preferred."""
    from .q_stats import map_text
    players = R.roster_normalize(R.dedupe_players(_raw(spark, sf)), _facts(spark, sf))
    return players.select("player_url", "jersey_number", "position", "roster_category", "player_image",
                          "team_logo", map_text(F.col("profile")).alias("profile"))
