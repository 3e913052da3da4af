"""Player-statistics queries over ``stats_pages`` (one captured page per event) and
``player_profiles`` (customers and suppliers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from ..session import cut_lineage
from ..schemas import STAT_TYPES, STATS_BASE_FIELDS
from ..functions.text import map_prefix_select
from ..sources.fixtures import FIXTURE_BASE_URL, player_profiles, profile_pages, stats_pages
from ..sources.html_tables import table_rows
from ..sources.profiles import profile_facts
from ..sources.tables import read_table
from .catalog import query
from .oracle_fixtures import PROFILE_SRC, STATS_SRC, with_

W = with_(STATS_SRC)
STAT_KEYS = ("games_played", "k", "value")


def _raw(spark, sf):
    pages = stats_pages(spark, sf)
    return S.stats_rows(table_rows(pages, keep=S.PAGE_FIELDS, link="players"), None, FIXTURE_BASE_URL)


def map_text(m) -> F.Column:
    """Map -> 'k=v;k=v' sorted by key (NULL values as '~')."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(
        e["key"], F.lit("="), F.coalesce(e["value"], F.lit("~")))), ";")


_STATS_TEXT = ("stat_type || '_games_played=' || games_played || ';' || stat_type || '_k=' || "
               "COALESCE(k, '~') || ';' || stat_type || '_value=' || value")


@query("html_stats_rows", W + f"""
SELECT page_id, team_slug, season, stat_type, player_name, player_url, player_image, club,
  {_STATS_TEXT} AS stats FROM stats_src""")
def html_stats_rows(spark, sf):
    """Stats tables -> long rows keyed by cell class with the stat-type prefix."""
    r = _raw(spark, sf)
    return r.select("page_id", "team_slug", "season", "stat_type", "player_name", "player_url",
                    "player_image", "club", map_text(F.col("stats")).alias("stats"))


@query("distinct_keys", W + "SELECT DISTINCT player_url FROM stats_src WHERE player_url <> ''")
def distinct_keys(spark, sf):
    """U4: distinct non-empty player URLs (the profiles to look up)."""
    return _raw(spark, sf).filter(F.coalesce(F.col("player_url"), F.lit("")) != "") \
        .select("player_url").distinct()


@query("enrich_left", W + """
SELECT s.page_id, s.player_url, p.full_name, p.position
FROM stats_src s LEFT JOIN profile1 p ON s.player_url = p.player_url""")
def enrich_left(spark, sf):
    """Stats rows ⟕ the first fetched profile of their URL."""
    e = S.enrich_left(_raw(spark, sf), player_profiles(spark, sf))
    return e.select("page_id", "player_url", F.col("profile_details")["full_name"].alias("full_name"),
                    F.col("profile_details")["position"].alias("position"))


def _records(spark, sf):
    return S.stats_normalize(S.enrich_left(_raw(spark, sf), player_profiles(spark, sf)))


_PROFILE_TEXT = """concat_ws(';',
    CASE WHEN p.player_url IS NOT NULL THEN 'full_name=' || trim(regexp_replace(p.full_name, '\\s+', ' ', 'g')) END,
    CASE WHEN p.player_url IS NOT NULL AND p.from_customer THEN 'height=~' END,
    'player_image_thumb=' || s.player_image,
    CASE WHEN p.player_url IS NOT NULL THEN 'position=' || trim(regexp_replace(p.position, '\\s+', ' ', 'g')) END)"""


@query("stats_normalize", W + f"""
SELECT s.team_slug, s.season, s.stat_type, s.player_name, s.player_url, s.club,
  {_STATS_TEXT.replace('stat_type', 's.stat_type').replace('games_played ||', 's.games_played ||')} AS stats,
  {_PROFILE_TEXT} AS profile
FROM stats_src s LEFT JOIN profile1 p ON s.player_url = p.player_url""")
def stats_normalize(spark, sf):
    """Stats records with normalised keys, cleaned values and profile details."""
    r = _records(spark, sf)
    return r.select("team_slug", "season", "stat_type", "player_name", "player_url", "club",
                    map_text(F.col("stats")).alias("stats"), map_text(F.col("profile")).alias("profile"))


@query("stats_from_profile_pages", with_(STATS_SRC, PROFILE_SRC) + """
SELECT s.page_id, s.player_url, CASE WHEN p.player_url IS NULL THEN 'player_image_thumb=' || s.player_image ELSE
  replace(replace(p.details, ';height_cm=', ';full_name=' || p.full_name || ';height_cm='), ';position=',
    ';player_image_large=' || p.player_image || ';player_image_thumb=' || s.player_image || ';position=')
  || ';team_logo=' || p.team_logo END AS profile
FROM stats_src s LEFT JOIN profile_src p ON replace(s.player_url, '/players/u', '/players/c') = p.player_url""")
def stats_from_profile_pages(spark, sf):
    """Stats rows enriched from the captured profile pages of their players (image, logo and name
    from the masthead, details from the info items)."""
    facts = profile_facts(profile_pages(spark, sf), keep=("player_url",))
    raw = _raw(spark, sf)
    linked = raw.withColumn("player_url", F.replace("player_url", F.lit("/players/u"), F.lit("/players/c")))
    rec = S.enrich_left(linked, S.page_profiles(facts))
    shown = F.replace("player_url", F.lit("/players/c"), F.lit("/players/u")).alias("player_url")
    pairs = S.profile_entries(F.col("profile_details"), F.col("player_image"))
    return rec.select("page_id", shown, map_text(pairs).alias("profile"))


@query("map_prefix_select", """
SELECT c_custkey, 'name=' || trim(regexp_replace(c_name, '\\s+', ' ', 'g'))
  || ';segment=' || CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment ELSE '~' END AS profile FROM customer""")
def map_prefix_select_query(spark, sf):
    """The set entries with the ``profile_`` prefix, cut from the keys."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    m = F.create_map(F.lit("profile_name"), F.col("c_name"), F.lit("profile_segment"),
                     F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).otherwise(" "), F.lit("segment"), F.lit("x"))
    return c.select("c_custkey", map_text(map_prefix_select(m, "profile_")).alias("profile"))


def _flat_sql() -> str:
    cols = []
    for st in sorted(STAT_TYPES):
        for k in STAT_KEYS:
            src = {"games_played": "s.games_played", "k": "s.k", "value": "s.value"}[k]
            cols.append(f"CASE WHEN s.stat_type = '{st}' THEN {src} END AS stat_{st}_{k}")
    cols += [
        "CASE WHEN p.player_url IS NOT NULL THEN trim(regexp_replace(p.full_name, '\\s+', ' ', 'g')) END AS profile_full_name",
        "CAST(NULL AS VARCHAR) AS profile_height",
        "s.player_image AS profile_player_image_thumb",
        "CASE WHEN p.player_url IS NOT NULL THEN trim(regexp_replace(p.position, '\\s+', ' ', 'g')) END AS profile_position",
    ]
    base = ", ".join(f"s.{c}" for c in STATS_BASE_FIELDS if c != "team_name")
    return (f"SELECT upper(substr(s.team_slug, 1, 1)) || substr(s.team_slug, 2) AS team_name, {base}, "
            + ", ".join(cols) + " FROM stats_src s LEFT JOIN profile1 p ON s.player_url = p.player_url")


@query("flatten_map", W + _flat_sql())
def flatten_map(spark, sf):
    """Stats records flattened to 7 base + sorted stat_* + sorted profile_* columns.
    The records are checkpointed first: key discovery and the final select then read them
    instead of running the page pipeline twice."""
    return S.flatten_stats(cut_lineage(_records(spark, sf)))


@query("union_widen", W + _flat_sql())
def union_widen(spark, sf):
    """Per-stat-type flattened frames (each with its own columns) unioned by name,
    missing columns filled with NULL."""
    return S.union_by_type(cut_lineage(_records(spark, sf)))
