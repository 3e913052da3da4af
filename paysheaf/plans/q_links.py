"""Link-discovery queries over the ``link_pages`` fixture (one captured page per order)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import links as L
from ..sources.fixtures import link_pages
from .catalog import query
from .oracle_fixtures import LINKS, with_

W = with_(LINKS)
# Years asked for by the missing-source report (parameter).
REQUESTED_YEARS = (2015, 2030)

_EXT1 = "CASE WHEN k % 2 = 1 THEN 'csv' ELSE 'pdf' END"
_EXT2 = "CASE WHEN k % 3 = 0 THEN 'CSV' ELSE 'Pdf' END"
_ALL_LINKS = f"""SELECT page_id, 0 AS pos, '/files/' || y || '-guide.' || {_EXT1} AS href,
  'Fall ' || y || ' Guide' AS text, y AS year, {_EXT1} AS format FROM links
UNION ALL SELECT page_id, 1, '/files/' || y || '-update.' || {_EXT2}, 'Update', y, lower({_EXT2}) FROM links
UNION ALL SELECT page_id, 2, '/files/notes.html', CAST(y - 1 AS VARCHAR) || ' notes', y - 1, NULL FROM links
UNION ALL SELECT page_id, 3, '/files/summary.pdf', 'Summary', NULL, 'pdf' FROM links"""


def _pages(spark, sf):
    return link_pages(spark, sf)


@query("page_links", W + _ALL_LINKS)
def page_links(spark, sf):
    """Links of each page's salary-guide block with year and format."""
    return L.page_links(_pages(spark, sf))


@query("extract_year", W + f"SELECT page_id, pos, year FROM ({_ALL_LINKS}) t")
def extract_year(spark, sf):
    """Year of each guide link (text first, then address)."""
    return L.page_links(_pages(spark, sf)).select("page_id", "pos", "year")


@query("detect_format", W + f"SELECT page_id, pos, format FROM ({_ALL_LINKS}) t")
def detect_format(spark, sf):
    """Format of each guide link from its address."""
    return L.page_links(_pages(spark, sf)).select("page_id", "pos", "format")


@query("last_per_key", W + f"""
SELECT page_id, y AS year, '/files/' || y || '-update.' || {_EXT2} AS url, lower({_EXT2}) AS format
FROM links""")
def last_per_key(spark, sf):
    """One source per (page, year), the last link wins."""
    return L.one_source_per_year(_pages(spark, sf))


def _slugs(kind: str, pos: int) -> str:
    return f"""SELECT slug, upper(substr(slug, 1, 1)) || substr(replace(slug, '-', ' '), 2) AS name,
  '/clubs/' || slug || '/roster/' AS roster_url, '/clubs/' || slug || '/stats/' AS stats_url,
  MIN(page_id) AS first_page_id, {pos} AS first_pos
FROM links GROUP BY slug"""


@query("discover_slugs", W + _slugs("roster", 0))
def discover_slugs(spark, sf):
    """Teams from roster links, first occurrence first."""
    return L.club_links(_pages(spark, sf), "roster")


@query("discover_slugs_stats", W + _slugs("stats", 1))
def discover_slugs_stats(spark, sf):
    """Teams from stats links."""
    return L.club_links(_pages(spark, sf), "stats")


@query("option_ints", W + """
SELECT page_id, 0 AS pos, y AS season FROM links
UNION ALL SELECT page_id, 2, y - 1 FROM links""")
def option_ints(spark, sf):
    """Integer seasons of the desktop drop-down (non-integers skipped)."""
    return L.season_options(_pages(spark, sf))


@query("years_without_source", W + f"""
SELECT r.year FROM range({REQUESTED_YEARS[0]}, {REQUESTED_YEARS[1] + 1}) r(year)
WHERE r.year NOT IN (SELECT y FROM links) ORDER BY r.year""")
def years_without_source(spark, sf):
    """Requested years without any usable guide link (left anti join)."""
    req = spark.range(REQUESTED_YEARS[0], REQUESTED_YEARS[1] + 1).select(F.col("id").alias("year"))
    found = L.guide_sources(_pages(spark, sf)).select("year").distinct()
    return req.join(found, "year", "left_anti").orderBy("year")


@query("select_years", W + "SELECT DISTINCT y AS year FROM links ORDER BY year DESC")
def select_years(spark, sf):
    """The years with a usable source, newest first."""
    return L.available_years(_pages(spark, sf))


@query("requested_year", W + "SELECT max(y) AS year FROM links WHERE y = 2021")
def requested_year(spark, sf):
    """one requested year with a usable source (an error where there is none)."""
    return L.available_years(_pages(spark, sf), 2021)


@query("filter_in_semi", W + f"""
SELECT page_id, pos, year FROM ({_ALL_LINKS}) t WHERE pos IN (0, 1, 2)""")
def filter_in_semi(spark, sf):
    """Guide links whose year is one of the seasons offered on the same page."""
    return L.links_in_season(_pages(spark, sf))
