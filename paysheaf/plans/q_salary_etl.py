"""Salary document ETL queries over the ``raw_pay`` fixture (documents built from ``pay``).

The oracle side never parses text: it reads the ``pay`` columns the documents were
written from, so it checks the parser end to end.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clubs import ClubLookup
from ..operators import headers as H
from ..operators import salary_etl as E
from ..sources.fixtures import club_dim, raw_pay
from .catalog import query
from .oracle_fixtures import PAY, with_

W = with_(PAY)

# Expected record: CSV years keep the club text as written, PDF years normalise it.
_CLUB_TEXT = "CASE WHEN record_id % 2 = 0 THEN 'N' || CAST(nk AS VARCHAR) ELSE region || ' ' || club END"
_EXPECTED = f"""SELECT year, CASE WHEN year % 2 = 1 THEN {_CLUB_TEXT} ELSE club END AS club,
  last_name, COALESCE(first_name, '') AS first_name, position,
  CAST(base_salary AS DOUBLE) AS base_salary, CAST(guaranteed_comp AS DOUBLE) AS guaranteed_comp
FROM pay"""


def _records(spark, sf, compat=False):
    lookup = ClubLookup.from_dim(club_dim(spark, sf))
    return E.salary_records(raw_pay(spark, sf), lookup, compat)


def _out(df):
    return df.select("year", "club", "last_name", "first_name", "position",
                     F.col("base_salary").cast("double").alias("base_salary"),
                     F.col("guaranteed_comp").cast("double").alias("guaranteed_comp"))


@query("salary_etl", W + _EXPECTED)
def salary_etl(spark, sf):
    """All payroll documents -> salary records in one job."""
    return _out(_records(spark, sf))


@query("parse_indexed", W + _EXPECTED + " WHERE year % 2 = 1")
def parse_indexed(spark, sf):
    """Records of the CSV sources (index route)."""
    return _out(_records(spark, sf).filter(F.col("route") == "index"))


@query("parse_club_first", W + _EXPECTED + " WHERE year % 4 = 2")
def parse_club_first(spark, sf):
    """Records of the club-first PDF sources (heuristic route)."""
    return _out(_records(spark, sf).filter(F.col("route") == "club_first"))


@query("parse_names_first", W + _EXPECTED + " WHERE year % 4 = 0")
def parse_names_first(spark, sf):
    """Records of the names-first PDF sources (heuristic route)."""
    return _out(_records(spark, sf).filter(F.col("route") == "names_first"))


_YEARS = "(SELECT DISTINCT year FROM pay) y"
_HDR = """CASE WHEN year % 2 = 1 THEN 'Club|Last Name|First Name|Position|Base Salary|Guaranteed Compensation'
  WHEN year % 4 = 0 THEN 'First|Name|Last|Name|Club|Position|Base|Salary|Guaranteed|Compensation'
  ELSE 'Club|Last|Name|First|Name|Pos|Base|Salary|Guaranteed|Comp' END"""


@query("header_rows", W + f"""
SELECT 'pay-' || CAST(year AS VARCHAR) AS source_id, CAST(1 AS BIGINT) AS header_row_no, {_HDR} AS header
FROM {_YEARS}""")
def header_rows(spark, sf):
    """The header row of every source."""
    h = H.find_headers(raw_pay(spark, sf))
    return h.select("source_id", "header_row_no", F.array_join("header", "|").alias("header"))


@query("column_map", W + f"""
SELECT 'pay-' || CAST(year AS VARCHAR) AS source_id,
  CASE WHEN year % 2 = 1 THEN 0 WHEN year % 4 = 0 THEN 4 ELSE 0 END AS club,
  CASE WHEN year % 2 = 1 THEN 1 WHEN year % 4 = 0 THEN 2 ELSE 1 END AS last_name,
  CASE WHEN year % 2 = 1 THEN 2 WHEN year % 4 = 0 THEN 0 ELSE 3 END AS first_name,
  CASE WHEN year % 2 = 1 THEN 3 WHEN year % 4 = 0 THEN 5 ELSE 5 END AS position,
  CASE WHEN year % 2 = 1 THEN 4 WHEN year % 4 = 0 THEN 6 ELSE 6 END AS base_salary,
  CASE WHEN year % 2 = 1 THEN 5 WHEN year % 4 = 0 THEN 8 ELSE 8 END AS guaranteed_comp,
  year % 4 <> 0 AS club_first,
  year % 4 <> 0 AS last_first,
  year % 2 = 1 AS index_route
FROM {_YEARS}""")
def column_map(spark, sf):
    """Column map, club-before-names flag, name order and parse route per source."""
    raw = raw_pay(spark, sf)
    h = H.header_table(raw)
    fmt = raw.select("source_id", "source_format").distinct()
    h = h.join(fmt, "source_id")
    return h.select("source_id", *[F.col(f"cmap.{f}").alias(f) for f in H.FIELDS],
                    "club_first", "last_first",
                    E.index_route(F.col("source_format"), F.col("cmap")).alias("index_route"))


_CELLS = f"""concat_ws('|', {_CLUB_TEXT},
  CASE WHEN record_id % 5 = 0 THEN '"' || last_name || '"' ELSE last_name END, COALESCE(first_name, ''), position,
  '$' || format('{{:,.2f}}', base_salary), '$' || format('{{:,.2f}}', guaranteed_comp))"""


@query("raw_cells_trim", W + f"""
SELECT 'pay-' || CAST(year AS VARCHAR) AS source_id, record_id * 10 + 10 AS row_no, {_CELLS} AS cells, 6 AS n_cells
FROM pay WHERE year % 2 = 1
UNION ALL
SELECT 'pay-' || CAST(year AS VARCHAR), record_id * 10 + 15,
  CASE WHEN record_id % 97 = 1 THEN '' ELSE 'SUBTOTAL|$1' END,
  CASE WHEN record_id % 97 = 1 THEN 1 ELSE 2 END
FROM pay WHERE year % 2 = 1 AND (record_id % 97 = 1 OR record_id % 89 = 3)
UNION ALL
SELECT 'pay-' || CAST(year AS VARCHAR), 0, CAST(year AS VARCHAR) || ' Payroll Report - Alphabetical List', 1
FROM {_YEARS} WHERE year % 2 = 1
UNION ALL
SELECT 'pay-' || CAST(year AS VARCHAR), 1, {_HDR}, 6 FROM {_YEARS} WHERE year % 2 = 1""")
def raw_cells_trim(spark, sf):
    """CSV document lines -> stripped cells (quoted cells unquoted)."""
    r = raw_pay(spark, sf).filter(F.col("source_format") == "csv")
    return r.select("source_id", "row_no", F.array_join("tokens", "|").alias("cells"),
                    F.size("tokens").alias("n_cells"))


@query("salary_etl_compat", W + _EXPECTED)
def salary_etl_compat(spark, sf):
    """T26 compat mode (code before names, lone '$' kept): same records on these documents."""
    return _out(_records(spark, sf, compat=True))


@query("union_years", W + _EXPECTED)
def union_years(spark, sf):
    """Records of the CSV documents and of the PDF documents, parsed separately and
    combined with UNION ALL by column name."""
    lookup = ClubLookup.from_dim(club_dim(spark, sf))
    raw = raw_pay(spark, sf)
    parts = [E.salary_records(raw.filter(F.col("source_format") == f), lookup) for f in ("csv", "pdf")]
    return _out(parts[0].unionByName(parts[1]))


@query("etl_team_spending", W + f"""
SELECT club, CAST(SUM(base_salary) AS DOUBLE) AS base_salary,
  CAST(SUM(guaranteed_comp) AS DOUBLE) AS guaranteed_comp, COUNT(last_name) AS player_count
FROM (SELECT year, CASE WHEN year % 2 = 1 THEN {_CLUB_TEXT} ELSE club END AS club, last_name,
             base_salary, guaranteed_comp FROM pay) r
GROUP BY club""")
def etl_team_spending(spark, sf):
    """Flagship: payroll documents -> salary records -> spending per club (T27 + A3)."""
    from ..operators import analytics as A
    return A.team_spending(_records(spark, sf))
