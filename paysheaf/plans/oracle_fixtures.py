"""DuckDB text of the fixture adapters, used as CTEs by the oracle queries.

These read the same given tables as ``sources/fixtures.py``; they are the independent
side of the correctness check (SQL vs DataFrame code), so they are written from the
fixture definitions, not from the Spark code.
"""

PAY = """pay AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS club, c_name AS last_name,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE 'F' || CAST(o_custkey % 7 AS VARCHAR) END AS first_name,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE substr(c_mktsegment, 1, 3) END AS position,
    CAST(o_totalprice AS DECIMAL(18,2)) AS base_salary,
    CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0
              WHEN o_orderkey % 101 = 0 THEN 5 * CAST(o_totalprice AS DECIMAL(18,2))
              ELSE CAST(o_totalprice AS DECIMAL(18,2)) + 10 * CAST(c_acctbal AS DECIMAL(18,2)) END
         AS DECIMAL(18,2)) AS guaranteed_comp,
    o_orderkey AS record_id, r_name AS region, n_nationkey AS nk
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CLUB_SPELLINGS = """club_spellings AS (
  SELECT * REPLACE (CASE record_id % 4 WHEN 0 THEN club WHEN 1 THEN lower(club)
                         WHEN 2 THEN club || ' FC' ELSE translate(club, 'AO', 'ÁÖ') END AS club)
  FROM pay
)"""


CLUB_TYPOS = """club_typos AS (
  SELECT record_id, CASE WHEN record_id % 20 <> 0 THEN club
                         WHEN record_id % 60 = 0 THEN club[1:place - 1] || club[place + 1:]
                         WHEN record_id % 60 = 20 THEN club[1:place] || club[place:]
                         ELSE club[1:place - 1] || 'x' || club[place + 1:] END AS club
  FROM (SELECT record_id, club, (record_id // 20) % length(club) + 1 AS place FROM pay) t
)"""


DIRTY_STRINGS = """dirty_strings AS (
  SELECT c_custkey AS id,
    CASE c_custkey % 8
      WHEN 0 THEN '$' || format('{:,.2f}', CAST(c_acctbal AS DECIMAL(18,2)))
      WHEN 1 THEN format('{:,.2f}', CAST(c_acctbal AS DECIMAL(18,2))) || '$'
      WHEN 2 THEN '  $' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || chr(9)
      WHEN 3 THEN ''
      WHEN 4 THEN NULL
      WHEN 5 THEN '-'
      WHEN 6 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '.5'
      ELSE '$ ' || format('{:,.2f}', CAST(c_acctbal AS DECIMAL(18,2))) END AS money_raw,
    CASE c_custkey % 5
      WHEN 0 THEN '  "' || c_name || '"  '
      WHEN 1 THEN '''' || c_name || ''''
      WHEN 2 THEN '"''' || c_name || '''"'
      WHEN 3 THEN chr(9) || c_name || ' ' || chr(10)
      ELSE NULL END AS name_raw,
    CASE c_custkey % 4
      WHEN 0 THEN ' ' || lower(substr(c_mktsegment, 1, 3)) || '-f '
      WHEN 1 THEN substr(c_mktsegment, 1, 2) || '/' || substr(c_mktsegment, 3, 1)
      WHEN 2 THEN c_mktsegment
      ELSE '' END AS code_raw,
    replace(c_name, '#', ':  ' || chr(9) || '(#')
      || CASE c_custkey % 3 WHEN 0 THEN ' Ht. (cm)' WHEN 1 THEN '  ' ELSE '' END AS text_raw,
    CASE c_custkey % 3
      WHEN 0 THEN '#' || CAST(c_custkey % 100 AS VARCHAR)
      WHEN 1 THEN 'No. ' || CAST(c_custkey % 10 AS VARCHAR) || ' / 8'
      ELSE '--' END AS jersey_raw,
    c_name
  FROM customer
)"""

# Whitespace class equal to Python's str.split() set, for RE2.
WS = r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\p{Z}]"


# Pages of ``link_pages`` are generated from orders; the oracle rebuilds their links.
LINKS = """links AS (
  SELECT o_orderkey AS page_id, CAST(year(o_orderdate) + 25 AS INTEGER) AS y, o_orderkey AS k,
         lower(replace(replace(n_name, '_', '-'), ' ', '-')) AS slug
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


# Roster pages (one per order): the player row of the roster table (behind a row that holds a table, on
# some pages) and, every fourth page, the repeated player row of a later table.
ROSTER = """roster_src AS (
  SELECT o_orderkey AS page_id, c_custkey, c_name, o_orderpriority, o_orderstatus, c_mktsegment,
         lower(replace(replace(n_name, '_', '-'), ' ', '-')) AS team_slug
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
roster_raw AS (
  SELECT page_id, 0 AS table_no, CASE WHEN page_id % 6 IN (1, 2) THEN 2 ELSE 1 END AS row_no, c_name AS player_name,
    'https://league.example/players/c' || c_custkey || '/' AS player_url,
    '/img/c' || c_custkey || '.png' AS player_image_thumb,
    '#' || CAST(c_custkey % 99 AS VARCHAR) AS jersey_number,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE substr(c_mktsegment, 1, 1) END AS position,
    CASE WHEN page_id % 2 = 0 THEN 'Senior' ELSE 'Supplemental' END AS roster_category,
    CASE WHEN page_id % 7 = 0 THEN 'Designated  Player' ELSE NULL END AS player_category,
    CASE WHEN o_orderstatus = 'F' THEN 'Active' ELSE 'Injured' END AS player_status,
    team_slug
  FROM roster_src
  UNION ALL
  SELECT page_id, CASE WHEN page_id % 6 = 2 THEN 2 ELSE 1 END, 1, c_name, 'https://league.example/players/c' || c_custkey || '/', NULL, NULL, 'X',
    NULL, NULL, NULL, team_slug
  FROM roster_src WHERE page_id % 4 = 0
)"""

STATS_SRC = """stats_src AS (
  SELECT event_id AS page_id, event_type AS team_slug, CAST(year(ts) AS INTEGER) AS season,
    ['general', 'passing', 'attacking', 'defending', 'goalkeeping'][CAST(event_id % 5 AS INTEGER) + 1] AS stat_type,
    'Player ' || user_id AS player_name, 'https://league.example/players/u' || user_id || '/' AS player_url,
    '/img/u' || user_id || '.png' AS player_image, upper(event_type) AS club,
    CAST(event_id % 30 AS VARCHAR) AS games_played,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value,
    json_extract_string(props, '$.k') AS k
  FROM events
),
profiles AS (
  SELECT 'https://league.example/players/u' || (c_custkey * 2) || '/' AS player_url, c_custkey AS fetch_order,
    c_name AS full_name, '  ' || c_mktsegment || ' ' AS position, '' AS height
  FROM customer
  UNION ALL
  SELECT 'https://league.example/players/u' || (s_suppkey * 3) || '/', 1000000000 + s_suppkey, s_name, 'SUP', NULL
  FROM supplier
),
profile1 AS (
  SELECT player_url, arg_min(full_name, fetch_order) AS full_name, arg_min(position, fetch_order) AS position,
    arg_min(height, fetch_order) AS height, bool_or(fetch_order < 1000000000) AS from_customer
  FROM profiles GROUP BY player_url
)"""


PROFILE_SRC = """profile_src AS (
  SELECT c_custkey AS page_id, 'https://league.example/players/c' || c_custkey || '/' AS player_url,
    'date_of_birth=19' || CAST(70 + c_custkey % 30 AS VARCHAR) || ' (age ?);height_cm='
      || CASE WHEN c_custkey % 4 = 0 THEN '199' ELSE CAST(170 + c_custkey % 30 AS VARCHAR) END
      || ';position=' || c_mktsegment AS details,
    '/big/c' || c_custkey || '.jpg' AS player_image, c_name AS full_name,
    '/logo/' || lower(replace(replace(n_name, '_', '-'), ' ', '-')) || '.svg' AS team_logo,
    lower(replace(replace(n_name, '_', '-'), ' ', '-')) AS club_slug,
    CAST(c_custkey % 99 AS VARCHAR) AS jersey_number_profile, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""
