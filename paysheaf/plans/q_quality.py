"""Data-quality queries over the ``pay`` salary records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import similar_clubs
from ..operators.analytics import MONEY_COLS
from ..schemas import SALARY_FIELDS
from ..sources.fixtures import club_spellings, club_typos, pay_records
from .catalog import query
from .oracle_fixtures import CLUB_SPELLINGS, CLUB_TYPOS, PAY, with_

W = with_(PAY)
STRING_FIELDS = ("club", "last_name", "first_name", "position")


def _records(spark, sf):
    return pay_records(spark, sf).select(*SALARY_FIELDS)


_MISSING = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    + (f"COUNT(*) FILTER (WHERE {c} = '')" if c in STRING_FIELDS else "CAST(0 AS BIGINT)")
    + " AS empties FROM pay"
    for c in SALARY_FIELDS)


@query("dq_missing", W + _MISSING)
def dq_missing(spark, sf):
    """NULL and empty-string counts per column."""
    return Q.dq_missing(_records(spark, sf)).withColumnRenamed("column", "column_name")


_FENCES = """, q AS (SELECT quantile_cont(CAST(guaranteed_comp AS DOUBLE), 0.25) AS q1,
                   quantile_cont(CAST(guaranteed_comp AS DOUBLE), 0.75) AS q3 FROM pay),
b AS (SELECT round(q1 - 1.5 * (q3 - q1), 6) AS lo, round(q3 + 1.5 * (q3 - q1), 6) AS hi FROM q)
"""
_OUT = "(CAST(guaranteed_comp AS DOUBLE) < lo OR CAST(guaranteed_comp AS DOUBLE) > hi)"


@query("dq_outliers", W[:-1] + _FENCES + f"""
SELECT round_even(lo, 2) AS lower_bound, round_even(hi, 2) AS upper_bound,
  COUNT(*) FILTER (WHERE {_OUT}) AS outlier_count,
  COUNT(*) FILTER (WHERE guaranteed_comp = 0) AS zero_salary_count,
  COUNT(*) FILTER (WHERE guaranteed_comp < 0) AS negative_salary_count
FROM pay, b GROUP BY lo, hi""")
def dq_outliers(spark, sf):
    """IQR fences and outlier / zero / negative counts."""
    return Q.dq_outliers(_records(spark, sf))


@query("dq_outlier_rows", W[:-1] + _FENCES + f"""
SELECT year, club, last_name, first_name, position, CAST(base_salary AS DOUBLE) AS base_salary,
  CAST(guaranteed_comp AS DOUBLE) AS guaranteed_comp, record_id
FROM pay, b WHERE {_OUT}""")
def dq_outlier_rows(spark, sf):
    """The records outside the IQR fences."""
    rows = Q.dq_outlier_rows(pay_records(spark, sf))
    return rows.select(*[F.col(c).cast("double").alias(c) if c in MONEY_COLS else F.col(c)
                         for c in rows.columns])


@query("dq_positions", W + """
SELECT COUNT(*) FILTER (WHERE position IS NULL OR position = '') AS missing_position_count,
  CAST(COUNT(*) FILTER (WHERE position IS NULL OR position = '') AS DOUBLE) / COUNT(*) * 100.0
    AS missing_position_pct,
  COUNT(DISTINCT position) AS unique_positions
FROM pay""")
def dq_positions(spark, sf):
    """D3: missing and distinct positions."""
    return Q.dq_positions(_records(spark, sf))


@query("dq_position_top20", W + """
SELECT position, COUNT(*) AS n FROM pay WHERE position IS NOT NULL GROUP BY position
ORDER BY n DESC, position LIMIT 20""")
def dq_position_top20(spark, sf):
    """D3: the twenty most frequent positions."""
    return Q.dq_position_top(_records(spark, sf))


_DUPS = """SELECT year, last_name, first_name, COUNT(*) AS n FROM pay
WHERE year IS NOT NULL AND last_name IS NOT NULL AND first_name IS NOT NULL
GROUP BY year, last_name, first_name HAVING COUNT(*) > 1"""


@query("dq_duplicates", W + _DUPS + " ORDER BY year, last_name, first_name LIMIT 20")
def dq_duplicates(spark, sf):
    """The first twenty repeated (year, last, first) groups in key order."""
    return Q.dq_duplicates(_records(spark, sf))


@query("dq_duplicate_count", W + f"SELECT COUNT(*) AS duplicate_count FROM ({_DUPS}) t")
def dq_duplicate_count(spark, sf):
    """Number of repeated (year, last, first) groups."""
    return Q.dq_duplicate_count(_records(spark, sf))


_ALL_SET = " AND ".join(f"{c} IS NOT NULL" for c in SALARY_FIELDS)


@query("dq_summary", W + f"""
SELECT COUNT(*) AS total_records,
  COUNT(*) FILTER (WHERE {_ALL_SET}) AS complete_records,
  COALESCE(CAST(COUNT(*) FILTER (WHERE {_ALL_SET}) AS DOUBLE) / NULLIF(COUNT(*), 0) * 100.0, 0.0)
    AS completeness_pct,
  array_to_string(list_sort(list_distinct(list(year))), ',') AS years_covered,
  COUNT(DISTINCT year) AS year_count, COUNT(DISTINCT club) AS club_count
FROM pay""")
def dq_summary(spark, sf):
    """Record counts, completeness and coverage."""
    return Q.dq_summary(_records(spark, sf))


@query("dq_clubs", W + "SELECT club, COUNT(*) AS n FROM pay GROUP BY club ORDER BY club NULLS LAST")
def dq_clubs(spark, sf):
    """Distinct clubs with record counts."""
    return Q.dq_clubs(_records(spark, sf))


_FOLD = (r"trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(club)), "
         r"'[^\p{L}\p{N}\p{M}_\s]', '', 'g'), '\b(fc|sc|cf)\b', ' ', 'g'), '\s+', ' ', 'g'))")


@query("dq_club_variants", with_(PAY, CLUB_SPELLINGS) + f"""
SELECT club_key, COUNT(*) AS n_spellings, array_to_string(list_sort(list(club)), ' | ') AS spellings
FROM (SELECT DISTINCT {_FOLD} AS club_key, club FROM club_spellings WHERE club IS NOT NULL) t
GROUP BY club_key HAVING COUNT(*) > 1 ORDER BY club_key""")
def dq_club_variants(spark, sf):
    """Clubs written in more than one way (folded key, spellings)."""
    return Q.dq_club_variants(club_spellings(spark, sf))


_SIMILAR = f"""
k AS (SELECT * FROM (SELECT {_FOLD} AS club_key, COUNT(*) AS n FROM club_typos WHERE club IS NOT NULL GROUP BY 1) f WHERE club_key <> ''),
l AS (SELECT a.club_key AS a, b.club_key AS b, a.n AS n_a, b.n AS n_b FROM k a, k b
      WHERE a.club_key <> b.club_key AND levenshtein(a.club_key, b.club_key) = 1 AND length(a.club_key) >= 4 AND length(b.club_key) >= 4
        AND regexp_replace(a.club_key, '[^0-9]', '', 'g') = regexp_replace(b.club_key, '[^0-9]', '', 'g'))"""


@query("dq_similar_clubs", with_(PAY, CLUB_TYPOS) + f""", {_SIMILAR}
SELECT a AS club_key_a, b AS club_key_b, n_a, n_b FROM l WHERE a < b""")
def dq_similar_clubs(spark, sf):
    """Folded club names one letter apart, with their records."""
    return similar_clubs.dq_similar_clubs(club_typos(spark, sf))


@query("club_groups", with_(PAY, CLUB_TYPOS).replace("WITH", "WITH RECURSIVE", 1) + f""", {_SIMILAR},
p AS (SELECT a, first(b ORDER BY n_b DESC, b) AS parent FROM l WHERE n_b > n_a OR (n_b = n_a AND b < a) GROUP BY a),
r AS (SELECT club_key, n, club_key AS top FROM k UNION ALL SELECT r.club_key, r.n, p.parent FROM r JOIN p ON p.a = r.top)
SELECT club_key, n, top AS group_key FROM r WHERE top NOT IN (SELECT a FROM p)""")
def club_groups(spark, sf):
    """Every folded club name with the name it is counted under."""
    return similar_clubs.club_groups(club_typos(spark, sf))


def _metric(check: str, name: str, expr: str, frm: str = "pay") -> str:
    return f"SELECT '{check}' AS \"check\", '{name}' AS metric, CAST({expr} AS DOUBLE) AS value FROM {frm}"


_REPORT_PARTS = [
    _metric("summary", "total_records", "COUNT(*)"),
    _metric("summary", "complete_records", f"COUNT(*) FILTER (WHERE {_ALL_SET})"),
    _metric("summary", "completeness_pct",
            f"COALESCE(CAST(COUNT(*) FILTER (WHERE {_ALL_SET}) AS DOUBLE) / NULLIF(COUNT(*), 0) * 100.0, 0.0)"),
    _metric("summary", "year_count", "COUNT(DISTINCT year)"),
    _metric("summary", "club_count", "COUNT(DISTINCT club)"),
    _metric("salary_outliers", "lower_bound", "round_even(lo, 2)", "b"),
    _metric("salary_outliers", "upper_bound", "round_even(hi, 2)", "b"),
    _metric("salary_outliers", "outlier_count", f"COUNT(*) FILTER (WHERE {_OUT})", "pay, b"),
    _metric("salary_outliers", "zero_salary_count", "COUNT(*) FILTER (WHERE guaranteed_comp = 0)"),
    _metric("salary_outliers", "negative_salary_count", "COUNT(*) FILTER (WHERE guaranteed_comp < 0)"),
    _metric("invalid_positions", "missing_position_count",
            "COUNT(*) FILTER (WHERE position IS NULL OR position = '')"),
    _metric("invalid_positions", "missing_position_pct",
            "CAST(COUNT(*) FILTER (WHERE position IS NULL OR position = '') AS DOUBLE) / COUNT(*) * 100.0"),
    _metric("invalid_positions", "unique_positions", "COUNT(DISTINCT position)"),
    _metric("duplicate_players", "duplicate_count", "COUNT(*)", f"({_DUPS}) d"),
]
for _c in SALARY_FIELDS:
    _REPORT_PARTS.append(_metric("missing_values", f"null_values.{_c}", f"COUNT(*) FILTER (WHERE {_c} IS NULL)"))
    if _c in STRING_FIELDS:
        _REPORT_PARTS.append(_metric("missing_values", f"empty_strings.{_c}",
                                     f"COUNT(*) FILTER (WHERE {_c} = '')"))


_REPORT_PARTS += [
    _metric("club_variations", "unique_clubs", "COUNT(DISTINCT club)"),
    f"""SELECT 'club_variations', 'spellings.' || club_key, CAST(COUNT(*) AS DOUBLE)
FROM (SELECT DISTINCT {_FOLD} AS club_key, club FROM pay WHERE club IS NOT NULL) t WHERE club_key <> ''
GROUP BY club_key HAVING COUNT(*) > 1""",
    """SELECT 'invalid_positions', 'position_distribution.' || position, CAST(n AS DOUBLE) FROM (
SELECT position, COUNT(*) AS n FROM pay WHERE position IS NOT NULL GROUP BY position
ORDER BY n DESC, position LIMIT 20) p""",
]


@query("dq_report", W[:-1] + _FENCES + "\nUNION ALL\n".join(_REPORT_PARTS))
def dq_report(spark, sf):
    """All checks in one long table (check, metric, value)."""
    return Q.dq_report(_records(spark, sf))
