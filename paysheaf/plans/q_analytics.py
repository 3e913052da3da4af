"""Analytics queries over the ``pay`` salary records (group-by, top-k, distribution)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import sketches as S
from ..sources.tables import read_table
from ..sources.fixtures import pay_records
from ..sinks.writers import output_dir
from .catalog import query
from .oracle_fixtures import PAY, with_

# Query parameters (fixed for the registered queries).
YEAR = 1998
CLUB = "NATION_7"
POSITION_PATTERN = "mac"
TOP_N = 10

W = with_(PAY)


def _mean(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})"


def _median(c: str) -> str:
    return f"CAST(round_even(CAST(quantile_cont(CAST({c} AS DOUBLE), 0.5) AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _sum(c: str) -> str:
    return f"CAST(COALESCE(SUM({c}), 0) AS DOUBLE)"


_TRENDS_COLS = ",\n".join(
    f"round_even({_mean(c)}, 2) AS {c}_mean, {_median(c)} AS {c}_median, "
    f"round_even(CAST(MIN({c}) AS DOUBLE), 2) AS {c}_min, "
    f"round_even(CAST(MAX({c}) AS DOUBLE), 2) AS {c}_max, "
    f"round_even({_sum(c)}, 2) AS {c}_sum"
    for c in A.MONEY_COLS)


@query("salary_trends", W + f"""
SELECT year, {_TRENDS_COLS}, COUNT(last_name) AS last_name_count
FROM pay WHERE year IS NOT NULL GROUP BY year ORDER BY year""")
def salary_trends(spark, sf):
    """A1: per-year mean/median/min/max/sum of both money columns."""
    return A.salary_trends(pay_records(spark, sf))


@query("salary_growth", W + f"""
SELECT year, avg_salary,
  round_even((avg_salary / NULLIF(LAG(avg_salary) OVER (ORDER BY year), 0) - 1.0) * 100.0, 2) AS growth_pct
FROM (SELECT year, {_mean('base_salary')} AS avg_salary FROM pay WHERE year IS NOT NULL GROUP BY year) t
ORDER BY year""")
def salary_growth(spark, sf):
    """A2: mean base salary per year and year-over-year change in percent."""
    return A.salary_growth(pay_records(spark, sf))


_SPEND = (f"{_sum('base_salary')} AS base_salary, {_sum('guaranteed_comp')} AS guaranteed_comp, "
          "COUNT(last_name) AS player_count")


@query("team_spending", W + f"""
SELECT club, {_SPEND} FROM pay WHERE club IS NOT NULL GROUP BY club
ORDER BY guaranteed_comp DESC NULLS LAST, club""")
def team_spending(spark, sf):
    """A3: total spending per club over all years."""
    return A.team_spending(pay_records(spark, sf))


@query("team_spending_year", W + f"""
SELECT club, {_SPEND} FROM pay WHERE club IS NOT NULL AND year = {YEAR} GROUP BY club
ORDER BY guaranteed_comp DESC NULLS LAST, club""")
def team_spending_year(spark, sf):
    """A3 + F1: spending per club in one year."""
    return A.team_spending(pay_records(spark, sf), YEAR)


@query("team_spending_full_domain", W + f"""
SELECT d.club, COALESCE(s.base_salary, 0.0) AS base_salary,
       COALESCE(s.guaranteed_comp, 0.0) AS guaranteed_comp,
       COALESCE(s.player_count, 0) AS player_count
FROM (SELECT DISTINCT club FROM pay WHERE club IS NOT NULL) d
LEFT JOIN (SELECT club, {_SPEND} FROM pay
           WHERE club IS NOT NULL AND year = 2001 AND position = 'AUT' GROUP BY club) s
  ON d.club = s.club""")
def team_spending_full_domain(spark, sf):
    """A3 with every club of the domain, also those without records in the slice."""
    # A narrow slice (one year, one position) so some clubs have no record in it.
    return A.team_spending_full_domain(pay_records(spark, sf), 2001,
                                       F.col("position") == "AUT")


@query("club_history", W + f"""
SELECT year, {_SPEND} FROM pay WHERE club = '{CLUB}' AND year IS NOT NULL GROUP BY year ORDER BY year""")
def club_history(spark, sf):
    """A4 + F2: one club's spending per year."""
    return A.club_history(pay_records(spark, sf), CLUB)


_CMP = ",\n".join(f"{_sum(c)} AS {c}_sum, {_mean(c)} AS {c}_mean, CAST(MAX({c}) AS DOUBLE) AS {c}_max"
                  for c in A.MONEY_COLS)


@query("team_comparison", W + f"""
SELECT club, {_CMP}, COUNT(last_name) AS last_name_count
FROM pay WHERE club IS NOT NULL AND year = {YEAR} GROUP BY club
ORDER BY guaranteed_comp_sum DESC NULLS LAST, club""")
def team_comparison(spark, sf):
    """A5: per-club sum/mean/max of both money columns in one year."""
    return A.team_comparison(pay_records(spark, sf), YEAR)


_POS = f"""SELECT position, {_mean('guaranteed_comp')} AS guaranteed_comp_mean,
  {_median('guaranteed_comp')} AS guaranteed_comp_median,
  CAST(MIN(guaranteed_comp) AS DOUBLE) AS guaranteed_comp_min,
  CAST(MAX(guaranteed_comp) AS DOUBLE) AS guaranteed_comp_max,
  COUNT(guaranteed_comp) AS guaranteed_comp_count
FROM pay WHERE position IS NOT NULL AND position <> '' {{extra}}
GROUP BY position ORDER BY guaranteed_comp_mean DESC NULLS LAST, position"""


@query("position_comparison", W + _POS.format(extra=""))
def position_comparison(spark, sf):
    """A6 + F4: guaranteed pay statistics per non-empty position."""
    return A.position_comparison(pay_records(spark, sf))


@query("position_comparison_year", W + _POS.format(extra=f"AND year = {YEAR}"))
def position_comparison_year(spark, sf):
    """A6 restricted to one year."""
    return A.position_comparison(pay_records(spark, sf), YEAR)


_TOP = """SELECT year, club, first_name, last_name, position,
  CAST(base_salary AS DOUBLE) AS base_salary, CAST(guaranteed_comp AS DOUBLE) AS guaranteed_comp
FROM pay {where} ORDER BY guaranteed_comp DESC NULLS LAST, record_id LIMIT {n}"""


@query("top_earners", W + _TOP.format(where="", n=TOP_N))
def top_earners(spark, sf):
    """The ten highest guaranteed packages."""
    return A.top_earners(pay_records(spark, sf), None, TOP_N)


@query("top_earners_year", W + _TOP.format(where=f"WHERE year = {YEAR}", n=TOP_N))
def top_earners_year(spark, sf):
    """A7 + F1: the ten highest packages of one year."""
    return A.top_earners(pay_records(spark, sf), YEAR, TOP_N)


@query("top_earners_position", W + _TOP.format(
    where=f"WHERE COALESCE(regexp_matches(position, '(?i){POSITION_PATTERN}'), false)", n=TOP_N))
def top_earners_position(spark, sf):
    """A8 + F3: top packages among positions matching a case-insensitive regex."""
    return A.top_earners_position(pay_records(spark, sf), POSITION_PATTERN, None, TOP_N)


@query("top_n_per_year", W + """
SELECT year, club, first_name, last_name, position, CAST(guaranteed_comp AS DOUBLE) AS guaranteed_comp
FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY guaranteed_comp DESC NULLS LAST, record_id) AS rn
      FROM pay WHERE year IS NOT NULL) t
WHERE rn <= 3 ORDER BY year, rn""")
def top_n_per_year(spark, sf):
    """The three highest packages of every year."""
    return A.top_n_per_year(pay_records(spark, sf), 3)


_DIST = """SELECT COUNT(*) AS count, {mean} AS mean, {median} AS median,
  round_even(stddev_samp(CAST(guaranteed_comp AS DOUBLE)), 2) AS std,
  CAST(MIN(guaranteed_comp) AS DOUBLE) AS min, CAST(MAX(guaranteed_comp) AS DOUBLE) AS max,
  CAST(round_even(CAST(quantile_cont(CAST(guaranteed_comp AS DOUBLE), 0.25) AS DECIMAL(38,6)), 2) AS DOUBLE) AS q25,
  CAST(round_even(CAST(quantile_cont(CAST(guaranteed_comp AS DOUBLE), 0.75) AS DECIMAL(38,6)), 2) AS DOUBLE) AS q75,
  CAST(round_even(CAST(quantile_cont(CAST(guaranteed_comp AS DOUBLE), 0.90) AS DECIMAL(38,6)), 2) AS DOUBLE) AS q90,
  CAST(round_even(CAST(quantile_cont(CAST(guaranteed_comp AS DOUBLE), 0.99) AS DECIMAL(38,6)), 2) AS DOUBLE) AS q99
FROM pay {where}"""


@query("salary_distribution", W + _DIST.format(
    mean=_mean("guaranteed_comp"), median=_median("guaranteed_comp"), where=""))
def salary_distribution(spark, sf):
    """A10: distribution statistics of guaranteed pay."""
    return A.salary_distribution(pay_records(spark, sf))


@query("salary_distribution_year", W + _DIST.format(
    mean=_mean("guaranteed_comp"), median=_median("guaranteed_comp"), where=f"WHERE year = {YEAR}"))
def salary_distribution_year(spark, sf):
    """A10 + F1: distribution statistics of one year."""
    return A.salary_distribution(pay_records(spark, sf), YEAR)


@query("salary_percentiles", W + """
SELECT p, CAST(round_even(CAST(v AS DECIMAL(38,6)), 2) AS DOUBLE) AS value
FROM (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]::DOUBLE[]) AS p,
             unnest(quantile_cont(CAST(guaranteed_comp AS DOUBLE),
                                  [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])) AS v
      FROM pay) t
ORDER BY p""")
def salary_percentiles(spark, sf):
    """Guaranteed pay at seven percentiles, one row each."""
    return A.salary_percentiles(pay_records(spark, sf))


@query("percentiles_approx", "SELECT p, TRUE AS within_error FROM (VALUES "
       + ", ".join(f"(CAST({p} AS DOUBLE))" for p in A.PERCENTILE_PS) + ") t(p) ORDER BY p")
def percentiles_approx(spark, sf):
    """Approximate percentiles (sketch based); whether each value's exact rank is within the
    sketch's error of the wanted rank."""
    return A.percentile_rank_check(pay_records(spark, sf))


_PS = ", ".join(f"CAST({p} AS DOUBLE)" for p in A.PERCENTILE_PS)
_SKETCHED = """
SELECT {by}, unnest([""" + _PS + """]) AS p, n, TRUE AS within_error
FROM (SELECT {by}, COUNT(guaranteed_comp) AS n FROM pay WHERE {where} GROUP BY {by}) t WHERE n > 0"""


def _sketches(spark, sf):
    recs = pay_records(spark, sf)
    return recs, S.read_sketches(spark, S.write_sketches(recs, output_dir(spark, "sketches")))


@query("sketch_percentiles", W + _SKETCHED.format(by="year", where="year IS NOT NULL"))
def sketch_percentiles(spark, sf):
    """Percentiles of each year, merged from the stored sketches of each (year, club)."""
    recs, kept = _sketches(spark, sf)
    return S.rank_check(S.sketch_percentiles(kept.filter("year IS NOT NULL"), ["year"]), recs, ["year"])


@query("sketch_percentiles_club", W + _SKETCHED.format(by="club", where=f"year = {YEAR} AND club IS NOT NULL"))
def sketch_percentiles_club(spark, sf):
    """A12 + F1: percentiles of each club in one year, from the same stored sketches."""
    recs, kept = _sketches(spark, sf)
    answers = S.sketch_percentiles(kept.filter((F.col("year") == YEAR) & F.col("club").isNotNull()), ["club"])
    return S.rank_check(answers, A.by_year(recs, YEAR), ["club"])


@query("sql_avg_by_position", W + f"""
SELECT position, {_mean('guaranteed_comp')} AS avg_salary FROM pay
WHERE year = {YEAR} AND position <> '' GROUP BY position ORDER BY avg_salary DESC, position""")
def sql_avg_by_position(spark, sf):
    """A13 + F9: average pay per position through ``spark.sql`` with a bound parameter."""
    recs = pay_records(spark, sf)
    return spark.sql(
        "SELECT position, try_divide(CAST(SUM(guaranteed_comp) AS DOUBLE), COUNT(guaranteed_comp)) "
        "AS avg_salary FROM {recs} WHERE year = :year AND position != '' "
        "GROUP BY position ORDER BY avg_salary DESC, position",
        args={"year": YEAR}, recs=recs)


@query("count_by_position", W + """
SELECT position, COUNT(*) AS n FROM pay WHERE position IS NOT NULL GROUP BY position ORDER BY position""")
def count_by_position(spark, sf):
    """Group size per position."""
    return A.count_by(pay_records(spark, sf), "position")


@query("count_records", W + "SELECT COUNT(*) AS n FROM pay")
def count_records(spark, sf):
    """Number of records."""
    return A.count_records(pay_records(spark, sf))


@query("count_records_year", W + f"SELECT COUNT(*) AS n FROM pay WHERE year = {YEAR}")
def count_records_year(spark, sf):
    """A16 + F1: number of records in one year."""
    return A.count_records(pay_records(spark, sf), YEAR)


@query("distinct_years", W + "SELECT DISTINCT year FROM pay WHERE year IS NOT NULL ORDER BY year")
def distinct_years(spark, sf):
    """The years present."""
    return A.distinct_values(pay_records(spark, sf), "year")


@query("distinct_clubs", W + f"""
SELECT DISTINCT club FROM pay WHERE club IS NOT NULL AND year = {YEAR} ORDER BY club""")
def distinct_clubs(spark, sf):
    """The clubs of one year."""
    return A.distinct_values(pay_records(spark, sf), "club", YEAR)


_CLUBS = [f"NATION_{k}" for k in range(25)]
_PIVOT = ", ".join(f"""CAST(SUM(guaranteed_comp) FILTER (WHERE club = '{c}') AS DOUBLE) AS "{c}\"""" for c in sorted(_CLUBS))


@query("spending_pivot", W + f"SELECT year, {_PIVOT} FROM pay WHERE year IS NOT NULL AND club IS NOT NULL GROUP BY year ORDER BY year")
def spending_pivot(spark, sf):
    """Year × club table of total guaranteed pay for the clubs of the nation table (25 rows, read first)."""
    clubs = [r[0] for r in read_table(spark, sf, "nation", "n_name").distinct().orderBy("n_name").collect()]
    return A.spending_pivot(pay_records(spark, sf), clubs)
