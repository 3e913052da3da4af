"""Writer round trips over the ``pay`` records (written under spark.checkpoint.dir)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schemas import SALARY_FIELDS
from ..sinks import writers as Wr
from ..session import cut_lineage
from ..sources.csv_blocks import csv_file_records
from ..sources.documents import csv_records, read_text_files
from ..sources.fixtures import link_pages, pay_records
from ..sources.links import club_links
from ..sources.tables import read_table
from .catalog import query
from .oracle_fixtures import LINKS, PAY, ROSTER, STATS_SRC, with_

W = with_(PAY)
YEAR = 1998
POSITION = "MAC"
CLUB = "NATION_7"
_REC = ("year, club, last_name, first_name, {pos}, CAST(base_salary AS DOUBLE) AS base_salary, "
        "CAST(guaranteed_comp AS DOUBLE) AS guaranteed_comp")


def _money_double(df):
    return df.select(*[F.col(c).cast("double").alias(c) if c in ("base_salary", "guaranteed_comp")
                       else F.col(c) for c in SALARY_FIELDS])


@query("scan_parquet", W + "SELECT " + _REC.format(pos="position") + " FROM pay")
def scan_parquet(spark, sf):
    """Records written as year-partitioned Parquet and read back."""
    path = Wr.write_records_by_year(pay_records(spark, sf), Wr.output_dir(spark, "parquet"), "parquet")
    return _money_double(Wr.read_records_parquet(spark, path))


@query("scan_csv_roundtrip", W + "SELECT " + _REC.format(pos="NULLIF(position, '') AS position") + " FROM pay")
def scan_csv_roundtrip(spark, sf):
    """Records written as CSV and read back (empty strings read as NULL)."""
    path = Wr.write_records_csv(pay_records(spark, sf), Wr.output_dir(spark, "csv"))
    return _money_double(Wr.read_records_csv(spark, path))


@query("sink_partitioned", W + "SELECT year, COUNT(*) AS n FROM pay GROUP BY year")
def sink_partitioned(spark, sf):
    """One CSV folder per year; read back with partition discovery."""
    path = Wr.write_records_by_year(pay_records(spark, sf), Wr.output_dir(spark, "by_year"), "csv")
    back = spark.read.option("header", True).csv(path)
    return back.groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("sink_partitioned_rows", W + "SELECT " + _REC.format(pos="NULLIF(position, '') AS position") + " FROM pay")
def sink_partitioned_rows(spark, sf):
    """All rows of the year folders, as the loader reads them."""
    path = Wr.write_records_by_year(pay_records(spark, sf), Wr.output_dir(spark, "by_year"), "csv")
    return _money_double(Wr.read_records_csv(spark, path))


@query("clustered_scan", W + "SELECT " + _REC.format(pos="position") + f" FROM pay WHERE club = '{CLUB}' AND year >= {YEAR}")
def clustered_scan(spark, sf):
    """W7 + F1/F2: records written in the order of year and club; one club of the later years read back."""
    path = Wr.write_clustered(pay_records(spark, sf), Wr.output_dir(spark, "clustered"))
    return _money_double(Wr.read_records_parquet(spark, path).filter((F.col("club") == CLUB) & (F.col("year") >= YEAR)))


@query("sink_overwrite_append", W + """
SELECT 'overwrite' AS step, COUNT(*) AS n FROM pay
UNION ALL SELECT 'append', 2 * COUNT(*) FROM pay
UNION ALL SELECT 'overwrite_again', COUNT(*) FROM pay""")
def sink_overwrite_append(spark, sf):
    """Table at a path — overwrite, append the same rows, overwrite again."""
    recs = pay_records(spark, sf)
    steps, parts = (("overwrite", "overwrite"), ("append", "append"), ("overwrite_again", "overwrite")), []
    for n, (step, _) in enumerate(steps, 1):
        # A table of its own for each number of steps, so that all of them can be read in one plan.
        path = Wr.output_dir(spark, f"table_{step}")
        for _, mode in steps[:n]:
            Wr.write_table(recs, path, mode)
        parts.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n"))
    return parts[0].union(parts[1]).union(parts[2])


@query("load_preferred", W + "SELECT " + _REC.format(pos="position") + " FROM pay")
def load_preferred(spark, sf):
    """Records written in all formats; the loader takes Parquet before CSV."""
    base = Wr.output_dir(spark, "all")
    Wr.write_records(pay_records(spark, sf), base, ["all"], split=True)
    return _money_double(Wr.load_records(spark, base))


@query("sink_teams", with_(LINKS) + """
SELECT upper(substr(slug, 1, 1)) || substr(replace(slug, '-', ' '), 2) AS name, slug,
  '/clubs/' || slug || '/roster/' AS roster_url, '/clubs/' || slug || '/stats/' AS stats_url
FROM links GROUP BY slug""")
def sink_teams(spark, sf):
    """Teams found on the pages, written as CSV and read back."""
    path = Wr.write_teams(club_links(link_pages(spark, sf)), Wr.output_dir(spark, "teams"))
    return spark.read.options(header=True, **Wr.CSV_OPTIONS).csv(path)


@query("sink_players", with_(ROSTER)[:-1] + """,
first_rows AS (SELECT * FROM roster_raw QUALIFY row_number() OVER (PARTITION BY team_slug, player_url
                                                                  ORDER BY page_id, table_no, row_no) = 1)
SELECT team_slug, COUNT(*) AS players FROM first_rows GROUP BY team_slug""")
def sink_players(spark, sf):
    """Players written as CSV (base and profile columns), read back and counted by team."""
    from .q_pages import _players
    path = Wr.write_players(_players(spark, sf), Wr.output_dir(spark, "players"))
    back = spark.read.options(header=True, multiLine=True, **Wr.CSV_OPTIONS).csv(path)
    return back.groupBy("team_slug").agg(F.count(F.lit(1)).alias("players"))


@query("sink_stats_by_team", with_(STATS_SRC) + "SELECT team_slug, COUNT(*) AS n FROM stats_src GROUP BY team_slug")
def sink_stats_by_team(spark, sf):
    """Flattened stats written as one CSV folder per team, read back by partition."""
    from .q_stats import _records
    path = Wr.write_stats(cut_lineage(_records(spark, sf)), Wr.output_dir(spark, "stats"), by_team=True)
    back = spark.read.options(header=True, multiLine=True, **Wr.CSV_OPTIONS).csv(path)
    return back.groupBy(F.col("team_slug").cast("string").alias("team_slug")).agg(F.count(F.lit(1)).alias("n"))


def _customer_records(spark, sf):
    """c_nationkey, c_custkey and a CSV record per customer: empty first cells, quotes and line ends in cells."""
    c = read_table(spark, sf, "customer", "c_nationkey", "c_custkey", "c_name", "c_mktsegment")
    record = F.concat(F.lit(',"'), "c_name", F.lit('\n""'), "c_mktsegment", F.lit('"", é",'), F.col("c_custkey").cast("string"), F.lit(","))
    return c.select("c_nationkey", "c_custkey", record.alias("value"))


@query("csv_block_cells", """
SELECT c_custkey, CAST(ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS BIGINT) AS row_no, 4 AS n_cells,
       c_name || chr(10) || '"' || c_mktsegment || '", é' AS second
FROM customer""")
def csv_block_cells(spark, sf):
    """One CSV file per nation, read in blocks; records numbered in the order of their file."""
    path = Wr.output_dir(spark, "csv_blocks")
    rows = _customer_records(spark, sf).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    rows.select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path)
    back = csv_file_records(spark, path, "part-*")
    return back.select(F.get("cells", F.lit(2)).cast("bigint").alias("c_custkey"), "row_no",
                       F.size("cells").alias("n_cells"), F.get("cells", F.lit(1)).alias("second"))


@query("csv_file_cells", """
SELECT c_custkey, 4 AS n_cells, '' AS first, c_name || chr(10) || '"' || c_mktsegment || '", é' AS second
FROM customer""")
def csv_file_cells(spark, sf):
    """CSV files with empty first cells, doubled quotes and line ends inside cells, decoded per file
    and cut into records and cells."""
    path = Wr.output_dir(spark, "csv_files")
    _customer_records(spark, sf).select("value").write.text(path)
    rows = csv_records(read_text_files(spark, path, "part-*"))
    return rows.select(F.get("cells", F.lit(2)).cast("bigint").alias("c_custkey"), F.size("cells").alias("n_cells"),
                       F.get("cells", F.lit(0)).alias("first"), F.get("cells", F.lit(1)).alias("second"))


@query("sql_params", W + f"""
SELECT club, COUNT(*) AS n, CAST(SUM(guaranteed_comp) AS DOUBLE) AS total
FROM pay WHERE year = {YEAR} AND position = '{POSITION}' GROUP BY club""")
def sql_params(spark, sf):
    """Q1: SQL with positional parameters over a DataFrame."""
    return Wr.sql(spark, "SELECT club, COUNT(*) AS n, CAST(SUM(guaranteed_comp) AS DOUBLE) AS total "
                         "FROM {s} WHERE year = ? AND position = ? GROUP BY club",
                  args=[YEAR, POSITION], s=pay_records(spark, sf))
