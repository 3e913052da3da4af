"""Writers (CSV, partitioned CSV/Parquet, path tables), readers for written records, and
parameterised SQL.

Every writer is a distributed ``DataFrameWriter`` call: output is a directory of part
files written by the executors (``single_file=True`` coalesces to one part, opt-in only).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PLAYER_FIELDS, SALARY_FIELDS, SALARY_RECORD, TEAM_FIELDS
from ..session import checkpoint_dir, cut_lineage

# Columns the salary table requires (NOT NULL).
REQUIRED_COLS = ("year", "club", "last_name", "base_salary", "guaranteed_comp")
FORMATS = ("csv", "parquet", "table")


def output_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return os.path.join(checkpoint_dir(spark), "out", f"{name}-{uuid.uuid4().hex[:12]}")


# Quotes inside a cell are doubled, blanks around a cell stay.
CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _csv(df: DataFrame, path: str, mode: str, single_file: bool, partition_by: Sequence[str] = ()):
    d = df.coalesce(1) if single_file else df
    w = d.write.mode(mode).options(header=True, **CSV_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_records_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> str:
    """Salary records -> CSV with header, in the fixed field order."""
    _csv(df.select(*SALARY_FIELDS), path, mode, single_file)
    return path


def write_records_by_year(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """One folder per year (``year=<y>``), so readers prune partitions by year."""
    # Rebalancing gathers a year's rows and still splits a large year over several tasks.
    d = df.select(*SALARY_FIELDS).hint("rebalance", "year")
    if fmt == "csv":
        _csv(d, path, mode, False, ["year"])
    else:
        d.write.mode(mode).partitionBy("year").parquet(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Parquet (snappy); map columns stay maps."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_clustered(df: DataFrame, path: str, keys: Sequence[str] = ("year", "club"), files: int | None = None,
                    group_bytes: int = 16 << 20, mode: str = "overwrite") -> str:
    """Parquet whose rows stand in the order of ``keys`` over all files, so that the statistics of files and
    row groups let a reader that filters by them skip the rest. ``files``: ranges to write (default: Spark's
    shuffle partitions); ``group_bytes``: size of a row group.

    Rows of one key value are told apart by a hash of the whole row, so that a value holding a third of the rows
    is cut into as many ranges as it needs; only rows that are equal in every column stay together. The input
    is read twice, as the ranges come from a sample. Null keys come first; maps and variants, which cannot be hashed,
    do not take part in the hash."""
    plain = [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    order = [*[F.col(c).asc_nulls_first() for c in keys], F.xxhash64(*plain)]
    ranges = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    (ranges.sortWithinPartitions(*order).write.mode(mode).option("parquet.block.size", group_bytes).parquet(path))
    return path


def not_null(df: DataFrame, cols: Iterable[str] = REQUIRED_COLS) -> DataFrame:
    """``df`` that fails when a row with NULL in a required column is read: the check is part of
    the written projection, so the input runs once."""
    def checked(c: str):
        stop = F.raise_error(F.lit(f"NULL in the required column {c}")).cast(df.schema[c].dataType)
        return F.coalesce(F.col(c), stop).alias(c)
    return df.select(*[checked(c) if c in set(cols) else F.col(c) for c in df.columns])


def replace_folder(df: DataFrame, path: str) -> None:
    """Write ``df`` beside ``path`` and put it there once all rows are written: a job that fails leaves what
    stood there, and ``df`` may read it. The exchange is two renames; a reader in between finds no table."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    tag = uuid.uuid4().hex
    here, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new-{tag}", f"{path}.old-{tag}"))
    fs = here.getFileSystem(conf)
    try:
        df.write.parquet(new.toString())
        had = fs.exists(here)
        if had and not fs.rename(here, old):
            raise OSError(f"cannot move the rows of {path} aside")
        if not fs.rename(new, here):
            if had:
                fs.rename(old, here)
            raise OSError(f"cannot put the new rows at {path}")
    except BaseException:
        fs.delete(new, True)
        raise
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Salary table at a path: 'overwrite' replaces it once all rows are written, 'append' adds rows;
    required columns are checked for NULL and a ``created_at`` timestamp is added. When a row fails the
    check, the table stays as it was in either mode."""
    out = not_null(df.select(*SALARY_FIELDS)).withColumn("created_at", F.current_timestamp())
    if mode == "overwrite":
        replace_folder(out, path)
    else:
        out.write.mode(mode).parquet(path)
    return path


def write_players(df: DataFrame, path: str, mode: str = "overwrite") -> str | None:
    """Players -> CSV: 12 base columns + sorted ``profile_*``; nothing for no rows."""
    from ..operators.stats import flatten_map
    # Read three times (any rows, keys, rows): the input behind it runs once.
    df = cut_lineage(df.select(*PLAYER_FIELDS, "profile"))
    if df.limit(1).count() == 0:
        return None
    flat = flatten_map(df, "profile", "profile_")
    _csv(flat, path, mode, False)
    return path


def write_teams(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Teams -> CSV with the 4 team columns (missing ones blank)."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in TEAM_FIELDS]
    _csv(df.select(*cols), path, mode, False)
    return path


def write_stats(records: DataFrame, path: str, by_team: bool = False, mode: str = "overwrite") -> str:
    """Stats records -> CSV (7 base + sorted stat_* + sorted profile_*); with
    ``by_team`` one folder per team (one shared column set)."""
    from ..operators.stats import flatten_stats
    flat = flatten_stats(records)
    _csv(flat, path, mode, False, ["team_slug"] if by_team else [])
    return path


def write_records(df: DataFrame, base: str, formats: Sequence[str] = ("csv",), split: bool = False) -> dict:
    """Write salary records in the chosen formats ('csv', 'parquet', 'table', 'all')."""
    fmts = FORMATS if "all" in formats else tuple(formats)
    out = {}
    for f in fmts:
        if f == "csv":
            out[f] = (write_records_by_year(df, os.path.join(base, "salaries_csv"), "csv") if split
                      else write_records_csv(df, os.path.join(base, "salaries_csv")))
        elif f == "parquet":
            out[f] = write_records_by_year(df, os.path.join(base, "salaries_parquet"), "parquet")
        elif f == "table":
            out[f] = write_table(df, os.path.join(base, "salaries_table"))
        else:
            raise ValueError(f"unknown format {f!r}")
    return out


# --- readers --------------------------------------------------------------------------------

def read_records_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Salary records from Parquet, explicit schema (partition column ``year`` included)."""
    return spark.read.schema(SALARY_RECORD).parquet(path).select(*SALARY_FIELDS)


def read_records_csv(spark: SparkSession, path: str, empty_as_null: bool = True) -> DataFrame:
    """Salary records from CSV with header, explicit schema (no inference).
    ``empty_as_null``: empty strings become NULL, as a CSV reader that cannot tell them
    apart reports them."""
    reader = spark.read.schema(SALARY_RECORD).options(header=True, multiLine=True, **CSV_OPTIONS)
    df = reader.csv(path).select(*SALARY_FIELDS)
    if empty_as_null:
        df = df.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name)
                         if f.dataType.simpleString() == "string" else F.col(f.name)
                         for f in SALARY_RECORD.fields])
    return df


def load_records(spark: SparkSession, base: str) -> DataFrame:
    """S3: Parquet records under ``base`` if present, else CSV, else an error."""
    for reader, sub in ((read_records_parquet, "salaries_parquet"), (read_records_csv, "salaries_csv")):
        try:
            df = reader(spark, os.path.join(base, sub))
            df.schema  # noqa: B018 - resolves the path now
            return df
        except AnalysisException:
            continue
    raise FileNotFoundError(f"no salary records under {base}")


def sql(spark: SparkSession, text: str, args: list | dict | None = None, **views: DataFrame) -> DataFrame:
    """Q1: parameterised SQL over DataFrames (``?`` or ``:name`` markers, no string pasting)."""
    return spark.sql(text, args=args, **views)
