"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "paysheaf") -> SparkSession:
    """Build (or reuse) a session tuned for these jobs.

    On a cluster, ``master`` stays None and the launcher decides; the settings below
    are the ones the jobs rely on: AQE (coalesce small shuffles, split skewed join
    partitions), UTC session time, and no web UI.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_CKPT: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    ``spark.checkpoint.dir`` is a static setting, read here and never overwritten. Where it
    is missing, a local session (tests) gets a scratch folder; on a cluster that is an error,
    as executors would write to their own disks.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    key = id(sc)
    if key not in _LOCAL_CKPT:
        _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="paysheaf-ckpt-")
        sc.setCheckpointDir(_LOCAL_CKPT[key])
    return _LOCAL_CKPT[key]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Bytes (rows as JSON text) up to which a computed side is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def sized_broadcast(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when it holds at most ``max_rows`` rows and ``max_bytes`` bytes.

    The check reads at most ``max_rows + 1`` rows. Above a bound the frame is returned
    unhinted, so Catalyst/AQE choose a shuffle join instead of risking a driver OOM.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))
    n, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and held <= max_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row stages at least ``defaultParallelism`` partitions.

    For bare table scans only: counting the partitions of a frame that holds a shuffle would
    run it. Small inputs (one Parquet file) arrive as a single partition and would run on one
    core; those are repartitioned round-robin. Scans with enough splits are left as they are.
    """
    if df.isStreaming:
        return df
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


# Tasks for each split of a scan whose short rows become pages: a split of 128 MB holds millions of them, and a few
# tasks more than cores would leave most cores idle in the last round.
PAGE_TASKS = 64


def deal(df: DataFrame, scan: DataFrame) -> DataFrame:
    """Deal rows that are short, but costly in the stages behind, evenly over tasks: ``PAGE_TASKS`` for each split of the
    bare table ``scan`` they come from, so that their number grows with the table. Without it, splits of many short rows,
    or shuffle partitions merged for their few bytes, leave those stages to a few tasks."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, PAGE_TASKS * scan.rdd.getNumPartitions()))
