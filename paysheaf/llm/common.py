"""Helpers shared by the corpus operators: table access, lineage cuts, sized broadcasts, running totals."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Whitespace that separates words, as the inside of a character class.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows with 8-byte keys that may be broadcast: about 50 MB as a hash table with its copy at the driver.
BROADCAST_KEYS = 400_000

#: Bytes of an Arrow batch sent to Python while a stored frame is computed (rows of any length).
BATCH_BYTES = 8 << 20

_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for local masters without it."""
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if named:
        return named
    master = conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="llm-shared-")
    return _LOCAL[app]


#: Settings for the jobs that store a frame: small Arrow batches, and shuffle files that go when the frame is written, not
#: when the driver happens to collect its garbage.
STORING = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def storing(spark: SparkSession) -> Iterator[None]:
    """``STORING`` for the jobs run inside; the session's settings come back after."""
    before = {name: spark.conf.get(name) for name in STORING}
    for name, value in STORING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: the lineage is cut, and lost
    executors cost no recomputation of what stands before."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}/{tag}.parquet"
    with storing(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing reads any more: every frame computed from them must
    have been stored itself."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path.getParent(), True)


def small(df: DataFrame, max_rows: int = BROADCAST_KEYS) -> DataFrame:
    """Broadcast a stored frame of fixed-width rows if a count shows at most ``max_rows``; else leave
    the join to a shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base = f"_{base}"
    return base


def hash_bin(h: Column, bits: int) -> Column:
    """The top ``bits`` bits of a 64-bit hash: bins in the order of ``order_hash``."""
    return F.shiftrightunsigned(h, 64 - bits).cast("long")


def order_hash(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def bin_bits(rows: int, per_bin: int = 500) -> int:
    """Bits of hash that leave about ``per_bin`` rows in a bin."""
    return max(8, min(40, (max(rows, 1) // per_bin).bit_length()))


def running_before(df: DataFrame, by: list[str], bin_col: str, order: list[Column], value: str,
                   out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``by`` that come earlier.

    ``bin_col`` must rise with ``order``. Bins are summed first (partial aggregation), the short table
    of bins gets its running totals, and rows are ordered only inside their bin, so that one large
    ``by`` group is dealt over as many tasks as it has bins. ``by`` and ``bin_col`` hold no nulls.
    """
    base = fresh(df, "bin_base")
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ahead = part.orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
    bins = df.groupBy(*by, bin_col).agg(F.sum(value).alias(base))
    bins = bins.withColumn(base, F.coalesce(F.sum(base).over(ahead), F.lit(0)))
    inside = Window.partitionBy(*by, bin_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(bins, [*by, bin_col])
    return joined.withColumn(out, F.col(base) + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop(base)
