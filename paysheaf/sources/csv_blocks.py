"""CSV files of any size read in many tasks: records may hold line ends inside quotes, also at block borders.

Spark's text source cuts a file into blocks at line ends. Whether a line starts inside a quoted cell depends on all
lines before it, so each line is first reduced to what it does to that state: keep it, turn it over, or fix it.
These effects are put together in three steps: a window inside each block, a short table of one row per block
with running totals over each file, and the block's start state brought back to its lines. A line that starts
outside quotes opens a record; the number of lines that do so before it is the record's number in the file.
Records of one line are parsed where they are; only the lines of longer records are grouped.

A file is UTF-8 if all its lines are, else Latin-1 as a whole.

Defined results: an empty file gives no record, an empty line a record without cells; a line end is
'\\n', '\\r\\n' or a lone '\\r'; a quote that is never closed makes the rest of the file one cell; a byte order
mark at the start of a file is dropped by the text source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .documents import csv_cells

# A closed field of one line: quoted only if the quote is its first character.
_CLOSED = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,\r]*+|(?!")[^,\r]*+)'
_ENDS_OUTSIDE = rf"\A{_CLOSED}(?:,{_CLOSED})*+\r?\z"
_LEAVES_QUOTES = rf'\A[^"]*+(?:""[^"]*+)*+"[^,\r]*+(?:,{_CLOSED})*+\r?\z'


def physical_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, block, at (rises inside a block), piece, line (bytes as Latin-1 characters), end, valid (UTF-8)."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.is_valid_utf8("value").alias("valid"),
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"))
    pieces = raw.select("path", "block", "at", "valid", F.posexplode(F.split("line", r"\r(?!\z)", -1)).alias("piece", "line"),
                        F.size(F.split("line", r"\r(?!\z)", -1)).alias("n"))
    return pieces.withColumn("end", F.when(F.col("piece") == F.col("n") - 1, "\n").otherwise("\r")).drop("n")


def with_effect(lines: DataFrame) -> DataFrame:
    """Add ``fixed`` (1 inside, 0 outside quotes after the line, null where it depends) and ``turned`` (0 or 1)."""
    quoted = F.contains("line", F.lit('"'))
    from_outside = F.when(quoted & ~F.rlike("line", F.lit(_ENDS_OUTSIDE)), 1).otherwise(0)
    from_inside = F.when(quoted & F.rlike("line", F.lit(_LEAVES_QUOTES)), 0).otherwise(1)
    d = lines.withColumn("from_outside", from_outside).withColumn("from_inside", from_inside)
    d = d.withColumn("fixed", F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside")))
    turned = (F.col("from_outside") == 1) & (F.col("from_inside") == 0)
    return d.withColumn("turned", turned.cast("int")).drop("from_outside", "from_inside")


def running(df: DataFrame, order: WindowSpec) -> DataFrame:
    """Replace ``fixed`` and ``turned`` by their effect put together from the window's start to the row."""
    sofar = order.rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("turns", F.sum("turned").over(sofar))
    d = d.withColumn("known", F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turns")), ignorenulls=True).over(sofar))
    odd = F.pmod(F.col("turns") - F.coalesce("known.turns", F.lit(0)), F.lit(2)).cast("int")
    # What is fixed and then turned is fixed to the other state.
    return d.withColumn("fixed", F.pmod(F.col("known.fixed") + odd, F.lit(2))).withColumn(
        "turned", F.when(F.col("fixed").isNull(), odd).otherwise(0)).drop("turns", "known")


def applied(fixed: Column, turned: Column, state: Column) -> Column:
    return F.pmod(F.coalesce(fixed, state) + F.coalesce(turned, F.lit(0)), F.lit(2))


def record_lines(lines: DataFrame) -> DataFrame:
    """path, block, at, piece, text, end, row_no, opens, closes: each line with the record it belongs to."""
    in_block = Window.partitionBy("path", "block").orderBy("at", "piece")
    d = running(with_effect(lines), in_block)
    before = [F.lag(c).over(in_block) for c in ("fixed", "turned")]
    d = d.withColumn("fixed_before", before[0]).withColumn("turned_before", before[1])
    opens = lambda state: (applied(F.col("fixed_before"), F.col("turned_before"), state) == 0).cast("long")

    # One row per block: its effect as a whole, and how many records it opens from either state.
    last = F.max_by(F.struct("fixed", "turned"), F.struct("at", "piece"))
    blocks = d.groupBy("path", "block").agg(last.alias("last"), F.sum(opens(F.lit(0))).alias("opens0"), F.sum(opens(F.lit(1))).alias("opens1"),
                                            F.bool_and("valid").alias("valid"))
    in_file = Window.partitionBy("path").orderBy("block")
    blocks = running(blocks.select("path", "block", "valid", "opens0", "opens1", "last.fixed", "last.turned"), in_file)
    blocks = blocks.select("*", F.lag("fixed").over(in_file).alias("f"), F.lag("turned").over(in_file).alias("t"))
    blocks = blocks.withColumn("state", applied(F.col("f"), F.col("t"), F.lit(0)))
    opened = F.when(F.col("state") == 0, F.col("opens0")).otherwise(F.col("opens1"))
    earlier = F.sum(opened).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("path", "block", "state", F.coalesce(earlier, F.lit(0)).alias("earlier"),
                           F.bool_and("valid").over(Window.partitionBy("path")).alias("utf8"))

    d = d.join(blocks, ["path", "block"]).withColumn("opens", opens(F.col("state")))
    d = d.withColumn("closes", applied(F.col("fixed"), F.col("turned"), F.col("state")) == 0)
    number = F.sum("opens").over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    as_utf8 = F.encode("line", "ISO-8859-1").cast("string")
    return d.select("path", "block", "at", "piece", F.when(F.col("utf8"), as_utf8).otherwise(F.col("line")).alias("text"), "end",
                    (F.col("earlier") + number - 1).alias("row_no"), (F.col("opens") == 1).alias("opens"), "closes")


def csv_file_records(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, row_no (0-based), cells of every record of the files under ``path``."""
    lines = record_lines(physical_lines(spark, path, glob))
    single = F.col("opens") & F.col("closes")
    whole = lines.filter(single).select("path", "row_no", F.col("text").alias("record"))
    parts = lines.filter(~single).groupBy("path", "row_no").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "piece", "text", "end"))).alias("parts"))
    n = F.size("parts")
    joined = F.array_join(F.transform("parts", lambda p, i: F.when(i < n - 1, F.concat(p["text"], p["end"])).otherwise(p["text"])), "")
    records = whole.union(parts.select("path", "row_no", joined))
    return records.select("path", "row_no", csv_cells(F.regexp_replace("record", r"\r\z", "")).alias("cells"))
