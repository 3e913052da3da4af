"""Line deduplication by content-defined line chunks (DataFrame functions only).

Every line is hashed, and a hash that rolls over two adjacent line hashes is counted over the whole table.
A border between two lines stands wherever their rolling hash occurs once: it depends on the two lines alone,
so an insertion shifts the borders near it and no others. What lies between two borders is a chunk; a line of
``LONG_LINE`` words or more that occurs more than once is a chunk even by itself. Chunks are compared by their
bytes (they are the key that is grouped), and all but the first occurrence (smallest id, then position) are
removed whole. The one occurrence that is left of each chunk may still hold runs that stand in another chunk too:
its pairs of lines and its long lines are compared by their bytes in the same way. So exactly the lines
go that lie in a pair of lines, or are a long line, that stands earlier in the table; the earliest stays.

Without ``passages``, borders are cut at fixed hash values instead (one line in ``LINES_PER_CHUNK``), and only
whole chunks of two lines or more are compared.

Places are narrow (id, 16 bytes of the text's SHA-256, line), and the plan is the same at every size. A text moves
once to its chunks, and a second time only if it has any.

Defined results: a null text stays null and has no lines; an empty text is one empty line; a null id
comes after all ids when the first occurrence is chosen; rows that repeat both id and text are one
document and lose the same lines; empty lines are lines like others; very long texts are read whole; extra
columns of the input are ignored; an empty table is fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

#: Without passages, one line in so many ends a chunk.
LINES_PER_CHUNK = 3

#: Words of a line that is a passage by itself.
LONG_LINE = 50


def text_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, sha (16 bytes; empty for null), lines."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sha = F.substring(F.unhex(F.sha2("text", 256)), 1, 16)
    return d.select("id", F.coalesce(sha, F.lit(b"")).alias("sha"), F.split("text", "\n", -1).alias("lines"))


def line_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, sha, n_lines, chunks (array of chunk, start, lines): the chunks joined by line ends are the text."""
    d = text_lines(docs, id_col, text_col)
    d = d.withColumn("marks", F.transform("lines", lambda x: F.xxhash64(x)))
    n = F.size("lines")
    rolled = lambda i: F.xxhash64(F.get("marks", i - 1), F.get("marks", i - 2))
    d = d.withColumn("ends", F.when(F.col("lines").isNotNull(), F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i == n) | (F.pmod(rolled(i), F.lit(LINES_PER_CHUNK)) == 0))))
    start = lambda k: F.coalesce(F.get("ends", k - 1), F.lit(0))
    return d.select("id", "sha", F.greatest(n, F.lit(0)).alias("n_lines"), F.transform("ends", lambda e, k: F.struct(
        F.array_join(F.slice("lines", start(k) + 1, e - start(k)), "\n").alias("chunk"), start(k).alias("start"), (e - start(k)).alias("lines"))).alias("chunks"))


def _hash(h: Column, bits: int) -> Column:
    return h if bits >= 64 else F.shiftrightunsigned(h, 64 - bits)


def _long(line: Column) -> Column:
    return (F.length(line) >= 2 * LONG_LINE - 1) & (F.regexp_count(line, F.lit(WORD)) >= LONG_LINE)


def fixed_spans(docs: DataFrame, id_col: str, text_col: str, hash_bits: int) -> DataFrame:
    """id, sha, start, lines, h: the chunks of two lines or more between fixed cuts."""
    # explode_outer: explode would push the whole expression into an inferred filter.
    d = line_chunks(docs, id_col, text_col).select("id", "sha", F.explode_outer("chunks").alias("c")).filter("c.lines > 1")
    return d.select("id", "sha", "c.start", "c.lines", _hash(F.xxhash64("c.chunk"), hash_bits).alias("h"))


def rolling_spans(docs: DataFrame, id_col: str, text_col: str, hash_bits: int) -> DataFrame:
    """id, sha, start, lines, h: the rolling hash of every two adjacent lines, the hash of every long line."""
    d = text_lines(docs, id_col, text_col)
    d = d.withColumn("marks", F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("h"), _long(x).alias("long"))))
    mark = lambda i: F.get("marks", i)
    spans = F.flatten(F.transform("marks", lambda m, i: F.array(
        F.struct(i.alias("start"), F.lit(1).alias("lines"), F.when(m["long"], m["h"]).alias("h")),
        F.struct(i.alias("start"), F.lit(2).alias("lines"), F.when(mark(i + 1).isNotNull(), F.xxhash64(m["h"], mark(i + 1)["h"])).alias("h")))))
    d = d.select("id", "sha", F.explode_outer(spans).alias("s")).filter("s.h IS NOT NULL")
    return d.select("id", "sha", "s.start", "s.lines", _hash(F.col("s.h"), hash_bits).alias("h"))


def repeated_chunks(spans: DataFrame) -> DataFrame:
    """id, sha, chunks (array of start, lines): runs of lines that no border divides."""
    seen = spans.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    places = spans.join(seen.hint("merge"), "h").select("id", "sha", "start", (F.col("start") + F.col("lines")).alias("stop"))
    # Rows that repeat id and text give the same places; they are reduced before one task orders them.
    places = places.distinct()
    # Spans that share a line are one run: a new one starts where nothing before reaches.
    doc = Window.partitionBy("id", "sha").orderBy("start", "stop")
    reach = F.max("stop").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    places = places.withColumn("first", (reach.isNull() | (F.col("start") >= reach)).cast("int"))
    places = places.withColumn("run", F.sum("first").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    runs = places.groupBy("id", "sha", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.groupBy("id", "sha").agg(F.collect_list(F.struct("start", (F.col("stop") - F.col("start")).alias("lines"))).alias("chunks"))


def same_document(a: str, b: str) -> Column:
    return (F.col(f"{a}.sha") == F.col(f"{b}.sha")) & F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id"))


def first_places(units: DataFrame) -> DataFrame:
    """units: id, sha, start, lines, unit. Returns unit, lines and the place (id, sha, start) of the first of its bytes."""
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "sha", "start")
    first = units.groupBy("unit", "lines").agg(F.min(order).alias("first"))
    return first.select("unit", "lines", "first.id", "first.sha", "first.start")


def later_places(units: DataFrame, first: DataFrame) -> DataFrame:
    """id, sha, start, lines of the units that are not the first of their bytes."""
    u, f = units.select("id", "sha", "start", "lines").alias("u"), first.select("id", "sha", "start", "lines").hint("merge").alias("f")
    at = same_document("u", "f") & (F.col("u.start") == F.col("f.start")) & (F.col("u.lines") == F.col("f.lines"))
    return u.join(f, at, "left_anti")


def small_units(chunks: DataFrame) -> DataFrame:
    """id, sha, start, lines, unit: the pairs of lines and the long lines of chunks."""
    unit = lambda i, lines, text: F.struct((F.col("start") + i).alias("start"), F.lit(lines).alias("lines"), text.alias("unit"))
    d = chunks.select("id", "sha", "start", F.split("unit", "\n", -1).alias("held"))
    units = F.flatten(F.transform("held", lambda x, i: F.array(
        unit(i, 1, F.when(_long(x), x)), unit(i, 2, F.concat(x, F.lit("\n"), F.get("held", i + 1))))))
    d = d.select("id", "sha", F.explode_outer(units).alias("u"))  # the last line's pair is null
    return d.filter("u.unit IS NOT NULL").select("id", "sha", "u.*")


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64,
                      passages: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_lines, removed_lines, clean_text."""
    spans = (rolling_spans if passages else fixed_spans)(docs, id_col, text_col, hash_bits)
    runs = stored(repeated_chunks(spans), "runs").hint("merge").alias("r")
    texts = text_lines(docs, id_col, text_col).alias("t").join(runs, same_document("t", "r"), "left")
    texts = stored(texts.select("t.id", "t.sha", F.array_join("t.lines", "\n").alias("text"), "r.chunks"), "texts")

    held = texts.filter("chunks IS NOT NULL").select("id", "sha", F.split("text", "\n", -1).alias("lines"), F.explode("chunks").alias("c"))
    chunks = held.select("id", "sha", "c.start", "c.lines", F.array_join(F.slice("lines", F.col("c.start") + 1, F.col("c.lines")), "\n").alias("unit"))
    first = stored(first_places(chunks), "chunks")
    gone = later_places(chunks, first)
    if passages:
        units = small_units(first)
        gone = gone.union(later_places(units, first_places(units)))
    gone = gone.select("id", "sha", F.explode(F.sequence("start", F.col("start") + F.col("lines") - 1)).alias("line"))
    gone = stored(gone.groupBy("id", "sha").agg(F.collect_set("line").alias("gone")), "gone").hint("merge").alias("g")

    hit = texts.filter("chunks IS NOT NULL").alias("t").join(gone, same_document("t", "g"), "left").select("t.id", "t.text", "g.gone")
    every = hit.union(texts.filter("chunks IS NULL").select("id", "text", F.lit(None).cast("array<int>")))
    every = every.withColumn("lines", F.split("text", "\n", -1)).withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    n = F.greatest(F.size("lines"), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    clean = F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return every.select("id", n.alias("n_lines"), F.size("gone").alias("removed_lines"), clean.alias("clean_text"))
