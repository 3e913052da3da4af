"""Mixing sources to target weights by weighted fair queueing.

Every source is shuffled by a hash of the document id and served from its start, again from its start
when its target exceeds its size (at most ``max_repeats`` passes). A served document gets a virtual
finish time: the words its source has delivered up to its end, divided by the source's target. All
served documents are ordered by that time, and the order is cut where the total budget is used up.
Targets add up to the budget, so in virtual time every source reaches its target at 1, where the cut
falls; a document that is being served at the cut contributes the words before it.

Running totals come from bins: bin sums are added up first, rows are ordered only inside a bin. A
source with a third of all rows is thus dealt over as many tasks as it has bins.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its
own and comes last; rows that repeat an id are documents of their own (their order among themselves
does not change what the source takes); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, bin_bits, fresh, hash_bin, order_hash, running_before, small, stored

#: Bins of virtual time in which the served documents are ordered.
TIME_BITS_ROWS = 500


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], max_repeats: int) -> DataFrame:
    """sizes: source, source_size. Adds s (number of the source by code point, null last) and target.

    Water-filling: sources whose limit is low for their weight are filled first; the rest share what is
    left by weight. The table has one row per source.
    """
    one = Window.partitionBy(F.lit(0))
    s = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (s % len(weights) + 1).cast("int")).cast("long")
    t = sizes.select("source", "source_size", s.alias("s"), w.alias("w"))
    t = t.withColumn("most", F.col("source_size") * max_repeats)
    filled = one.orderBy(F.col("most") / F.col("w"), "s").rowsBetween(Window.unboundedPreceding, -1)
    everyone = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumns({
        "budget": F.sum("source_size").over(everyone),
        "used": F.coalesce(F.sum("most").over(filled), F.lit(0)),
        "w_left": F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(filled), F.lit(0)),
    })
    # Levels rise up to the first source that its share does not fill, and fall after it: that one holds.
    t = t.withColumn("level", (F.col("budget") - F.col("used")) / F.col("w_left"))
    t = t.withColumn("open", F.col("level") * F.col("w") <= F.col("most"))
    t = t.withColumn("level", F.max(F.when(F.col("open"), F.col("level"))).over(everyone))
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("w"))
    return t.select("source", "s", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, seed: int = 7,
        row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, served).

    documents: row, doc_id, source, size, source_size, target, start (words of its source before it).
    served: row, copy (pass over the source), words (taken of this copy), finish (virtual time) and
    position (words of the mix before it); the mix is ``served`` in the order of position. ``row_col``
    names a column that numbers the rows, if there is one.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = stored(docs.select(
        row.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), order_hash(F.lit(seed), F.col(id_col).cast("string")).alias("h")), "sizes")
    n = rows.count()
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, list(weights), max_repeats), "targets")
    rows = rows.join(small(targets, 100_000), rows.source.eqNullSafe(targets.source)).drop(targets.source)
    rows = rows.withColumn("bin", hash_bin(F.col("h"), bin_bits(n)))
    # hash_bin reads the hash as unsigned, so ties inside a bin are ordered by the signed hash, then the id.
    docs_out = running_before(rows, ["s"], "bin", [F.col("h"), F.col("doc_id").asc_nulls_first(), F.col("row")], "size", "start")
    docs_out = stored(docs_out.select("row", "doc_id", "source", "s", "size", "source_size", "target", "start"), "queue")

    passes = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("copy")
    items = docs_out.filter("size > 0 and target > 0").select("row", "s", "size", "source_size", "target", "start", passes)
    items = items.withColumn("begin", F.col("copy") * F.col("source_size") + F.col("start")).filter("begin < target")
    end = F.least((F.col("begin") + F.col("size")).cast("double"), F.col("target"))
    items = items.withColumn("finish", end / F.col("target"))
    # Whole words: a source delivers floor(target) words by virtual time 1.
    items = items.withColumn("words", (F.floor(end) - F.col("begin")).cast("long"))
    bits = bin_bits(n, TIME_BITS_ROWS)
    items = items.withColumn("bin", F.floor(F.col("finish") * (1 << bits)).cast("long"))
    served = running_before(items, [], "bin", [F.col("finish"), F.col("s"), F.col("copy"), F.col("row")], "words", "position")
    budget = F.lit(targets.agg(F.sum("source_size")).first()[0] or 0)
    words = F.least(F.col("words"), budget - F.col("position"))
    return docs_out, served.select("row", "copy", words.alias("words"), "finish", "position").filter("words > 0")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, copies."""
    queue, served = mix(docs, **options)
    taken = served.groupBy("row").agg(F.sum("words").alias("taken"), F.count(F.lit(1)).alias("copies"))
    out = queue.join(taken, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                      "source", F.coalesce("copies", F.lit(0)).cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, with all columns of ``docs``: a document is there once for each pass that takes
    it; one that the cut divides is there if at least half of its words are before the cut."""
    row = fresh(docs, "mix_row")
    docs = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    queue, served = mix(docs, row_col=row, **options)
    whole = served.join(queue.select("row", "size"), "row").filter(F.col("words") * 2 >= F.col("size"))
    passes = stored(whole.groupBy("row").agg(F.count(F.lit(1)).cast("int").alias("passes")), "passes")
    name = fresh(docs, "mix_passes")
    passes = passes.select(F.col("row").alias(row), F.col("passes").alias(name))
    times = fresh(docs, "mix_time")
    out = docs.join(small(passes), row)
    return out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(name)))).drop(row, name, times)
