"""Ranked lexical search by pipelined term partitioning.

Every document is scored for every item by an integer sum over the item's terms; the k best are listed.

1. Postings. A term's occurrences in a whole text, and the number of the text's terms, are counted where the
   row lies. Statistics (documents, terms, document frequencies) cover all documents. A posting holds the
   finished integer contribution of a term to a document.
2. Term owners. Terms are dealt to ``OWNERS`` owners by rising document frequency, so that each owns about
   as many postings; the rarest and weightiest terms come first.
3. Pipeline. A bundle is an item with the accumulators of one block of documents. Bundles visit the owners
   in turn: at each owner they are cogrouped with its postings of the block and add the contributions of
   their terms. Accumulators stay sparse: a document goes when its sum and the most that the item's
   remaining terms can add (the largest contribution of each, over all documents) stay below the k-th best
   sum so far, of the block or of all blocks. Nothing that could be listed is dropped, ties included.
4. Selection. The k best of each block are ranked together.

A block holds about ``BLOCK`` documents and a chunk ``ITEMS`` items, so that no group grows with the tables.

Defined results: terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased;
null and termless texts have none and do not count as documents; very long texts are read whole; equal
scores rank by ascending id; rows that share a document id are documents of their own; rows with a null id
count in the statistics but cannot be listed; item rows that share an id are one item with the terms of all,
and a null item id takes no part; an item without matches has no row; extra columns are ignored; empty
tables give empty results.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_KEYS, shared_dir, small, stored

#: Stages of the pipeline, documents of a block, items of a chunk.
OWNERS = 4
BLOCK = 4096
ITEMS = 256

_SEPARATES = [b for b in range(128) if not chr(b).isalnum()]
_TABLE = bytes(32 if b in _SEPARATES else b + 32 if 65 <= b <= 90 else b for b in range(256))

BUNDLE = "block long, chunk long, item_id long, best long, rows array<long>, ids array<long>, sums array<long>"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return (text or b"").translate(_TABLE).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, term: each pair once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_py()))) for t in batch.column(1)]
            at = np.repeat(np.arange(len(found)), list(map(len, found)))
            flat = pa.array([t for f in found for t in f], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), flat], names=["item_id", "term"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("t"))
    return rows.filter("item_id IS NOT NULL").mapInArrow(run, "item_id long, term binary").distinct()


def counted_documents(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[bytes] | None) -> DataFrame:
    """id, n (terms with repeats), terms and tfs (those of the vocabulary, or all), for texts with terms."""
    wanted = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n, ends, names, tfs = [], [0], [], []
                for t in part.column(1):
                    found = terms(t.as_py())
                    count = Counter(found if wanted is None else filter(wanted.value.__contains__, found))
                    n.append(len(found))
                    names += count.keys()
                    tfs += count.values()
                    ends.append(len(names))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(names, pa.binary())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], names=["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(run, "id long, n long, terms array<binary>, tfs array<long>").filter("n > 0")


def owners_of(frequencies: DataFrame, owners: int) -> list[int]:
    """First binary order of magnitude of the document frequency that each owner takes, in rising order."""
    size = F.floor(F.log2("df")).cast("int").alias("size")
    held = sorted(tuple(r) for r in frequencies.groupBy(size).agg(F.sum("df")).collect())  # 63 rows at most
    total, before, firsts, last = sum(n for _, n in held), 0, [], -1
    for size, n in held:
        owner = min(owners - 1, owners * before // max(total, 1))
        if owner != last:
            firsts.append(size)
            last = owner
        before += n
    return firsts


def visit(k: int):
    """Adds the contributions of an owner's postings of one block to the bundles of one chunk there."""
    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        term, row, doc, c = (postings.column(x).to_numpy() for x in ("term_id", "row", "id", "c"))
        order = np.argsort(term, kind="stable")
        term, row, doc, c = term[order], row[order], doc[order], c[order]
        lists = {x: bundles.column(x).combine_chunks() for x in ("rows", "ids", "sums", "term_ids")}
        flat = {x: a.flatten().to_numpy(zero_copy_only=False) for x, a in lists.items()}
        ends = {x: np.concatenate([[0], np.cumsum(np.array([len(v) for v in a], np.int64))]) for x, a in lists.items()}
        known, first = np.unique(np.concatenate([row, flat["rows"].astype(np.int64)]), return_index=True)
        ids = np.concatenate([doc, flat["ids"].astype(np.int64)])[first]
        at, held_at = np.searchsorted(known, row), np.searchsorted(known, flat["rows"])
        best, rest = bundles.column("best").to_numpy(), bundles.column("rest").to_numpy()
        out_best, kept, sums = [], [], []
        for i in range(bundles.num_rows):
            total = np.zeros(len(known), np.int64)
            lo, hi = ends["rows"][i:i + 2]
            total[held_at[lo:hi]] = flat["sums"][lo:hi]
            for t in flat["term_ids"][slice(*ends["term_ids"][i:i + 2])]:
                own = slice(np.searchsorted(term, t, "left"), np.searchsorted(term, t, "right"))
                total[at[own]] += c[own]
            bound = int(best[i])
            if len(total) >= k:
                bound = max(bound, int(np.partition(total, len(total) - k)[len(total) - k]))
            stay = np.flatnonzero((total > 0) & (total + rest[i] >= bound))
            if rest[i] == 0 and len(stay) > k:  # the last terms: only the k best of the block go on
                stay = stay[np.lexsort((ids[stay], -total[stay]))[:k]]
            out_best.append(bound)
            kept.append(stay)
            sums.append(total[stay])
        offsets = pa.array(np.concatenate([[0], np.cumsum(list(map(len, kept)))]).astype(np.int32))
        all_kept = np.concatenate([*kept, np.empty(0, np.int64)]).astype(np.int64)
        columns = [known[all_kept], ids[all_kept], np.concatenate([*sums, np.empty(0, np.int64)]).astype(np.int64)]
        return pa.table([bundles.column("block"), bundles.column("chunk"), bundles.column("item_id"), pa.array(out_best, pa.int64()),
                         *[pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in columns]],
                        names=["block", "chunk", "item_id", "best", "rows", "ids", "sums"])

    return run


def kth_best(bundles: DataFrame, k: int) -> DataFrame:
    """item_id, floor: the k-th largest sum over all blocks, for items that have as many."""
    top = bundles.select("item_id", F.explode(F.slice(F.sort_array("sums", False), 1, k)).alias("s"))
    ranked = top.withColumn("r", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("s")))).filter(F.col("r") <= k)
    return ranked.filter(F.col("r") == k).select("item_id", F.col("s").alias("floor"))


def top_documents(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k best documents with a score above 0 of every item."""
    spark = docs.sparkSession
    wanted = stored(item_terms(items, item_col, item_text_col), "item_terms")
    vocabulary = stored(wanted.select("term").distinct().select("term", F.monotonically_increasing_id().alias("term_id")), "vocabulary")
    few = vocabulary.count() <= BROADCAST_KEYS
    names = [bytes(r.term) for r in vocabulary.select("term").toLocalIterator()] if few else None
    counted = stored(counted_documents(docs, id_col, text_col, names).withColumn("row", F.monotonically_increasing_id()), "counted")
    documents, all_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    occurrences = counted.select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    occurrences = occurrences.select("row", "id", "n", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    occurrences = occurrences.join(small(vocabulary), "term").drop("term")
    frequencies = stored(occurrences.groupBy("term_id").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    firsts = owners_of(frequencies, OWNERS)
    owner = sum((F.when(F.floor(F.log2("df")) >= f, 1).otherwise(0) for f in firsts[1:]), F.lit(0))
    weights = small(stored(frequencies.select("term_id", weight.alias("w"), owner.cast("int").alias("owner")).filter("w > 0"), "weights"))

    blocks, chunks = -(-documents // BLOCK), max(1, -(-wanted.select("item_id").distinct().count() // ITEMS))
    m = f"(100 - 50 + ((50 * n * {documents}) div {max(all_terms, 1)}))"
    chunk = F.pmod(F.xxhash64("item_id"), F.lit(chunks)).alias("chunk")
    postings = occurrences.filter("id IS NOT NULL").join(weights, "term_id").select(
        F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1))).alias("block"), "owner", "term_id", "row", "id",
        F.expr(f"w * ((1000000000 * tf) div (1000 * tf + 20 * {m}))").alias("c"))
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/postings.parquet"
    postings.filter("c > 0").write.partitionBy("owner").parquet(path)
    postings = spark.read.schema("block long, term_id long, row long, id long, c long, owner int").parquet(path)

    # What the terms of an item can still add after each owner.
    most = postings.groupBy("term_id", "owner").agg(F.max("c").alias("most"))
    plan = wanted.join(small(vocabulary), "term").join(small(stored(most, "most")), "term_id").select("item_id", chunk, "term_id", "owner", "most")
    plan = stored(plan, "item_plan")
    routes = small(stored(plan.select("term_id", "chunk").distinct(), "routes"))

    start = plan.select("item_id", "chunk").distinct().withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))) if blocks else plan.select("item_id", "chunk", F.lit(0).cast("long").alias("block")).limit(0)
    none = F.array().cast("array<long>")
    bundles = start.select("block", "chunk", "item_id", F.lit(0).cast("long").alias("best"), none.alias("rows"), none.alias("ids"), none.alias("sums"))
    for s in range(len(firsts)):
        here = plan.groupBy("item_id").agg(F.collect_list(F.when(F.col("owner") == s, F.col("term_id"))).alias("term_ids"),
                                           F.coalesce(F.sum(F.when(F.col("owner") > s, F.col("most"))), F.lit(0)).alias("rest"))
        bundles = bundles.join(small(stored(here, f"terms_{s}")), "item_id")
        if s:
            floors = small(stored(kth_best(bundles, k), f"floors_{s}"))
            bundles = bundles.join(floors, "item_id", "left").withColumn("best", F.greatest("best", F.coalesce("floor", F.lit(0)))).drop("floor")
        stays = bundles.filter(F.size("term_ids") == 0).select("block", "chunk", "item_id", "best", "rows", "ids", "sums")
        left = bundles.filter(F.size("term_ids") > 0).select("block", "chunk", "item_id", "best", "rows", "ids", "sums", "term_ids", "rest")
        right = postings.filter(F.col("owner") == s).join(routes, "term_id").select("block", "chunk", "term_id", "row", "id", "c")
        visited = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(visit(k), BUNDLE)
        bundles = stored(visited.union(stays), f"bundles_{s}")

    found = bundles.select("item_id", F.explode(F.arrays_zip("ids", "sums")).alias("e"))
    found = found.select("item_id", F.col("e.ids").alias("doc_id"), F.col("e.sums").alias("score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
