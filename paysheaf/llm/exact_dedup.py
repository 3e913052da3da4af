"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A normalised text (A-Z lower-cased) is cut into pieces at sentence marks and line ends, and pieces are
joined into chunks whose ends are chosen by a hash that rolls over the last two pieces. Every distinct
chunk is moved once: it is grouped by its bytes, which verifies that a chunk hash stands for one text
only. A text is then the ordered list of its chunk identifiers, and texts are equal when these short
lists are equal; long documents are not moved again.

Defined results: a null text counts as empty, and all empty texts are equal (an empty list); a null id
counts as smaller than any id; rows that repeat both id and text are one document and come back once,
with ``group_size`` counting every row; an empty table gives an empty result; other columns of the
input, whatever their names, take no part in the decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, small, stored

#: A piece ends at a sentence mark or line end, or after 256 characters without one.
PIECE = r"[^.!?\n]{0,255}[.!?\n]|[^.!?\n]{1,256}"

#: One piece end in so many ends a chunk.
PIECES_PER_CHUNK = 12


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def with_chunks(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the ordered chunks of the string column ``text``; their concatenation is the text."""
    pieces, marks, ends = (fresh(df, f"{out}_{x}") for x in ("pieces", "marks", "ends"))
    df = df.withColumn(pieces, F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0)))
    df = df.withColumn(marks, F.transform(pieces, lambda p: F.xxhash64(p)))
    n = F.size(pieces)
    rolled = lambda i: F.xxhash64(F.get(marks, i - 1), F.get(marks, i - 2))
    df = df.withColumn(ends, F.when(n == 0, F.array().cast("array<int>")).otherwise(F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i == n) | (F.pmod(rolled(i), F.lit(PIECES_PER_CHUNK)) == 0))))
    start = lambda k: F.coalesce(F.get(ends, k - 1), F.lit(0))
    df = df.withColumn(out, F.transform(
        ends, lambda e, k: F.array_join(F.slice(pieces, start(k) + 1, e - start(k)), "")))
    return df.drop(pieces, marks, ends)


def chunk_hash(chunk: Column, bits: int) -> Column:
    return F.xxhash64(chunk) if bits >= 64 else F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits)


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """One row per document: id, text_sha256, fp, recipe (ordered verified chunk identifiers), copies (its rows).

    ``hash_bits`` shortens the chunk hash (tests use it to force hashes that stand for several chunks).
    """
    base = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    cut = with_chunks(base, "norm", "chunks")
    rows = cut.select(
        "id", F.sha2("norm", 256).alias("text_sha256"),
        F.transform("chunks", lambda c: chunk_hash(c, hash_bits)).alias("hashes"))
    rows = stored(rows, "recipes")

    # Chunks are grouped by their bytes; a hash with two different chunks identifies neither.
    # explode_outer: explode would infer a filter on the list and push all of its work into that filter.
    chunks = cut.select(F.explode_outer("chunks").alias("chunk")).filter("chunk IS NOT NULL").select(chunk_hash(F.col("chunk"), hash_bits).alias("h"), "chunk")
    distinct = chunks.groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("n"))
    clashing = stored(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h"), "clashing")

    plain = lambda h: F.struct(h.alias("h"), F.lit(0).alias("k"))
    if clashing.isEmpty():
        known = rows.withColumn("recipe", F.transform("hashes", plain)).drop("hashes")
    else:
        numbered = (distinct.join(clashing, "h", "left_semi").select(
            "h", "chunk", F.row_number().over(Window.partitionBy("h").orderBy("chunk")).alias("k")))
        # Documents with a clashing hash get their list from the chunk bytes, position by position.
        spread = cut.select("id", F.sha2("norm", 256).alias("text_sha256"), F.posexplode_outer("chunks").alias("pos", "chunk"))
        spread = spread.withColumn("h", chunk_hash(F.col("chunk"), hash_bits))
        exact = (spread.join(numbered, ["h", "chunk"], "left")
                 .groupBy("id", "text_sha256")
                 .agg(F.array_sort(F.collect_set(F.struct("pos", "h", F.coalesce("k", F.lit(0)).alias("k")))).alias("r"))
                 .select("id", "text_sha256", F.transform("r", lambda x: F.struct(x["h"].alias("h"), x["k"].alias("k"))).alias("recipe")))
        same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.text_sha256") == F.col("b.text_sha256"))
        known = (rows.alias("a").join(exact.alias("b"), same, "left").select(
            "a.id", "a.text_sha256", F.coalesce("b.recipe", F.transform("a.hashes", plain)).alias("recipe")))
    known = known.withColumn("fp", F.xxhash64("recipe"))
    return known.groupBy("id", "text_sha256", "fp", "recipe").agg(F.count(F.lit(1)).alias("copies"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, copies."""
    rows = stored(recipes(docs, id_col, text_col, hash_bits), "documents")
    groups = (rows.groupBy("fp", "recipe")
              .agg(F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("members"), F.max("id").alias("keep_id"))
              .filter("members > 1").drop("members"))
    # Stored, so that both sides of the join come straight from a shuffle and a group of many copies can be split.
    out = rows.join(stored(groups, "shared"), ["fp", "recipe"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return out.select("id", keep.alias("keep_id"), F.coalesce("group_size", "copies").alias("group_size"),
                      F.col("id").eqNullSafe(keep).alias("kept"), "text_sha256", "copies")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = stored(exact_groups(docs, id_col, text_col), "groups")
    sha = fresh(docs, "text_sha256")
    keyed = docs.withColumn(sha, F.sha2(normalised(F.col(text_col)), 256))

    def match(other: DataFrame) -> Column:
        return (F.col(f"d.{sha}") == other["text_sha256"]) & F.col(f"d.`{id_col}`").eqNullSafe(other["id"])

    dropped = small(groups.filter("not kept").select("id", "text_sha256"), 250_000).alias("g")
    left = keyed.alias("d").join(dropped, match(dropped), "left_anti")
    twice = stored(groups.filter("kept and copies > 1").select("id", "text_sha256"), "repeated")
    if not twice.isEmpty():
        twice = small(twice, 250_000).alias("t")
        single = left.alias("d").join(twice, match(twice), "left_anti")
        once = left.alias("d").join(twice, match(twice), "left_semi").dropDuplicates([id_col, sha])
        left = single.unionByName(once)
    return left.drop(sha)
