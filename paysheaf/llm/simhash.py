"""SimHash near duplicates by segment popcounts.

Documents link when their 64-bit fingerprints differ in few bits (three at most).

1. Fingerprints. Every whole text becomes its majority fingerprint over the XXH64 of its word shingles,
   repeats included. Equal fingerprints form one class, known by its smallest id; only classes go on.
2. Embedding. A fingerprint is cut into segments of two bits, and each segment gives its bit count. The
   Manhattan distance of two such points is never above the Hamming distance of the fingerprints.
3. Grid range-join. Two fingerprints within ``bits`` of each other are within ``bits // 2`` in one half of
   their segments, so their points there are in the same unit cell of the grid or, for up to three bits,
   in one that a single step reaches. Every fingerprint is stored in its own cell and looks into the
   cells one step up; the step down is the other's step up.
4. Stars. Each cell compares all its members with one of them. Cells whose members are then one component
   are done, which ends most dense cells at a cost linear in their rows.
5. The rest. In the cells left open, members outside the component of the cell's star meet all members:
   small cells in a plain join, large ones in blocks of ``NODE`` members against a stream of visitors,
   which keeps only a forest of the links it finds. Every link is decided on the fingerprints themselves.

Defined results: words are split at ASCII blanks, A-Z is lower-cased; fewer words than a shingle are one
shingle; a text without words (null, empty, blank) has fingerprint zero and links like any other; very long
texts are read whole, in blocks of shingles; a bit set in exactly half the shingles is 0; a null id cannot
be named by a component, so such a row links with nothing and its component is null; rows that share an id
are one document for components; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stored
from .components import components, contract

SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 4096
#: Members of an open cell that meet in a plain join; members of a block beyond that.
NODE = 256
#: Two bits in a segment, 16 segments in each half.
SEGMENTS = 16


def fingerprint(text: bytes | None, size: int) -> int:
    """Bit k is 1 if it is set in more than half of the shingles' hashes."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    k = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - k + 1].tolist()
    stops = ends[k - 1:].tolist()
    count = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for lo in range(0, len(starts), BLOCK):
        h = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts[lo:lo + BLOCK], stops[lo:lo + BLOCK])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    on = (2 * count > len(starts)).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, fp (the fingerprint's bits as a long) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), size) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(run, "id long, fp long")


def grid_cells(fp: Column) -> Column:
    """The cells of a fingerprint, as structs (cell, own): for each half its own cell (two bits for each
    segment's count) and the cells one step up.

    The counts of all 16 segments of a half are the sum of its even and its odd bits, under a mask.
    """
    mask, cells = F.lit(0x55555555), []
    for half in (0, 1):
        bits = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        point = bits.bitwiseAND(mask) + F.shiftrightunsigned(bits, 1).bitwiseAND(mask)
        marked = point + F.lit(half << 32)
        cells.append(F.struct(marked.alias("cell"), F.lit(True).alias("own")))
        for s in range(SEGMENTS):
            full = F.shiftrightunsigned(point, 2 * s + 1).bitwiseAND(F.lit(1)) == 1
            cells.append(F.when(~full, F.struct((marked + F.lit(1 << (2 * s))).alias("cell"), F.lit(False).alias("own"))))
    return F.filter(F.array(*cells), lambda c: c.isNotNull())


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def close_in_blocks(blocks: DataFrame, bits: int) -> DataFrame:
    """blocks: cell, salt, block (whether the row is of the block or visits it), fp, component. Returns a
    forest (a, b) of the close pairs of different components; memory holds one block and one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, held_component = None, np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            cell, salt, own, fp, component = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            new = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1])]))
            for lo, hi in zip(new, [*new[1:], len(fp)]):
                if key != (cell[lo], salt[lo]):
                    key, held, held_component = (cell[lo], salt[lo]), np.empty(0, np.int64), np.empty(0, np.int64)
                mine = own[lo:hi].astype(bool)
                held = np.concatenate([held, fp[lo:hi][mine]])
                held_component = np.concatenate([held_component, component[lo:hi][mine]])
                found = []
                others = np.flatnonzero(~mine) + lo
                for start in range(0, len(others), 1024):
                    k = others[start:start + 1024]
                    near = np.bitwise_count((held[:, None] ^ fp[k][None, :]).view(np.uint64)) <= bits
                    x, y = np.nonzero(near & (held_component[:, None] != component[k][None, :]))
                    if len(x):
                        found.append(contract(np.stack([held[x], fp[k][y]], axis=1)))
                if found:
                    f = contract(np.concatenate(found))
                    yield pa.RecordBatch.from_arrays([pa.array(f[:, 0]), pa.array(f[:, 1])], names=["a", "b"])

    order = blocks.repartition("cell", "salt").sortWithinPartitions("cell", "salt", F.desc("block"))
    return order.select("cell", "salt", "block", "fp", "component").mapInArrow(run, "a long, b long")


def close_fingerprints(distinct: DataFrame, bits: int) -> DataFrame:
    """distinct: fp, each once. Returns fp, component: fingerprints that reach a smaller one, and that one."""
    if not 0 <= bits <= 3:
        raise ValueError("the half grid with single steps is exact for 0 to 3 bits")
    members = stored(distinct.select("fp", F.explode(grid_cells(F.col("fp"))).alias("c")).select("fp", "c.cell", "c.own"), "cells")
    # A cell without own members pairs nothing; one with a single row neither.
    star = F.min_by("fp", F.xxhash64("fp"))
    cells = members.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("own").alias("used"), star.alias("star"))
    cells = stored(cells.filter("used AND rows > 1").select("cell", "rows", "star"), "shared_cells")
    members = stored(members.join(small(cells), "cell").select("cell", "rows", "star", "own", "fp"), "members")
    links = members.filter((F.col("fp") != F.col("star")) & (_distance("fp", "star") <= bits))
    links = stored(links.select(F.col("star").alias("a"), F.col("fp").alias("b")).distinct(), "stars")
    found = small(components(links))

    named = members.join(found, members.fp == found.node, "left").select("cell", "rows", "star", "own", "fp", F.coalesce("component", "fp").alias("component"))
    named = named.join(found.select(F.col("node").alias("star"), F.col("component").alias("sc")), "star", "left")
    named = stored(named.select("cell", "rows", "own", "fp", "component", (F.col("component") != F.coalesce("sc", "star")).alias("apart")), "named")
    left = named.groupBy("cell").agg(F.sum(F.col("apart").cast("long")).alias("n_apart")).filter("n_apart > 0")
    rest = stored(named.join(small(stored(left, "open_cells")), "cell"), "open_members")

    few = rest.filter(F.col("rows") <= NODE)
    one = few.filter("apart").select("cell", F.col("fp").alias("a"), F.col("component").alias("ca"))
    two = few.select("cell", F.col("fp").alias("b"), F.col("component").alias("cb"))
    near = one.join(two, "cell").filter((F.col("ca") != F.col("cb")) & (_distance("a", "b") <= bits)).select("a", "b").distinct()

    salts = F.ceil(F.col("n_apart") / NODE).cast("long")
    many = rest.filter(F.col("rows") > NODE)
    dealt = many.filter("apart").select("cell", F.pmod(F.xxhash64("fp"), salts).alias("salt"), F.lit(True).alias("block"), "fp", "component")
    visits = many.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(False).alias("block"), "fp", "component")
    more = stored(near.union(close_in_blocks(dealt.union(visits), bits)), "links")
    return components(links.union(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id that links reach)."""
    fps = stored(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = stored(fps.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    found = close_fingerprints(classes.select("fp"), bits)
    # Fingerprints reach each other by links, ids also by rows that share an id.
    groups = classes.join(small(found), classes.fp == found.node, "left").select("fp", F.coalesce("component", "fp").alias("root"))
    groups = stored(groups, "groups")
    own = fps.filter("id IS NOT NULL").join(groups, "fp").select("id", "root")
    tied = own.groupBy("id").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    if not tied.isEmpty():
        ends = own.distinct().join(tied.select("id", "a"), "id").filter("root <> a").select("a", F.col("root").alias("b"))
        again = components(stored(ends.distinct(), "shared_ids"))
        groups = groups.join(again, groups.root == again.node, "left").select("fp", F.coalesce("component", "root").alias("root"))
    least = classes.join(groups, "fp").groupBy("root").agg(F.min("rep").alias("component_id"))
    named = stored(groups.join(least, "root").select("fp", "component_id"), "components")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(named, "fp", "left").select("id", hexed, F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
