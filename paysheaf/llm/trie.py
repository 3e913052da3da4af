"""Conversation prefix trie with a balanced rollup by centroid decomposition.

Conversations are rebuilt (a conversation may open with turns of an earlier one), and every distinct sequence
of first turns is a node. A node is named by its smallest member and its depth: members of different nodes of
one depth differ, so the name is unique, and the nodes above it lie on that member's own path.

1. Turns. A turn is known by its SHA-256, a prefix by two 64-bit words: the XOR, over its turns, of two hashes
   of position and turn. Positions and prefixes are running totals over short spans of a conversation, so
   that one very long conversation is spread over tasks. Texts are hashed where they lie and never move.
2. Nodes come from one aggregation over (depth, prefix); parents by the prefix without its last turn.
3. Rollup. The node weight is its number of members, whose sum below a node is known without a rollup: each
   member adds the turns it has left. The centroid of a component is the deepest node with more than half of
   its weight below it. What lies under the centroid is summed once for the whole component and added along
   the path from the centroid to the component's top; then the centroid goes, and the components under it and
   around it, each of at most half the weight, do the same. A node's total is the sum of what it was given.
   Rounds are joins over all large components at once; a component of ``BLOCK`` nodes or fewer is split to
   the end, by the same steps, inside a task. There are about log2(total weight / BLOCK) rounds, whatever
   the depth of the trie.
4. Members that end at a node are listed in spans of 512 identifiers, joined to strings, and hashed in order
   as a stream; no list of a node is ever held as a whole.

Defined results: turns are ordered by turn number, null first, then role, then the SHA-256 of role and text;
repeated rows are turns of their own; a null role or text is empty; rows with a null conversation id take no
part; conversations without turns are members of the root; very long texts are read whole; an empty table has
no nodes, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, running_before, small, stored

#: Nodes of a component that one task splits to the end.
BLOCK = 20_000
#: Successive turn numbers, and positions, that are ordered in one task: 2 ** SPAN.
SPAN = 8


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ordered_turns(table: DataFrame) -> DataFrame:
    """conv, pos (from 0), sha, words for every row with a conversation id."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    sha = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = table.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        sha.alias("sha"), words(text).alias("words")).filter("conv IS NOT NULL")
    rows = rows.withColumn("span", F.coalesce(F.shiftright("turn", SPAN), F.lit(-2**63))).withColumn("one", F.lit(1).cast("long"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("sha")]
    return running_before(rows, ["conv"], "span", order, "one", "pos").select("conv", "pos", "sha", "words")


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, len), and their rebuilt turns (conv, d from 1, sha, words).

    Conversation c takes the first h turns of c - c % every (the remainder has the sign of c), h = crc32(c) % most,
    then its own after h.
    """
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = stored(convs.withColumn("donor", F.col("conv") - F.col("conv") % every)
                   .withColumn("h", F.crc32(F.col("conv").cast("string")) % most), "conversations")
    donors = convs.filter("conv = donor").select("donor", F.col("n").alias("n_donor"))
    convs = convs.join(donors, "donor", "left").withColumn("taken", F.least("h", F.coalesce("n_donor", F.lit(0))))
    convs = convs.withColumn("len", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    convs = stored(convs.select("conv", "donor", "h", "taken", "len"), "lengths")
    heads = turns.filter((F.col("pos") < most - 1) & (F.col("conv") % every == 0)).withColumnRenamed("conv", "donor")
    first = convs.filter("taken > 0").join(heads, "donor").filter("pos < h").select("conv", F.col("pos") + 1, "sha", "words")
    own = turns.join(small(convs), "conv").filter("pos >= h").select("conv", F.col("pos") - F.col("h") + F.col("taken") + 1, "sha", "words")
    return convs.select("conv", "len"), first.union(own).toDF("conv", "d", "sha", "words")


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv, d, len, words, p1, p2 (prefix), q1, q2 (prefix without its last turn); d = 0 for every conversation."""
    rows = turns.select("conv", "d", "words", F.xxhash64(F.lit(1), "d", "sha").alias("x1"), F.xxhash64(F.lit(2), "d", "sha").alias("x2"),
                        F.shiftright("d", SPAN).alias("span"))
    ahead = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("conv", "span").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2")).join(convs, "conv")
    spans = spans.select("conv", "span", "len", *[F.coalesce(F.bit_xor(b).over(ahead), F.lit(0)).alias(b) for b in ("b1", "b2")])
    inside = Window.partitionBy("conv", "span").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    p = [F.col(f"b{k}").bitwiseXOR(F.bit_xor(f"x{k}").over(inside)) for k in (1, 2)]
    rows = rows.join(spans, ["conv", "span"]).select("conv", "d", "len", "words", "x1", "x2", p[0].alias("p1"), p[1].alias("p2"))
    rows = rows.select("conv", "d", "len", "words", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    return rows.union(convs.select("conv", zero, "len", zero, zero, zero, none, none))


def ends_digests(rows: DataFrame) -> DataFrame:
    """d, p1, p2, digest: SHA-256 of the ascending, comma-joined ids of the conversations that end there."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    spans = rows.filter("d = len").groupBy("d", "p1", "p2", F.shiftright("conv", 9).alias("span")).agg(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for d, p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in ("d", "p1", "p2", "ids"))):
                if key != (d, p1, p2):
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (d, p1, p2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digests(done)
        if key is not None:
            yield _digests([(*key, state.hexdigest())])

    order = spans.repartition("d", "p1", "p2").sortWithinPartitions("d", "p1", "p2", "span")
    return order.select("d", "p1", "p2", "ids").mapInArrow(run, "d long, p1 long, p2 long, digest string")


def _digests(done: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*done)) or [()] * 4
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["d", "p1", "p2", "digest"])


def split_component(conv: list[int], depth: list[int], parent_conv: list, weight: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree totals inside one component, by centroid decomposition; the first node given is its top."""
    at = {k: i for i, k in enumerate(zip(conv, depth))}
    parent = [-1] + [at[c, d - 1] for c, d in zip(parent_conv[1:], depth[1:])]
    children: list[list[int]] = [[] for _ in conv]
    for i, p in enumerate(parent[1:], 1):
        children[p].append(i)
    below, totals = list(weight), [[0] * len(conv) for _ in values]
    tops = [0]
    while tops:
        top = z = tops.pop()
        half, path = below[top], [top]
        while (heavy := next((c for c in children[z] if 2 * below[c] > half), None)) is not None:
            z = heavy
            path.append(z)
        under, stack = [0] * len(values), [z]
        while stack:
            v = stack.pop()
            for k, x in enumerate(values):
                under[k] += x[v]
            stack += children[v]
        for v in path:
            for k, x in enumerate(under):
                totals[k][v] += x
        tops += children[z]
        if z != top:
            for v in path[:-1]:
                below[v] -= below[z]
            children[path[-2]].remove(z)
            tops.append(top)
    return totals


def finished(nodes: DataFrame) -> DataFrame:
    """conv, depth, leaves, saved: totals inside components of which each fits a task."""
    def act(batch: pa.Table) -> pa.RecordBatch:
        tops = np.stack([batch.column(c).to_numpy() for c in ("top_conv", "top_depth")])
        starts = np.flatnonzero(np.concatenate([[True], (tops[:, 1:] != tops[:, :-1]).any(axis=0)]))
        rows = {c: batch.column(c).to_pylist() for c in ("conv", "depth", "parent_conv", "below", "leaves", "saved")}
        out: list[list[int]] = [[], []]
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
            part = {c: v[lo:hi] for c, v in rows.items()}
            totals = split_component(part["conv"], part["depth"], part["parent_conv"], part["below"], [part["leaves"], part["saved"]])
            for o, t in zip(out, totals):
                o += t
        return pa.RecordBatch.from_arrays([pa.array(rows["conv"], pa.int64()), pa.array(rows["depth"], pa.int64()), *[pa.array(o, pa.int64()) for o in out]],
                                          names=["conv", "depth", "leaves", "saved"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            tops = np.stack([held.column(c).to_numpy() for c in ("top_conv", "top_depth")])
            last = int(np.flatnonzero((tops != tops[:, -1:]).any(axis=0)).max(initial=-1)) + 1
            if last:
                yield act(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield act(held)

    order = nodes.repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth", "depth", "conv")
    return (order.select("top_conv", "top_depth", "conv", "depth", "parent_conv", "below", "leaves", "saved")
            .mapInArrow(run, "conv long, depth long, leaves long, saved long"))


def subtree_totals(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """conv, depth, leaves, saved: sums over the subtree of every node.

    nodes: conv, depth, parent_conv, below (weight of the subtree), leaves, saved (the node's own). paths:
    conv, depth, node_conv, parent_conv: the nodes on the path of every conversation that names a node.
    """
    top = nodes.filter("depth = 0").select(F.col("conv").alias("top_conv"), F.col("depth").alias("top_depth"))
    root = top.first()
    if root is None:
        return nodes.select("conv", "depth", "leaves", "saved")
    # Not as literals: joins on constant keys would be planned as nested loops.
    first = [F.when(F.col("depth") >= 0, v).alias(k) for k, v in root.asDict().items()]
    now = nodes.select(*first, "conv", "depth", "parent_conv", "below", "leaves", "saved")
    given, key, level = [], ["top_conv", "top_depth"], 0
    while True:
        parts = now.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("below").alias("total"))
        large = stored(parts.filter(F.col("n") > BLOCK).select(*key, "total"), f"large_{level}")
        if large.isEmpty():
            given.append(finished(now))
            break
        large = small(large)
        given.append(finished(now.join(large, key, "left_anti")))
        now = now.join(large, key)
        centre = now.filter(2 * F.col("below") > F.col("total")).groupBy(*key).agg(F.max_by(F.struct("conv", "depth", "below"), "depth").alias("z"))
        centre = centre.select(*key, F.col("z.conv").alias("z_conv"), F.col("z.depth").alias("z_depth"), F.col("z.below").alias("z_below"))
        centre = small(stored(centre, f"centroids_{level}"))
        now = now.join(centre, key)

        # Under the centroid: on its own conversation's path, or with the centroid on the path of the node's name.
        deeper = F.col("depth") > F.col("z_depth")
        look = F.when(deeper & (F.col("conv") != F.col("z_conv")), F.col("conv"))
        step = paths.select(F.col("conv").alias("look_conv"), F.col("depth").alias("look_depth"), F.col("node_conv").alias("child"), F.col("parent_conv").alias("above"))
        now = now.withColumn("look", look).join(step, (F.col("look") == F.col("look_conv")) & (F.col("z_depth") + 1 == F.col("look_depth")), "left")
        own = (F.col("conv") == F.col("z_conv")) & (F.col("depth") >= F.col("z_depth"))
        now = now.withColumn("under", own | F.coalesce(F.col("above") == F.col("z_conv"), F.lit(False)))
        now = stored(now.select(*key, "conv", "depth", "parent_conv", "below", "leaves", "saved", "z_conv", "z_depth", "under",
                                F.coalesce("child", "z_conv").alias("child")), f"nodes_{level}")
        sums = now.filter("under").groupBy(*key).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        centre = small(stored(centre.join(sums, key), f"sums_{level}"))
        up = paths.select(F.col("conv").alias("z_conv"), F.col("depth").alias("path_depth"), "node_conv").join(centre, "z_conv")
        up = stored(up.filter("path_depth BETWEEN top_depth AND z_depth").select(
            F.col("node_conv").alias("conv"), F.col("path_depth").alias("depth"), "leaves", "saved", F.col("z_below")), f"up_{level}")
        given.append(up.select("conv", "depth", "leaves", "saved"))

        less = up.select("conv", "depth", F.col("z_below").alias("less"))
        rest = now.filter(~(F.col("under") & (F.col("depth") == F.col("z_depth")))).join(small(less), ["conv", "depth"], "left")
        now = stored(rest.select(F.when(F.col("under"), F.col("child")).otherwise(F.col("top_conv")).alias("top_conv"),
                                 F.when(F.col("under"), F.col("z_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"), "conv", "depth", "parent_conv",
                                 (F.col("below") - F.when(F.col("under"), F.lit(0)).otherwise(F.coalesce("less", F.lit(0)))).alias("below"), "leaves", "saved"), f"parts_{level}")
        level += 1
    parts = given[0]
    for more in given[1:]:
        parts = parts.union(more)
    return parts.groupBy("conv", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def prefix_trie(table: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    turns = stored(ordered_turns(table), "turns")
    convs, rebuilt_turns = rebuilt(turns)
    rows = stored(prefixes(convs, rebuilt_turns), "prefixes")
    nodes = rows.groupBy("d", "p1", "p2").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("q1").alias("q1"),
                                              F.max("q2").alias("q2"), F.sum(F.col("len") - F.col("d") + 1).alias("below"))
    nodes = stored(nodes, "nodes")
    children = stored(nodes.filter("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children")), "children")
    parents = small(nodes.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent_conv")))
    tree = nodes.join(children, ["d", "p1", "p2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    tree = stored(tree.join(parents, ["d", "q1", "q2"], "left").select("d", "p1", "p2", "conv", "parent_conv", "n_convs", "n_children", "words", "below"), "tree")

    named = small(stored(tree.select("conv").distinct(), "names"))
    on_path = small(tree.select("d", "p1", "p2", F.col("conv").alias("node_conv"), "parent_conv"))
    paths = stored(rows.join(named, "conv", "left_semi").select("conv", "d", "p1", "p2").join(on_path, ["d", "p1", "p2"])
                   .select("conv", F.col("d").alias("depth"), "node_conv", "parent_conv"), "paths")
    own = tree.select("conv", F.col("d").alias("depth"), "parent_conv", "below", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                      ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = stored(subtree_totals(own, paths), "totals")
    out = tree.join(ends_digests(rows), ["d", "p1", "p2"], "left").withColumnRenamed("d", "depth").join(totals, ["conv", "depth"])
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), F.coalesce("digest", empty).alias("ends_sha256"))
