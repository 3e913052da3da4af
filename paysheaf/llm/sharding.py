"""Sharding by balanced label propagation.

Documents are nodes, links join them (here: equal texts, as stars around the group's first document).
Labels start as an exact deal by hash: shard sizes differ by one at most. In each round half of the
linked documents look at their neighbours' shards (a Spark join and a partial count) and want to move to
the shard with most of them if it has more than their own. Quotas keep the sizes: what enters a shard
must leave it. Wishes for i -> j and j -> i cancel out, and documents without links, which lose nothing,
move the other way for the rest. Within a quota, movers are taken in hash order, counted by bins, so a
group with a third of all documents is never brought into one task. Sizes thus stay as dealt in every
round, and each move brings a document to more of its neighbours.

Only the 8 x 8 table of wishes reaches the driver.

Defined results: a null text has no bytes (size 1) and is equal to other null texts; null ids and
repeated ids are documents of their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bin_bits, hash_bin, running_before, small, stored

ROUNDS = 6


def document_nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                    (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                    F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                    F.coalesce(F.sha2(text, 256), F.lit("")).alias("sha"))
    return d.withColumn("h", F.xxhash64(F.lit(11), "doc_id"))


def equal_text_links(nodes: DataFrame) -> DataFrame:
    """a, b: every document of a group of equal texts with the group's first row."""
    hubs = nodes.groupBy("sha").agg(F.min("row").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha", "hub")
    return nodes.join(stored(hubs, "hubs"), "sha").filter("row <> hub").select(F.col("row").alias("a"), F.col("hub").alias("b"))


def _quotas(wishes: dict[tuple[int, int], int], free: list[int], shards: int) -> tuple[dict[tuple[int, int], int], list[int]]:
    """How many of the wishes i -> j are met, and by how many free documents each shard gives way (below 0:
    takes in). Met wishes are cut until no shard must give way with more free documents than it has."""
    met = dict(wishes)
    while True:
        change = [sum(n for (_, j), n in met.items() if j == s) - sum(n for (i, _), n in met.items() if i == s) for s in range(shards)]
        over = [s for s in range(shards) if change[s] > free[s]]
        if not over:
            return met, change
        s = over[0]
        cut = change[s] - free[s]
        for i in range(shards):
            less = min(cut, met.get((i, s), 0))
            if less:
                met[(i, s)] -= less
                cut -= less


def propagate(nodes: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """nodes: row, h. links: a, b. Returns row, h, shard, with shard sizes one apart at most."""
    n = nodes.count()
    bits = bin_bits(n)
    nodes = nodes.select("row", "h", hash_bin(F.col("h"), bits).alias("bin"), F.lit(1).cast("long").alias("one"))
    dealt = running_before(nodes, [], "bin", [F.col("h"), F.col("row")], "one", "place")
    now = dealt.select("row", "h", "bin", "one", F.pmod("place", F.lit(shards)).cast("int").alias("shard"))
    links = stored(links, "links")
    both = stored(links.union(links.select("b", "a")).toDF("a", "b"), "both")
    linked = stored(both.select(F.col("a").alias("row")).distinct(), "linked").withColumn("tied", F.lit(True))
    now = stored(now.join(small(linked), "row", "left").withColumn("tied", F.coalesce("tied", F.lit(False))), "labels")
    for r in range(rounds):
        free = {x["shard"]: x["n"] for x in now.filter("not tied").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        tied = now.filter("tied").select("row", "h", "bin", "one", "shard")
        seen = both.join(tied.select(F.col("row").alias("b"), F.col("shard").alias("near")), "b").groupBy("a", "near").agg(F.count(F.lit(1)).alias("n"))
        best = seen.groupBy("a").agg(F.max(F.struct("n", (-F.col("near")).alias("low"))).alias("top"),
                                     F.map_from_entries(F.collect_list(F.struct("near", "n"))).alias("all"))
        wants = tied.join(best, tied.row == best.a).select(
            "row", "h", "bin", "one", "shard", (-F.col("top.low")).cast("int").alias("to"),
            (F.col("top.n") > F.coalesce(F.element_at("all", F.col("shard")), F.lit(0))).alias("better"))
        # Half of the documents at a time, another half each round: two neighbours do not just change places.
        wants = stored(wants.filter(F.col("better") & (F.pmod(F.xxhash64("h", F.lit(r)), F.lit(2)) == 0)), "wants")
        wishes = {(x["shard"], x["to"]): x["n"] for x in wants.groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not wishes:
            continue
        met, change = _quotas(wishes, [free.get(s, 0) for s in range(shards)], shards)
        moved = running_before(wants, ["shard", "to"], "bin", [F.col("h"), F.col("row")], "one", "place")
        allowed = F.element_at(F.create_map(*[F.lit(x) for (i, j), q in met.items() for x in (f"{i}>{j}", q)]), F.concat_ws(">", "shard", "to"))
        moved = moved.filter(F.col("place") < allowed).select("row", "to")
        # Free documents leave the shards that grow, in hash order, and fill those that shrink, in turn.
        leave = [max(c, 0) for c in change]
        first = [sum(leave[:s]) for s in range(shards)]
        pick = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("shard") + 1)
        away = now.filter("not tied").filter(pick(leave) > 0).drop("tied")
        away = running_before(away, ["shard"], "bin", [F.col("h"), F.col("row")], "one", "place").filter(F.col("place") < pick(leave))
        turn = F.col("place") + pick(first)
        fill, upto = F.lit(shards - 1), 0
        for s in range(shards):
            upto += max(-change[s], 0)
            fill = F.when((turn < upto) & (F.lit(upto) > 0), F.lit(s)) if s == 0 else fill.when(turn < upto, F.lit(s))
        away = away.select("row", fill.cast("int").alias("to"))
        moves = stored(moved.union(away), "moves")
        now = stored(now.join(small(moves), "row", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"), "labels")
    return now


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, sha, row; row counts of shards differ by one at most."""
    nodes = stored(document_nodes(docs, id_col, text_col), "nodes")
    labels = propagate(nodes, equal_text_links(nodes), shards, rounds)
    slots = running_before(labels.select("row", "h", "bin", "one", "shard"), ["shard"], "bin", [F.col("h"), F.col("row")], "one", "slot")
    out = nodes.join(slots.select("row", "shard", "slot"), "row")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"), "sha", "row")


def cut_links(sharded: DataFrame) -> DataFrame:
    """links, cut: how many star links of equal texts there are, and how many cross shards."""
    hubs = sharded.groupBy("sha").agg(F.min(F.struct("row", "shard")).alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = sharded.join(hubs, "sha").filter("row <> hub.row")
    return pairs.agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("shard") != F.col("hub.shard")).alias("cut"))
