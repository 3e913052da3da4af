"""Exact top-k search by inner product with a paged M-tree, searched best first.

Inner products become distances by one extra component: with M the largest norm, x' = (x, sqrt(M^2 -
|x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so that the largest product is the
nearest point of a metric space.

The tree has routing objects (a sample of at most ``ROUTERS`` rows, chosen by the hash of their id) and
below each its pages: every row belongs to its nearest router; a router with many rows has many pages,
dealt by the hash of the id, so that one vector that a third of the rows repeat fills pages evenly. A page
keeps its covering radius and, sorted, its rows' distances to the router (their parent).

A search takes a block of queries and a group of pages. Pages are visited by their smallest possible
distance. A query skips a page that cannot hold anything as near as its k-th result, and inside a page
the rows whose stored parent distance already tells, by the triangle inequality, that they are farther
away; only the others are multiplied. Scores are integers and exact; bounds get a margin for rounding.

Defined results: vectors that are null or hold a null or non-finite component, and rows without an id,
take no part; shorter vectors count as padded with zeros; a query's own row is every row with its id; an
id that occurs more than once is listed once, with its largest score; extra columns are ignored; empty
tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ROUTERS = 64
PAGE_ROWS = 256
#: Queries and pages that meet in one task.
BLOCK_QUERIES = 256
GROUP_PAGES = 32


def components_of(vector: Column) -> Column:
    """floor(64 x) of every component, as doubles (whole numbers)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 64).cast("double"))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def matrix(lists: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim))
    for k, v in enumerate(lists):
        out[k, :len(v)] = v
    return out


class Space:
    """The metric space: dimension, largest squared norm, routers with their extra components."""

    def __init__(self, dim: int, largest: float, most: float, routers: np.ndarray) -> None:
        self.dim, self.largest, self.routers = dim, largest, routers
        #: Sums of whole-number products below 2^53 are exact in doubles.
        self.exact = most * most * max(dim, 1) < 2.0 ** 53
        self.norms = (routers ** 2).sum(axis=1)
        self.extra = np.sqrt(np.maximum(largest - self.norms, 0))

    def to_routers(self, x: np.ndarray) -> np.ndarray:
        """Distances of rows to all routers."""
        norm = (x ** 2).sum(axis=1)
        extra = np.sqrt(np.maximum(self.largest - norm, 0))
        d2 = norm[:, None] + self.norms[None, :] - 2 * x @ self.routers.T + (extra[:, None] - self.extra[None, :]) ** 2
        return np.sqrt(np.maximum(d2, 0))

    def query_to_routers(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q ** 2).sum(axis=1)[:, None] + self.largest - 2 * q @ self.routers.T, 0))

    def products(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        if self.exact:
            return (q @ x.T).astype(np.int64)
        whole = [[int(v) for v in row] for row in x]
        limit = 2 ** 63 - 1
        return np.array([[max(-limit, min(limit, sum(int(a) * b for a, b in zip(row, other)))) for other in whole] for row in q], dtype=np.int64)


def _routed(space, rows: DataFrame) -> DataFrame:
    """router (number of the nearest one) for each row of id, v."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                d = space.value.to_routers(matrix(part.column("v").to_pandas(), space.value.dim))
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("v"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])],
                    names=["id", "v", "router", "parent"])

    return rows.select("id", "v").mapInArrow(run, "id long, v array<double>, router int, parent double")


def build_pages(space, rows: DataFrame) -> DataFrame:
    """One row per page: router, page, radius, ids, parents (sorted), vectors; the last three packed."""
    routed = stored(_routed(space, rows), "routed")
    counts = routed.groupBy("router").agg(F.ceil(F.count(F.lit(1)) / PAGE_ROWS).cast("int").alias("pages"))
    pages = {r["router"]: r["pages"] for r in counts.collect()}  # at most ROUTERS rows
    if not pages:
        pages = {0: 1}
    deal = F.element_at(F.create_map(*[F.lit(x) for kv in pages.items() for x in kv]), F.col("router"))
    # Hashing by id keeps repeated rows of an id and vector in one page.
    routed = routed.withColumn("page", F.pmod(F.xxhash64("id"), deal).cast("int"))

    def page(f: pd.DataFrame) -> pd.DataFrame:
        f = f.assign(key=[v.tobytes() for v in f["v"]]).drop_duplicates(["id", "key"]).sort_values(["parent", "id"])
        x = matrix(f["v"], space.value.dim)
        return pd.DataFrame({"router": [f["router"].iloc[0]], "page": [f["page"].iloc[0]], "radius": [f["parent"].max()],
                             "ids": [f["id"].to_numpy(np.int64).tobytes()], "parents": [f["parent"].to_numpy().tobytes()],
                             "vectors": [packed(x)]})

    return routed.groupBy("router", "page").applyInPandas(
        page, "router int, page int, radius double, ids binary, parents binary, vectors binary")


def packed(x: np.ndarray) -> bytes:
    """Whole numbers in two bytes each where they fit, else as doubles; the first byte tells."""
    return b"h" + x.astype("<i2").tobytes() if np.abs(x).max(initial=0) < 2 ** 15 else b"d" + x.astype("<f8").tobytes()


def unpacked(b: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(b[1:], "<i2" if b[:1] == b"h" else "<f8").astype(np.float64).reshape(-1, dim)


class Best:
    """The k best (score, id) of one query so far, best first."""

    def __init__(self, k: int) -> None:
        self.k, self.found = k, {}

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for s, i in zip(scores.tolist(), ids.tolist()):
            if s > self.found.get(i, s - 1):
                self.found[i] = s
        if len(self.found) > self.k:
            self.found = dict(sorted(self.found.items(), key=lambda x: (-x[1], x[0]))[:self.k])

    def floor(self) -> float:
        return min(self.found.values()) if len(self.found) >= self.k else -np.inf


def best_first(space: Space, ids: np.ndarray, q: np.ndarray, pages: pd.DataFrame, k: int) -> list[Best]:
    """The k best rows of ``pages`` for every query, pages with the smallest possible distance first."""
    best = [Best(k) for _ in ids]
    norms = (q ** 2).sum(axis=1)
    to_router = space.query_to_routers(q)
    margin = 1e-6 * (norms + space.largest + 1)
    router, radius = pages["router"].to_numpy(), pages["radius"].to_numpy()
    near = np.maximum(to_router[:, router] - radius[None, :], 0)
    possible = (norms[:, None] + space.largest - near ** 2) / 2 + margin[:, None]
    floor = np.full(len(ids), -np.inf)
    for p in np.argsort(near.min(axis=0), kind="stable"):
        active = np.flatnonzero(possible[:, p] >= floor)
        if not len(active):
            continue
        parents = np.frombuffer(pages["parents"].iloc[p], np.float64)
        at = to_router[active, router[p]]
        # The k-th result's distance; a row farther than that by its stored parent distance is never multiplied.
        reach = np.sqrt(np.maximum(norms[active] + space.largest - 2 * floor[active] + 2 * margin[active], 0)) + 1e-6
        lo = np.searchsorted(parents, (at - reach).min(), "left")
        hi = np.searchsorted(parents, (at + reach).max(), "right")
        if lo >= hi:
            continue
        found = np.frombuffer(pages["ids"].iloc[p], np.int64)[lo:hi]
        scores = space.products(q[active], unpacked(pages["vectors"].iloc[p], space.dim)[lo:hi])
        for row, a in enumerate(active):
            good = np.flatnonzero((scores[row] >= floor[a]) & (found != ids[a]))
            if len(good) > 4 * k:  # all ties of the k-th best of this page stay
                least = np.partition(scores[row][good], len(good) - 2 * k)[len(good) - 2 * k]
                many = good[scores[row][good] >= least]
                good = many if len(set(found[many].tolist())) >= k else good
            if len(good):
                best[a].offer(scores[row][good], found[good])
                floor[a] = best[a].floor()
    return best


def top_k(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products, ties to the smaller id."""
    spark = rows.sparkSession
    v = rows.select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"), F.col(vector_col).alias("raw"))
    v = v.filter(F.col("id").isNotNull() & usable(F.col("raw"))).select("id", "asks", components_of(F.col("raw")).alias("v"))
    v = stored(v, "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = v.agg(F.max(F.size("v")).alias("dim"), F.max(norm).alias("largest"), F.max(F.array_max(F.transform("v", F.abs))).alias("most"),
                  F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("queries")).first()
    schema = "query_id long, vec_id long, score long"
    sample = v.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(ROUTERS).toPandas()
    dim = max(facts["dim"] or 0, 1)
    routers = matrix(sample["v"], dim) if len(sample) else np.zeros((1, dim))
    space = spark.sparkContext.broadcast(Space(dim, facts["largest"] or 0.0, facts["most"] or 0.0, routers))
    pages = stored(build_pages(space, v.select("id", "v")), "pages")

    blocks = max(1, -(-facts["queries"] // BLOCK_QUERIES))
    groups = max(1, -(-pages.count() // GROUP_PAGES))
    asked = v.filter("asks").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asked = asked.select("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "id", "v")
    offered = pages.withColumn("part", F.pmod(F.xxhash64("router", "page"), F.lit(groups)).cast("int"))
    offered = offered.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "part", *pages.columns)

    def search(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        ids = q["id"].to_numpy(np.int64)
        best = best_first(space.value, ids, matrix(q["v"], space.value.dim), p, k)
        found = [(i, x, s) for i, b in zip(ids.tolist(), best) for x, s in b.found.items()]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = asked.groupBy("block", "part").cogroup(offered.groupBy("block", "part")).applyInPandas(search, schema)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
