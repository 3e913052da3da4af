"""Mixing, top-k search, BPE and sharding against brute force, the library, or their own laws."""

import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paysheaf.llm import bpe, mixing, mtree, sharding

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def water_level(sizes, weights, most):
    """Targets by repeated sharing: sources over their limit stop there, the rest share again."""
    total, target, open_ = sum(sizes.values()), {}, dict(weights)
    while open_:
        level = (total - sum(target.values())) / sum(open_.values())
        over = [s for s in open_ if level * open_[s] > most * sizes[s]]
        if not over:
            return target | {s: level * w for s, w in open_.items()}
        for s in over:
            target[s] = most * sizes[s]
            del open_[s]
    return target


def test_mix_reaches_its_targets(edge, no_docs):
    rows, docs = edge
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_level(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 3)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        taken[r.source] += r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) <= 1
    assert sorted(map(tuple, mixing.mixed(docs).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mixed(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mix_is_a_queue_by_finish_time(edge):
    _, docs = edge
    _, served = mixing.mix(docs)
    items = sorted(served.collect(), key=lambda r: r.position)
    assert all(a.finish <= b.finish and a.position + a.words == b.position for a, b in zip(items, items[1:]))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1000}, {"a": 0, "b": 5}, {"a": 1}, {"a": 7, "b": 7, "c": 7, None: 900}])
def test_targets_are_water_levels(spark, sizes):
    t = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), [5, 2, 1], 3).collect()
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_level(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 3)
    assert {r.source: round(r.target, 6) for r in t} == {s: round(float(v), 6) for s, v in want.items()}


def by_hand(vectors, k):
    usable = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, []).append([math.floor(64 * float(np.float32(x))) for x in v])
    out = set()
    for q in (i for i in usable if i % 20 == 0):
        best = {i: max(sum(a * b for a, b in zip(u, w)) for u in usable[q] for w in vs) for i, vs in usable.items() if i != q}
        out |= {(q, r, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1)}
    return out


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    vectors += [(i, [0.5] * 8) for i in range(700, 1100)]  # one vector that a third of the rows repeat
    vectors += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7), (None, [1.0] * 8),
                (2020, []), (2021, [1.0, -1.0]), (3, vectors[3][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<float>, id string, page int").repartition(5)
    got = {tuple(r) for r in mtree.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == by_hand(vectors, 20)
    assert mtree.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = df.filter("vec_id IN (20, 21, 22)")
    assert mtree.top_k(few, F.col("vec_id") % 20 == 0).count() == 2


def test_large_components_are_exact(spark):
    vectors = [(i, [3e6 + i, -2e6 * i, 1.5]) for i in range(25)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in mtree.top_k(df, F.col("vec_id") % 20 == 0, 5).collect()} == by_hand(vectors, 5)


ODD_TEXTS = [None, "", "a<|endoftext|>B  <|startoftext|>", "''s !'s don't İΣΑΣ ΣΑΣ\x1c\x1dx Ａ１２３ ½²", "é ́x 你好，世界 🙂🙂 ​ z\u0085q",
             "x" * 5000, "İ'S 'LL''ll", "<|endoftext|", "힣ᄀ ᆨ가", "\x00\x01 \x7f", "a-b_c!?..;\"'\n\n\t$1,234.50%"]


def test_bpe_equals_the_library(spark, edge, no_docs):
    rows, docs = edge
    more = spark.createDataFrame([(20_000 + k, t) for k, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    texts = [(r[0], r[1]) for r in rows] + [(20_000 + k, t) for k, t in enumerate(ODD_TEXTS)]
    library = Tokenizer.from_file(VOCAB)
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    both = docs.select("doc_id", "text").union(more)
    assert sorted(map(tuple, bpe.digests(both, VOCAB).collect()), key=str) == sorted(want, key=str)
    ids = bpe.encode(both, VOCAB)
    decoded = {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in bpe.decode(ids, VOCAB).collect()}
    assert decoded == {(w[0], w[3]) for w in want}
    assert bpe.digests(no_docs, VOCAB).count() == 0


def test_bpe_tables_may_be_dropped_at_any_time(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50)
    words_ = bpe.Vocabulary(VOCAB)
    library = Tokenizer.from_file(VOCAB)
    for k in range(20):
        text = " ".join(f"tiontion{k}x{j},ing" for j in range(30))
        assert np.frombuffer(words_.encode([text])[0][0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_keeps_what_recurs(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50)
    words_, cut, seen = bpe.Vocabulary(VOCAB), bpe.Vocabulary._cut, []
    monkeypatch.setattr(bpe.Vocabulary, "_cut", lambda self, f: seen.append(f) or cut(self, f))
    library = Tokenizer.from_file(VOCAB)
    for k in range(20):
        text = "often " + " ".join(f"tion{k}x{j}" for j in range(30))
        assert np.frombuffer(words_.encode([text])[0][0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(words_.known) <= 50
    assert seen.count("often") == 1 and len(seen) == 601


def test_shards_are_even_and_keep_copies_together(spark, edge, no_docs):
    rows, docs = edge
    out = sharding.shard(docs)
    got = out.collect()
    assert len(got) == len(rows)
    counts = [sum(r.shard == s for r in got) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    want = sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == want
    assert sharding.shard(no_docs).count() == 0


def test_propagation_cuts_few_links(spark):
    many = [(k, f"text {k // 3}" if k < 600 else "the same" if k < 1000 else f"single {k}") for k in range(3000)]
    docs = spark.createDataFrame(many, "doc_id long, text string")
    dealt = sharding.cut_links(sharding.shard(docs, rounds=0)).first()
    moved = sharding.cut_links(sharding.shard(docs)).first()
    assert dealt.links == moved.links == 799
    assert moved.cut < 0.35 * dealt.cut  # one group of 400 does not fit a shard of 375
    counts = [r["count"] for r in sharding.shard(docs).groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1
