"""Ranked lexical search against brute force."""

import math
import random
import re
import string

import pytest

from paysheaf.llm import lexical

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms_by_hand(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def ranking(docs, items, k):
    found = [(i, terms_by_hand(t)) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    n_docs, words = len(found), sum(len(t) for _, t in found)
    df, out = {}, []
    for _, t in found:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    queries = {}
    for i, t in items:
        if i is not None:
            queries.setdefault(i, set()).update(terms_by_hand(t))
    for item, wanted in queries.items():
        scores = []
        for i, t in found:
            m = 50 + (50 * len(t) * n_docs) // words
            s = 0
            for x in wanted & set(t):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                s += w * ((1000000000 * t.count(x)) // (1000 * t.count(x) + 20 * m))
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_terms():
    text = "Ünïcode İstanbul a-b_c3\x00d\x7fe 漢字。x y"
    assert [t.decode() for t in lexical.terms(text.encode())] == terms_by_hand(text)
    assert lexical.terms(None) == lexical.terms(b" .,\n") == []


def test_edge_rows_match_brute_force(spark, edge, no_docs):
    rows, docs = edge
    items = [(1, rows[11][1][:200]), (2, "alpha1 beta2 İstanbul"), (3, None), (4, "nowhere"), (5, "one TWO x"), (5, "words one"), (None, "one"),
             (6, rows[8][1][-300:])]
    df = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS block", "2 AS row", "3 AS term")
    got = lexical.top_documents(docs, df, k=5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == ranking([(r[0], r[1]) for r in rows], items, 5)
    assert lexical.top_documents(no_docs, df).count() == 0
    assert lexical.top_documents(docs, df.limit(0)).count() == 0


@pytest.mark.parametrize("known", [400_000, 3])
def test_many_blocks_chunks_and_ties_match_brute_force(spark, monkeypatch, known):
    monkeypatch.setattr(lexical, "BLOCK", 40)
    monkeypatch.setattr(lexical, "ITEMS", 3)
    monkeypatch.setattr(lexical, "BROADCAST_KEYS", known)  # 3: the vocabulary is joined, not sent
    rng = random.Random(2)
    common, rare = [f"c{k}" for k in range(12)], [f"r{k}" for k in range(300)]
    text = lambda: " ".join(rng.choices(common, k=rng.randrange(5, 40)) + rng.sample(rare, rng.randrange(4)))
    docs = [(k, text()) for k in range(400)]
    docs += [(k, docs[7][1]) for k in range(1000, 1150)]  # ties beyond k, over many blocks
    docs += [docs[3], (5, "a different text of the same id c1 r1"), (None, "c1 c2 r1")]
    items = [(k, " ".join(rng.sample(common, 3) + rng.sample(rare, 3))) for k in range(8)] + [(20, docs[7][1]), (21, "c1 c2"), (22, "r5")]
    got = lexical.top_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                                spark.createDataFrame(items, "item_id long, text string"), k=20)
    assert sorted(tuple(r) for r in got.collect()) == ranking(docs, items, 20)


def test_a_visit_drops_only_what_cannot_be_listed():
    import pyarrow as pa
    bundles = pa.table({"block": [0], "chunk": [0], "item_id": [7], "best": [0], "rows": [[1]], "ids": [[10]], "sums": [[50]],
                        "term_ids": [[3]], "rest": [30]}, schema=pa.schema([
                            ("block", pa.int64()), ("chunk", pa.int64()), ("item_id", pa.int64()), ("best", pa.int64()), ("rows", pa.list_(pa.int64())),
                            ("ids", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64())), ("term_ids", pa.list_(pa.int64())), ("rest", pa.int64())]))
    postings = pa.table({"term_id": [3, 3, 3, 9], "row": [2, 3, 4, 4], "id": [20, 30, 40, 40], "c": [60, 30, 29, 99]})
    out = lexical.visit(2)(bundles, postings).to_pydict()
    # The second best sum is 50: 30 + 30 may still reach it, 29 + 30 too; with k = 1 they may not.
    assert out["best"] == [50] and out["ids"] == [[10, 20, 30, 40]] and out["sums"] == [[50, 60, 30, 29]]
    out = lexical.visit(1)(bundles, postings).to_pydict()
    assert out["best"] == [60] and out["ids"] == [[10, 20, 30]]
