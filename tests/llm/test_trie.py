"""The conversation prefix trie against brute force."""

import hashlib
import math
import random
import re
import zlib

import pytest

from paysheaf.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, conv string, d int, len int"


def trie_by_hand(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    seqs = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, s in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = seqs.get(c - int(math.fmod(c, 20)), [])[:h] + s[h:]
    members = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, m in members.items():
        sub = [q for q in members if q[:len(p)] == p]
        leaves = [q for q in sub if not any(len(x) == len(q) + 1 and x[:-1] == q for x in members)]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in sub if q)
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(len(x) == len(p) + 1 and x[:-1] == p for x in members),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(11)
    rows = []
    for c in [*range(90), 200, 201, 215, 4000, 4001]:  # 90 .. lack some of their first conversations
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(("user", "assistant", None)), rng.choice(("hi", "a b  c", "", None, "x\ty", "long " * 30))))
    rows += [(c, t, "user", f"same {t}") for c in range(300, 330) for t in range(5)]  # copies
    rows += [(340, t, "user", f"deep {t // 2}") for t in range(700)]  # one deep path
    rows += [(360, t, "user", f"deep {t // 2}") for t in range(300)] + [(360, t, "user", "other") for t in range(300, 310)]
    rows += [(41, None, "user", "null turn"), (41, None, "user", "null turn"), (42, 1, "a", "bc"), (42, 1, "ab", "c"), (None, 1, "user", "x"), (43, 2, None, None), (-7, 3, "user", "minus")]
    return rows


@pytest.mark.parametrize("block", [20_000, 40, 1])  # 1: every split is a round of joins
def test_trie_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "SPAN", 4)
    rows = conversations()
    if block == 1:
        rows = [r for r in rows if r[0] not in (340, 360) and (r[1] or 0) < 4]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(5)
    got = trie.prefix_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie_by_hand(rows)


def test_empty_table_has_no_nodes(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "", 1, 1)], SCHEMA)).count() == 0


def test_split_component_halves_every_part():
    rng = random.Random(3)
    parent = [None] + [rng.randrange(i) for i in range(1, 300)]
    depth = [0]
    for p in parent[1:]:
        depth.append(depth[p] + 1)
    order = sorted(range(300), key=lambda i: depth[i])
    value = [rng.randrange(9) for _ in range(300)]
    want, below = list(value), [1] * 300
    for i in sorted(range(1, 300), key=lambda i: -depth[i]):
        want[parent[i]] += want[i]
        below[parent[i]] += below[i]
    got = trie.split_component(order, [depth[i] for i in order], [parent[i] for i in order], [below[i] for i in order], [[value[i] for i in order]])
    assert got[0] == [want[i] for i in order]
