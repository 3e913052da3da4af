"""SimHash near duplicates against brute force."""

import random
import re
import string

import pytest
import xxhash

from paysheaf.llm import simhash

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def fingerprint_by_hand(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_near_duplicates_match_brute_force(edge, no_docs):
    rows, docs = edge
    fps = [fingerprint_by_hand(r[1]) for r in rows]
    ids = [r[0] for r in rows]
    pairs = [(ids[a], ids[b]) for a in range(len(rows)) for b in range(a) if None not in (ids[a], ids[b]) and (fps[a] ^ fps[b]).bit_count() <= 3]
    root = roots(pairs, {i for i in ids if i is not None})
    want = sorted(((i, f"{fp:016x}", root.get(i)) for i, fp in zip(ids, fps)), key=str)
    got = simhash.near_duplicates(docs)
    assert got.columns == ["id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def cloud(rng, centres, each):
    """Fingerprints around centres: dense balls with stragglers, and pairs at exactly 3 and 4 bits."""
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        out.add(c)
        for _ in range(each):
            x = c
            for _ in range(rng.choice((1, 2, 3, 4, 5, 6))):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    for _ in range(300):
        c = rng.getrandbits(64)
        x = c
        for k in rng.sample(range(64), rng.choice((3, 4))):
            x ^= 1 << k
        out |= {c, x}
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits,node", [(3, 256), (3, 8), (1, 8), (0, 8)])
def test_close_fingerprints_match_brute_force(spark, monkeypatch, bits, node):
    monkeypatch.setattr(simhash, "NODE", node)  # small nodes: open cells go through blocks and visitors
    fps = sorted(map(signed, cloud(random.Random(node + bits), 6, 120) | {0, 2**64 - 1, 1, 2**63}))
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= bits]
    root = roots(pairs, fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(5)
    got = {r.node: r.component for r in simhash.close_fingerprints(df, bits).collect()}
    assert got == {f: r for f, r in root.items() if f != r}


def test_cells_bound_the_distance(spark):
    """Pairs within three bits share a cell of which one of them is an own member."""
    rng = random.Random(4)
    pairs = []
    for _ in range(400):
        a = b = rng.getrandbits(64)
        for k in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << k
        pairs.append((signed(a), signed(b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select(simhash.grid_cells(df.a).alias("a"), simhash.grid_cells(df.b).alias("b")).collect():
        a, b = {c.cell: c.own for c in r.a}, {c.cell: c.own for c in r.b}
        assert any(a[c] or b[c] for c in a.keys() & b.keys())
        assert sum(a.values()) == sum(b.values()) == 2


def test_fingerprint_counts_repeats_and_ties():
    assert simhash.fingerprint(b"a a a a b", 3) == fingerprint_by_hand("a a a a b")
    assert simhash.fingerprint(b"A b c d", 3) == fingerprint_by_hand("a B c D")  # two shingles: ties are 0
    long = " ".join(f"w{k % 977}" for k in range(20_000))
    assert simhash.fingerprint(long.encode(), 3) == fingerprint_by_hand(long)
    assert simhash.fingerprint(None, 3) == simhash.fingerprint(b" \n", 3) == 0
