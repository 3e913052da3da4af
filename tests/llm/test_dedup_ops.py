"""Exact dedup, line dedup and the n-gram Jaccard join against brute force."""

import hashlib
import random
import re
import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysheaf.llm import components, exact_dedup, line_dedup, ngram_join
from paysheaf.llm.common import stored
from paysheaf.llm.shingles import shingles

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def norm(t):
    return (t or "").translate(LOW)


def grouped(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    return groups


@pytest.mark.parametrize("bits", [64, 2])  # two bits of hash: nearly every hash stands for several chunks
def test_exact_groups_match_brute_force(edge, bits):
    rows, docs = edge
    got = {(r.id, r.text_sha256): r for r in exact_dedup.exact_groups(docs, hash_bits=bits).collect()}
    assert len(got) == len({(r[0], norm(r[1])) for r in rows})
    for text, ids in grouped(rows).items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            r = got[i, sha]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), i == keep)


def test_deduplicate_keeps_one_row_of_each_text_with_its_columns(edge, no_docs):
    rows, docs = edge
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(norm(r.text) for r in left.collect()) == sorted(grouped(rows))
    assert exact_dedup.deduplicate(no_docs).count() == 0
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_chunks_concatenate_to_the_text(edge):
    _, docs = edge
    d = docs.select(exact_dedup.normalised(docs.text).alias("norm"))
    for r in exact_dedup.with_chunks(d, "norm", "chunks").collect():
        assert "".join(r.chunks) == r.norm


def lines_by_hand(cut):
    """What stays of each (id, sha), from the chunks that the operator cut."""
    first, out = {}, {}
    docs = {(r.id, r.sha): [c.chunk for c in r.chunks or []] for r in cut.collect()}
    for key in sorted(docs, key=lambda k: (k[0] is None, k[0] or 0, k[1])):
        for pos, c in enumerate(docs[key]):
            if "\n" in c:
                first.setdefault(c, (key, pos))
    for key, chunks in docs.items():
        out[key[0], "\n".join(chunks)] = "\n".join(c for pos, c in enumerate(chunks) if "\n" not in c or first[c] == (key, pos))
    return out


@pytest.mark.parametrize("bits", [64, 1])
def test_repeated_line_chunks_go_but_for_the_first(spark, bits):
    block = "\n".join(f"shared line {k}" for k in range(30))
    rows = [(k, f"own {k}\n{block}\nend {k}") for k in range(5)]
    rows += [(9, block + "\n" + block), (10, None), (11, ""), (None, block), (12, "same\nsame\nsame"), (12, "same\nsame\nsame"), (13, "a single line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r[0]: r for r in rows}
    got = line_dedup.deduplicate_lines(docs, hash_bits=bits).collect()
    assert len(got) == len(rows)
    hand = lines_by_hand(line_dedup.line_chunks(docs, "doc_id", "text"))
    for r in got:
        text = texts[r.id][1]
        if text is None:
            assert r.clean_text is None and r.n_lines == 0 and r.removed_lines == 0
        else:
            assert r.clean_text == hand[r.id, text]
            assert r.n_lines == text.count("\n") + 1
    by = {r.id: r for r in got}
    assert by[0].removed_lines == 0 and by[13].removed_lines == 0
    assert all(by[k].removed_lines > 15 for k in (1, 2, 3, 4))


def lines_left(docs):
    """Brute force: what stays of each id when repeated pairs of lines and long lines go but for the first."""
    places, out = {}, {}
    for i in sorted(docs):
        x = docs[i].split("\n")
        for k, line in enumerate(x):
            if len(line.split(" ")) >= 50:
                places.setdefault(line, []).append((i, k))
            if k + 1 < len(x):
                places.setdefault((line, x[k + 1]), []).append((i, k))
    gone = {(i, k + j) for unit, at in places.items() for i, k in at[1:] for j in range(2 if isinstance(unit, tuple) else 1)}
    for i, text in docs.items():
        out[i] = [line for k, line in enumerate(text.split("\n")) if (i, k) not in gone]
    return out


@pytest.mark.parametrize("bits", [64, 3])
def test_passages_of_one_to_eight_lines_go_but_for_the_first(spark, bits):
    rng = random.Random(9)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    docs, planted = {}, {}
    for lines in range(1, 9):
        for k in range(6):
            passage = [line(60 if lines == 1 else 30) for _ in range(lines)]
            for copy in range(3):
                i = copy * 1000 + lines * 100 + k
                head, tail = ([line(12) for _ in range(rng.randrange(4))] for _ in range(2))
                docs[i], planted[i] = "\n".join(head + passage + tail), passage
    docs |= {4000: line(49), 4001: "a\nb\nc", 4002: "x\nb\nd", 4003: "", 4004: "one", 4005: "one", 4006: "r\nr\nr\nr", 4008: "\n\n"}
    docs |= {4007: docs[4000], 4009: "ab\nc", 4010: "a\nbc"}
    df = spark.createDataFrame([*docs.items(), (5000, None)], "doc_id long, text string").repartition(3)
    got = {r.id: r for r in line_dedup.deduplicate_lines(df, hash_bits=bits, passages=True).collect()}
    assert got[5000].clean_text is None and got[5000].n_lines == got[5000].removed_lines == 0
    left = lines_left(docs)
    for i, text in docs.items():
        assert got[i].clean_text == "\n".join(left[i]), i
        assert got[i].removed_lines == text.count("\n") + 1 - len(left[i])
    for i, passage in planted.items():
        kept = sum(x in passage for x in got[i].clean_text.split("\n"))
        assert kept == (len(passage) if i < 1000 else 0), i


@pytest.mark.parametrize("bits", [64, 2])
def test_lines_of_many_overlapping_passages_match_brute_force(spark, bits):
    rng = random.Random(14)
    long = " ".join(f"l{k}" for k in range(55))
    docs = {i: "\n".join(rng.choice(["a", "b", "c", "", long, f"own {i} {k}"]) for k in range(rng.randrange(12))) for i in range(60)}
    df = spark.createDataFrame([*docs.items(), (7, docs[7]), (7, docs[7])], "doc_id long, text string").repartition(4)
    left = lines_left(docs)
    got = line_dedup.deduplicate_lines(df, hash_bits=bits, passages=True).collect()
    assert len(got) == len(docs) + 2
    for r in got:
        assert (r.clean_text, r.n_lines) == ("\n".join(left[r.id]), docs[r.id].count("\n") + 1), r.id
        assert r.removed_lines == r.n_lines - len(left[r.id])


def test_repeated_passages_go_as_whole_chunks(spark, monkeypatch):
    """Passages between lines of their own are chunks; nothing smaller needs to be compared."""
    monkeypatch.setattr(line_dedup, "small_units", lambda chunks: chunks.select("id", "sha", "start", "lines", "unit").limit(0))
    passages = [[f"passage {p} line {k} " + "word " * 60 for k in range(p)] for p in range(1, 9)]
    docs = {100 * c + p: "\n".join([f"head {c} {p}", *passages[p - 1], f"tail {c} {p}"]) for p in range(1, 9) for c in range(3)}
    df = spark.createDataFrame([*docs.items()], "doc_id long, text string")
    for r in line_dedup.deduplicate_lines(df, passages=True).collect():
        assert r.removed_lines == (0 if r.id < 100 else r.id % 100), r.id


def brute(rows, size, percent):
    sets = {}
    for k, r in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", norm(r[1]))
        sets[k] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            ia, ib = rows[a][0], rows[b][0]
            if a < b and ia is not None and ib is not None and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(ia), find(ib)
                    parent[max(x, y)] = min(x, y)
    return sorted(((r[0], len(sets[k]), None if r[0] is None else find(r[0])) for k, r in enumerate(rows)), key=str)


def test_ngram_join_matches_brute_force(edge, no_docs, monkeypatch):
    rows, docs = edge
    # Small nodes and leaves: large buckets are split, and pairs go through the tree.
    monkeypatch.setattr(ngram_join, "NODE", 3)
    monkeypatch.setattr(ngram_join, "LEAF", 2)
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(docs, size=4, percent=85).collect()), key=str)
    assert got == brute(rows, 4, 85)
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_with_clashing_columns(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, 1, "a"), (2, text + " more", 2, "b"), (3, "something else", 3, None), (None, text, 4, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dropped int, component_id string")
    left = ngram_join.one_of_each_group(docs)
    assert left.columns == docs.columns and sorted(r.dropped for r in left.collect()) == [1, 3, 4]


def test_variants_below_the_threshold_are_not_paired_with_each_other(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "NODE", 16)
    words_ = [f"w{k}" for k in range(150)]
    texts = [" ".join(f"v{d}x{k}" if k in (10 + d, 55 + d, 140 - d) else w for k, w in enumerate(words_)) for d in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    checked, verified = [], ngram_join.verified

    def counted(docs, pairs, *rest):
        checked.append(pairs.count())
        return verified(docs, pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", counted)
    got = {(r.id, r.component_id) for r in ngram_join.near_duplicates(docs, size=5, percent=80).collect()}
    shingled = [{tuple(t.split()[k:k + 5]) for k in range(146)} for t in texts]
    linked = [(a, b) for a in range(40) for b in range(a) if 100 * len(shingled[a] & shingled[b]) >= 80 * len(shingled[a] | shingled[b])]
    component = list(range(40))
    for _ in component:
        for a, b in linked:
            component[a] = component[b] = min(component[a], component[b])
    assert got == set(enumerate(component))
    assert sum(checked) <= 80 + len(linked)  # narrow bitmaps leave 254


def test_a_dense_group_behind_outliers_is_not_linked_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", 16, raising=False)
    words_ = [f"w{k}" for k in range(150)]
    # Ten outliers with the smallest ids, below the threshold to all others; the rest differ from each other by two words.
    changed = [(10 + 3 * d, 45 + 3 * d, 80 + 3 * d, 115 + 3 * d) if d < 10 else (2 * d,) for d in range(60)]
    texts = [" ".join(f"v{d}x{k}" if k in changed[d] else w for k, w in enumerate(words_)) for d in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    links, verified = [], ngram_join.verified

    def counted(docs, pairs, *rest):
        out = verified(docs, pairs, *rest)
        links.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "verified", counted)
    got = {(r.id, r.component_id) for r in ngram_join.near_duplicates(docs, size=5, percent=80).collect()}
    assert got == {(d, d if d < 10 else 10) for d in range(60)}
    assert sum(links) <= 180  # every pair of the 50: 1,225


def bitmaps_of(spark, sets):
    rows = [(k, len(s), bytearray(ngram_join.bitmap(s).tobytes())) for k, s in enumerate(sets)]
    return spark.createDataFrame(rows, "id long, n long, bits binary")


def test_hot_component_of_a_key_is_not_compared_with_itself(spark, monkeypatch):
    """One key, one component of 300 near copies and 30 single sets, one of which is near the component."""
    monkeypatch.setattr(ngram_join, "NODE", 16)
    rng = np.random.default_rng(5)
    base = rng.integers(-2**62, 2**62, 100)
    sets = [np.unique(np.append(base, rng.integers(-2**62, 2**62, 2))) for _ in range(300)]
    sets += [np.unique(rng.integers(-2**62, 2**62, 100)) for _ in range(29)] + [np.unique(np.append(base, [k for k in range(3)]))]
    members = spark.createDataFrame([(7, 330, k, 0 if k < 300 else k) for k in range(330)], "key long, members long, id long, component long")
    found = {tuple(sorted(r)) for r in ngram_join.tree_pairs(members, bitmaps_of(spark, sets), 85).collect()}
    assert {b for _, b in found} == {329} and len(found) == 300


def test_tree_finds_links_that_stars_miss(spark):
    """Pairs inside buckets whose classes differ from the bucket's first one."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(-2**62, 2**62, 60)) for _ in range(20)]
    sets += [np.unique(np.concatenate([s[:57], rng.integers(-2**62, 2**62, 3)])) for s in sets]
    members = spark.createDataFrame([(7, 40, k, k) for k in range(len(sets))], "key long, members long, id long, component long")
    found = {tuple(sorted(r)) for r in ngram_join.tree_pairs(members, bitmaps_of(spark, sets), 85).collect()}
    for a in range(40):
        for b in range(a + 1, 40):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                assert (a, b) in found
    assert len(found) < 60  # of 780 pairs


def test_shingles_are_those_of_the_words():
    text = "Aa  bB\tcc\nDd ee\x0bff \x1cgg é É"
    w = re.findall(r"[^\x20\x09-\x0D]+", norm(text))
    for size in (1, 2, 4, 20):
        assert len(shingles(text, size)) == len({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))})
    assert (shingles("a b c d e", 4) == shingles("A  b\nC d E", 4)).all()


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(100, 400)]
    star = [(5, k) for k in range(1000, 1300)]
    links = spark.createDataFrame(path + star + [(7, 7)], "a long, b long").repartition(7)
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {k: 100 for k in range(101, 401)} | {k: 5 for k in range(1000, 1300)}
    assert components.components(links.limit(0)).count() == 0


def test_sets_that_meet_by_chance_send_no_bitmaps(spark, monkeypatch):
    """Documents of very different sizes, or with their one common passage late among their shingles, are told apart by their routes."""
    rng = np.random.default_rng(8)
    common = [f"c{k}" for k in range(40)]
    texts = [" ".join([*(f"d{d}x{k}" for k in range(60 + 40 * d)), *common]) for d in range(24)]
    near = [t.split() for t in texts[:4]]
    for w in near:
        w[int(rng.integers(5, 50))] = "other"
    texts += [" ".join(w) for w in near]
    sent, possible_pairs = [], ngram_join.possible_pairs

    def counted(pairs, sets, percent):
        sent.append(pairs.count())
        return possible_pairs(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "possible_pairs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(docs, size=4, percent=85).collect()), key=str)
    assert got == brute(list(enumerate(texts)), 4, 85)
    assert sorted((i, c) for i, _, c in got if i >= 24) == [(24 + k, k) for k in range(4)]
    assert sum(sent) <= 8  # 32 when bitmaps are sent for every pair


def test_routes_keep_every_link_whatever_shingles_count_as_frequent(spark, monkeypatch):
    """Of keys with the same members one stays, and it must be the first in the order that puts frequent shingles last."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{d}x{k}" for k in range(100 + d)) for d in range(30)]
    texts += [" ".join("other" if k == 20 + d else w for k, w in enumerate(t.split())) for d, t in enumerate(texts)]
    every = np.unique(np.concatenate([shingles(t, 4) for t in texts]))
    monkeypatch.setattr(ngram_join, "frequent_shingles", lambda *_: np.sort(rng.choice(every, len(every) // 2, replace=False)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(docs, size=4, percent=90).collect()), key=str)
    assert got == brute(list(enumerate(texts)), 4, 90)
    assert {i: c for i, _, c in got if i >= 30} == {30 + k: k for k in range(30)}


def test_stored_frames_leave_no_shuffle_files(spark):
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(name)
    out = stored(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert len(out.collect()) == 7 and spark.conf.get(name) == setting
    until = time.time() + 5
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
