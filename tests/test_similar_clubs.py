"""Similar club names against a comparison of all pairs."""

import random

from pyspark.sql import functions as F

from paysheaf.operators import similar_clubs as S


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
    return row[-1]


def digits(s):
    return "".join(c for c in s if c.isdigit())


def slips(rng, name):
    k = rng.randrange(len(name))
    c = rng.choice("abcdexyz")
    return rng.choice([name[:k] + name[k + 1:], name[:k] + c + name[k:], name[:k] + c + name[k + 1:]])


def names():
    rng = random.Random(12)
    clubs = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(4, 12))) + rng.choice(["", " city", " 1", " 22"]) for _ in range(60)]
    rows = [(c,) for c in clubs for _ in range(rng.randrange(3, 9))]
    rows += [(slips(rng, c),) for c in clubs for _ in range(3)]
    return rows + [(None,), ("",), ("...",), ("ab",), ("ac",), ("Club 1",), ("Club 2",), ("CLUB  1 FC",), ("Atlético",), ("Atletico",), ("Atletco",)]


def test_pairs_and_groups_match_all_pairs(spark):
    rows = names()
    df = spark.createDataFrame(rows, "club string")
    counts = {r.club_key: r.n for r in S.club_counts(df).collect()}
    near = {k: {o for o in counts if o != k and min(len(k), len(o)) >= 4 and digits(k) == digits(o) and distance(k, o) == 1} for k in counts}
    want = sorted((a, b, counts[a], counts[b]) for a in counts for b in near[a] if a < b)
    got = sorted(tuple(r) for r in S.dq_similar_clubs(df).collect())
    assert got == want and len(got) > 100

    def top(k):
        better = [o for o in near[k] if (-counts[o], o) < (-counts[k], k)]
        return top(min(better, key=lambda o: (-counts[o], o))) if better else k

    groups = {r.club_key: (r.n, r.group_key) for r in S.club_groups(df).collect()}
    assert groups == {k: (n, top(k)) for k, n in counts.items()}
    assert groups["atletco"][1] == "atletico" and groups["club 1"] == (2, "club 1") and groups["club 2"][1] == "club 2"


def test_no_clubs(spark):
    none = spark.createDataFrame([(None,)], "club string")
    assert S.dq_similar_clubs(none).collect() == [] and S.club_groups(none).collect() == []


def test_many_clubs_meet_in_small_buckets(spark):
    """Names that differ in all letters: as many forms as letters, and no bucket grows with the clubs."""
    df = spark.range(30_000).select(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 16).alias("club"))
    counts = S.club_counts(df)
    forms = counts.select(F.explode(S._forms(F.col("club_key"))).alias("form")).groupBy("form").count()
    assert forms.agg(F.max("count")).first()[0] <= 2
    assert S.dq_similar_clubs(df).count() == 0
