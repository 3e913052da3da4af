"""The licence model learns from every paragraph of the corpus."""

import re

from pyspark.sql import functions as F

from paysheaf.llm import licenses


def test_every_paragraph_is_learnt_from(spark):
    docs = spark.range(35).select(F.col("id").alias("doc_id"), F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(100)), lambda i: F.concat(F.lit("row "), i, F.lit(" of "), F.col("id"))), "\n").alias("text"))
    data = licenses.training_rows(spark, licenses.paragraphs(docs, "doc_id", "text")).cache()
    assert data.filter("corpus").count() == 3500
    used = licenses.weighted(data).filter("corpus").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).first()
    assert used.n == data.filter("corpus and not kept_out").count() > 2000
    assert abs(used.w - licenses.UNKNOWN_WEIGHT * used.n / 3500) < 1e-6


def test_words_are_computed_once_for_all_their_runs(spark):
    lines = spark.createDataFrame([("One two, three four",), ("a b",)], "t string").select(licenses.words_of(F.col("t")).alias("words"))
    for runs, found in ((licenses.joined("words", 3), [["one two three", "two three four"], []]),
                        (licenses.pairs_and_words("words"), [["one", "two", "three", "four", "one two", "two three", "three four", "four"], ["a", "b", "a b", "b"]])):
        df = lines.select(runs.alias("runs"))
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
        assert [r.runs for r in df.collect()] == found


def test_terms_are_the_known_words_and_pairs_of_a_line(spark):
    lines = ["This work IS licensed under the GNU General Public License, version 3.", "plain prose of the town", "", " .,; ", "of", "version 3 of the of the",
             "either version 2.1 of the License, or (at your option)", "naïve of  the\tLicense", "the GNU General"]
    sentences = [[w for w in re.split(r"[\W_]+", t.lower()) if w] for t in [*(t for _, t in licenses.NOTICES), *licenses.OTHER]]
    notices = sentences[:len(licenses.NOTICES)]
    known = {w for s in sentences for w in s} | {f"{a} {b}" for s in sentences for a, b in zip(s, s[1:])}
    triples = {tuple(s[k:k + 3]) for s in notices for k in range(len(s) - 2)}
    df = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "k int, t string")
    got = {r.k: r for r in licenses.with_terms(df, licenses.words_of(F.col("t"))).withColumn("want", F.xxhash64(licenses.words_of(F.col("t")))).collect()}
    for k, t in enumerate(lines):
        w = [x for x in re.split(r"[\W_]+", t.lower()) if x]
        assert got[k].terms == sorted(known & ({*w} | {f"{a} {b}" for a, b in zip(w, w[1:])}))
        assert got[k].noticed == any(tuple(w[j:j + 3]) in triples for j in range(len(w) - 2))
        assert got[k].mark == got[k].want


def test_equal_paragraphs_are_learnt_from_as_one_row_of_their_weight(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("prose "), "id", F.lit("\nthe end of "), "id").alias("text"))
    data = licenses.weighted(licenses.training_rows(spark, licenses.paragraphs(docs, "doc_id", "text")).cache())
    rows = licenses.merged(data).filter("label = 0").collect()
    assert {tuple(r.terms) for r in rows} >= {(), ("of", "the")}
    used = {(): "corpus and size(terms) = 0", ("of", "the"): "corpus and terms = array('of', 'the')"}
    for r in rows:
        if tuple(r.terms) in used:
            assert abs(r.weight - data.filter(used[tuple(r.terms)]).count()) < 1e-9 and r.weight > 20
    assert abs(sum(r.weight for r in rows) - data.filter("label = 0").agg(F.sum("weight")).first()[0]) < 1e-6
    plan = licenses.vectors(licenses.merged(data))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
