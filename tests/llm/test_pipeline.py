"""The pipeline, stage by stage and as a whole, against brute force on its own input."""

import os
import string

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from paysheaf.llm import toxicity

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "source mix", "BPE"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def small_corpus(spark, edge, tmp_path_factory):
    """The edge rows with toxic texts and labels."""
    rows, docs = edge
    folder = str(tmp_path_factory.mktemp("corpus"))
    extra = [(500 + k, f"calm words number{k} in a row of calm words {k}" + (" you stupid idiot moron" if k % 2 else ""), "en", "src9", 1, "x", None, k)
             for k in range(60)]
    docs.union(spark.createDataFrame(extra, docs.schema)).write.parquet(os.path.join(folder, "documents.parquet"))
    labels = [(500 + k, 1, k % 2) for k in range(60)] + [(k, 1, 0) for k in range(11, 20)] + [(None, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(folder, "labels.parquet"))
    return folder


def test_every_stage_works_on_what_its_predecessor_kept(spark, small_corpus):
    docs = spark.read.parquet(f"{small_corpus}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{small_corpus}/labels.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, small_corpus), "stage")
        kept[name] = (docs.toPandas(), out.toPandas())
        if name != "BPE":
            assert out.columns == docs.columns
        docs = out

    before, after = kept["toxicity"]
    scores = toxicity.score(spark.read.parquet(f"{small_corpus}/documents.parquet"), model).toPandas()
    assert len(after) == (scores.predicted == 0).sum()
    assert not after[after.doc_id.between(500, 559) & (after.doc_id % 2 == 1)].shape[0]
    assert after[after.doc_id.between(500, 559) & (after.doc_id % 2 == 0)].shape[0] == 30

    before, after = kept["exact dedup"]
    texts = before.text.fillna("").map(lambda t: t.translate(LOW))
    assert sorted(after.text.fillna("").map(lambda t: t.translate(LOW))) == sorted(set(texts))

    before, after = kept["n-gram Jaccard join"]
    from test_dedup_ops import brute
    rows = [(None if np.isnan(i) else int(i), t) for i, t in zip(before.doc_id, before.text)]
    stay = sorted(str(r[0]) for r in brute(rows, 5, 80) if r[0] is None or r[0] == r[2])
    assert sorted("None" if np.isnan(i) else str(int(i)) for i in after.doc_id) == stay

    before, after = kept["source mix"]
    assert after.groupby(after.doc_id.fillna(-1)).size().max() <= 3 * before.groupby(before.doc_id.fillna(-1)).size().max()
    assert set(after.doc_id.fillna(-1)) <= set(before.doc_id.fillna(-1))

    before, after = kept["BPE"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(str(library.encode(t or "", add_special_tokens=False).ids) for t in before.text)
    assert sorted(str(list(map(int, i))) for i in after.ids) == want
    assert (after.n_tokens == after.ids.map(len)).all()
    whole = corpus_pipeline.run(spark, small_corpus).toPandas()
    assert sorted(str(list(map(int, i))) for i in whole.ids) == want


def test_an_empty_corpus_passes_through(spark, edge, tmp_path):
    _, docs = edge
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
