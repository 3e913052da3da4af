"""Classifiers: held-out accuracy, edge rows, determinism."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysheaf.llm import licenses, quality, toxicity
from paysheaf.llm.queries import QUERIES
from paysheaf.llm.textfeat import char_ngrams



def test_toxicity_on_held_out_rows(spark):
    rows = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.94
    assert held[held.toxic == 0].predicted.mean() < 0.01


def test_toxicity_finds_most_of_the_held_out_toxic_rows(spark):
    rows = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out").toPandas()
    held = rows.merge(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas(), on="doc_id")
    assert held[held.toxic == 1].predicted.mean() > 0.8
    assert held[held.toxic == 0].predicted.mean() < 0.01


def test_word_ngrams_do_not_cross_words():
    one = char_ngrams("some, WORDS", (4, 5), 18, words=True)
    assert (one == char_ngrams("words--some", (4, 5), 18, words=True)).all() and len(char_ngrams(None, (4,), 18, words=True)) == 0
    assert len(one) == 3 + 2 + 4 + 3


def test_classifiers_on_edge_rows(spark, edge, no_docs):
    rows, docs = edge
    labels = spark.createDataFrame([(k, k % 2, None if k == 3 else k % 3 // 2) for k in range(30)] + [(None, 1, 1), (1, None, 1), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert sum(r.predicted == 0 for r in out) == toxicity.keep_clean(docs, model).count()
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    grades = quality.train(docs, labels, F.col("quality") * (2 - F.coalesce("toxic", F.lit(0))), 3)
    assert (np.diff(grades[1]) > 0).all()
    graded = quality.score(docs, grades).collect()
    assert len(graded) == len(rows) and all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in graded)
    # No labels at all: the prior, which calls nothing toxic.
    blank = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, blank).collect()} == {0}
    assert toxicity.score(no_docs, blank).count() == 0
    assert quality.score(no_docs, grades).count() == 0


def test_quality_separates_held_out_rows(spark):
    rows = QUERIES["op2_quality"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.selected == (held.quality == 1)).mean() > 0.94
    assert held[held.quality == 1].selected.mean() > 0.98


def test_features_of_long_texts_cover_every_block(monkeypatch):
    text = "".join(chr(97 + (k * k) % 26) for k in range(5000)) + "needle"
    whole = char_ngrams(text, (4,), 18)
    monkeypatch.setattr("paysheaf.llm.textfeat.BLOCK", 100)
    assert (char_ngrams(text, (4,), 18) == whole).all()


@pytest.fixture(scope="module")
def licence_rows(spark):
    clean = [(k, f"plain words number{k} about nothing\nmore words {k}") for k in range(60)]
    marked = [(100, "intro words here\nReleased under the MIT License.\nmore"), (101, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0."),
              (102, "x y z " * 500 + "this work is licensed under the GNU General Public License, version 3."), (103, "Licensed under CC BY-NC 4.0."),
              (104, "Your driving licence is free of charge."), (105, None), (106, ""), (None, "Released under the MIT License.")]
    return spark.createDataFrame(clean + marked + [marked[0]], "doc_id long, text string")


def test_licences_are_found_and_confirmed(licence_rows, no_docs):
    got = {}
    for r in licenses.document_licences(licence_rows).collect():
        got[r.id] = r.licences
    assert got[100] == "mit" and got[101] == "apache-2.0" and got[102] == "gpl-3.0" and got[103] == "cc-by-nc-4.0" and got[None] == "mit"
    assert not any(got[k] for k in (104, 105, 106, *range(60)))
    assert licenses.document_licences(no_docs).count() == 0


def test_near_licence_families_are_told_apart(spark):
    """Neighbours by version, Lesser, NC and SA; a wrapped header; versions and variants that have no notice."""
    gpl = "licensed under the GNU General Public License, version "
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    header = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
              "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n")
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that"
    want = [("This work is " + gpl + "2.", "gpl-2.0"), ("This work is " + gpl + "3.", "gpl-3.0"),
            ("This work is licensed under the GNU Lesser General Public License, version 3.", "lgpl-3.0"),
            (cc.format(""), "cc-by-4.0"), (cc.format("-ShareAlike"), "cc-by-sa-4.0"), (cc.format("-NonCommercial"), "cc-by-nc-4.0"),
            (cc.format("-NonCommercial-ShareAlike"), ""), (header, "gpl-3.0"), (header.replace("General", "Lesser General"), "lgpl-3.0"), (isc, "isc"),
            ("Licensed under the Apache License, Version 1.1.", ""), ("Licensed under the Apache License, Version 2.0.", "apache-2.0")]
    clean = [(1000 + k, f"plain words number{k} about nothing\nmore words {k} of a longer line that says little") for k in range(200)]
    docs = spark.createDataFrame([(k, "some words\n\n" + t + "\n\nother words here") for k, (t, _) in enumerate(want)] + clean, "doc_id long, text string")
    got = {r.id: r.licences for r in licenses.document_licences(docs).collect()}
    assert [got[k] for k in range(len(want))] == [f for _, f in want]
    assert not any(got[k] for k in got if k >= 1000)


def test_licence_plan_is_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = licenses.vectors(licenses.paragraphs(docs, "doc_id", "text"))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
