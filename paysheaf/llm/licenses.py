"""Licence scans: a trained paragraph classifier over sparse word n-grams (DataFrame functions and MLlib only).

A paragraph is one line. Its words and word pairs are hashed into sparse vectors, and a multinomial
logistic regression with an L1 penalty gives the probability of every licence family and of the class
unknown. Only words and pairs of the sentences below count: for others the penalty leaves next to no weight
(on sf0.1, 25 small ones for the class unknown among 8,192 features), and without them paragraphs are cheap to hash and many are
equal; those are learnt from as one row with the sum of their weights. The model learns the families from word windows of the notices below, and unknown from all
paragraphs of the corpus that share no word triple with a notice, besides a few sentences
about other licences. The paragraphs together weigh no more than ``UNKNOWN_WEIGHT`` windows, so that a large corpus does
not drown the families. A third of the unknown paragraphs is kept out of training: the probability that a
paragraph is any licence must exceed all but one in a thousand of theirs (and 0.5) to count. Such a paragraph is
then compared, together with the ``AROUND`` lines before and after it (notices are often wrapped), with the notices of all
families. A notice fits if the text holds at least ``CONTAINED`` of its word triples and all its telling ones: those with
a number, and those that a notice of another family like it (half its triples or more) does not hold. The fitting notice
with most triples found gives the family, confirmed; where none fits, the model's family stays, unconfirmed.

Defined results: null and empty texts have no licences; a null id is a row like others; repeated rows each
get their result; paragraphs of any length are scanned whole; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from ..operators.quantiles import exact_quantiles
from .common import stored

FEATURES = 1 << 13
UNKNOWN_WEIGHT = 3000.0
CONTAINED = 0.6
#: Lines before and after a paragraph that may hold the rest of its notice.
AROUND = 3
#: Words of a short window of a notice, as a wrapped line holds them.
WRAPPED = 9

# Short notices of licence families, as their publishers word them.
NOTICES = [
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
OTHER = [
    "Your driving licence must be renewed every ten years.",
    "The software is sold under a commercial agreement and all rights are reserved.",
    "He worked at the institute and released a new version of the file.",
    "This work is part of a larger project and the terms are under discussion.",
    "A general public hearing was held, free of charge, to any person in the city.",
]
FAMILIES = sorted({f for f, _ in NOTICES})


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def joined(words: str, n: int) -> Column:
    """Runs of n words; the words, however they come about, are computed once and not for every run."""
    return let(F.col(words), lambda w: F.when(F.size(w) < n, F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))))


def pairs_and_words(words: str) -> Column:
    return let(F.col(words), lambda w: F.concat(w, F.transform(
        F.arrays_zip(w.alias("a"), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))).alias("b")), lambda p: F.concat_ws(" ", p["a"], p["b"]))))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, line, paragraph and around (the line and its neighbours) of each line."""
    lines = F.split("text", "\n", -1)
    each = F.transform(F.col("lines"), lambda x, i: F.struct(i.alias("line"), x.alias("paragraph"), F.array_join(
        F.slice("lines", F.greatest(i + (1 - AROUND), F.lit(1)), F.least(i, F.lit(AROUND)) + (1 + AROUND)), " ").alias("around")))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    return d.select("id", lines.alias("lines")).select("id", F.inline_outer(each))  # inline would make the rows in a filter, too


def notices(spark: SparkSession) -> DataFrame:
    n = spark.createDataFrame([(FAMILIES.index(f) + 1, t) for f, t in NOTICES], "label int, notice string")
    n = n.select("label", words_of(F.col("notice")).alias("words"))
    return n.select("label", "words", joined("words", 3).alias("triples"))


def others(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in OTHER], "t string").select(F.lit(0).alias("label"), words_of(F.col("t")).alias("words"))


def with_terms(df: DataFrame, words: Column) -> DataFrame:
    """Add terms (the distinct words and word pairs that the notices and other sentences hold, too, sorted), noticed (whether a
    word triple of a notice is among the words) and mark (a hash of all words)."""
    spark = df.sparkSession
    triples = sorted({t for r in notices(spark).collect() for t in r["triples"]})
    sentences = [r["words"] for r in notices(spark).select("words").union(others(spark).select("words")).collect()]
    single, pairs = {w for s in sentences for w in s}, {p for s in sentences for p in zip(s, s[1:])}
    first, second = ({p[k] for p in pairs} for k in (0, 1))
    # Pairs and triples are spelled out only where words of known pairs meet.
    meet = lambda w: F.filter(F.sequence(F.lit(0), F.size(w)), lambda i: F.get(w, i).isin(*sorted(first)) & F.get(w, i + 1).isin(*sorted(second)))
    runs = lambda w, at, n: F.transform(at, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))
    among = lambda xs, known: F.filter(xs, lambda x: x.isin(*sorted(known)))
    found = let(words, lambda w: let(meet(w), lambda at: F.struct(
        F.sort_array(F.array_distinct(F.concat(among(w, single), among(runs(w, at, 2), {" ".join(p) for p in pairs})))).alias("terms"),
        F.exists(runs(w, at, 3), lambda x: x.isin(*triples)).alias("noticed"), F.xxhash64(w).alias("mark"))))
    # A generator's rows: a filter on them is not pushed below it, where all would be done twice.
    return df.select("*", F.inline_outer(F.array(found)))


def training_rows(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """label (0 unknown), terms, kept_out, corpus (whether the row is a paragraph of the corpus)."""
    n = notices(spark)
    # Windows of three quarters of a notice or more, so that a notice that is cut or continued is known too.
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.floor(F.size("words") / 4).cast("int"), F.lit(1)))).alias("start")
    spans = n.select("label", "words", start).select("label", "words", "start", F.explode(F.sequence(
        F.ceil(F.size("words") * 0.75).cast("int"), F.size("words"))).alias("n"))
    spans = spans.select("label", F.slice("words", F.col("start"), F.col("n")).alias("words"), F.lit(False).alias("kept_out"))
    # Long notices also as the lines that wrapping leaves of them.
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - (WRAPPED - 1), F.lit(3))).alias("start")
    wrapped = n.filter(F.size("words") >= 2 * WRAPPED).select("label", "words", cut)
    spans = spans.union(wrapped.select("label", F.slice("words", F.col("start"), F.lit(WRAPPED)), F.lit(False)))
    spans = spans.union(others(spark).withColumn("kept_out", F.lit(False)))
    known = with_terms(spans, F.col("words")).select("label", "terms", "kept_out", F.lit(False).alias("corpus"))
    unknown = (with_terms(lines.select("paragraph"), words_of(F.col("paragraph"))).filter("not noticed")
               .select(F.lit(0).alias("label"), "terms", (F.pmod("mark", F.lit(3)) == 0).alias("kept_out"), F.lit(True).alias("corpus")))
    return known.union(unknown)


def weighted(data: DataFrame) -> DataFrame:
    """Rows to learn from, with their weight: paragraphs of the corpus weigh ``UNKNOWN_WEIGHT`` together, or 1 each if fewer."""
    n = data.filter("corpus").count()
    weight = F.when(F.col("corpus"), F.lit(min(1.0, UNKNOWN_WEIGHT / max(n, 1)))).otherwise(F.lit(1.0))
    return data.filter("not kept_out").withColumn("weight", weight)


def merged(data: DataFrame) -> DataFrame:
    """Rows of one label with equal terms as one, with the sum of their weights: to the regression they are the same."""
    return data.groupBy("label", "terms").agg(F.sum("weight").alias("weight"))


def vectors(df: DataFrame) -> DataFrame:
    terms = df if "terms" in df.columns else with_terms(df, words_of(F.col("paragraph"))).drop("paragraph", "noticed", "mark")
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="terms", outputCol="features").transform(terms).drop("terms")


def licence_probability() -> Column:
    return 1 - F.get(vector_to_array("probability"), F.lit(0))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[LogisticRegressionModel, float]:
    """The model, and the probability from which a paragraph counts as a licence."""
    data = stored(training_rows(docs.sparkSession, paragraphs(docs, id_col, text_col)), "training")
    data = data.withColumn("label", F.col("label").cast("double"))
    learn = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=3e-4, maxIter=40, weightCol="weight")
    model = learn.fit(vectors(stored(merged(weighted(data)), "merged")))
    out = model.transform(vectors(data.filter("kept_out and label = 0"))).select(licence_probability().alias("p"))
    high = exact_quantiles(stored(out, "kept_out"), "p", [0.999]).first()
    return model, max(0.5, high["value"] if high else 0.0)


def templates(spark: SparkSession) -> list[tuple[str, list[str], list[str]]]:
    """(family, triples, telling triples) of each notice."""
    known = [(FAMILIES[r["label"] - 1], list(dict.fromkeys(r["triples"]))) for r in notices(spark).collect()]
    out = []
    for family, own in known:
        like = [set(other) for name, other in known if name != family and 2 * len(set(own) & set(other)) >= len(own)]
        out.append((family, own, [t for t in own if any(w.isdigit() for w in t.split()) or any(t not in x for x in like)]))
    return out


def best_template(spark: SparkSession, own: Column) -> Column:
    """Struct of matched (triples), family and share of the fitting notice with most triples found; null if none fits."""
    fits = []
    for family, triples, telling in templates(spark):
        every, needed = (F.array(*[F.lit(t) for t in ts]).cast("array<string>") for ts in (triples, telling))
        matched = F.size(F.array_intersect(every, own))
        one = F.struct(matched.alias("matched"), F.lit(family).alias("family"), (matched / len(triples)).alias("share"))
        fits.append(F.when((matched >= CONTAINED * len(triples)) & (F.size(F.array_except(needed, own)) == 0), one))
    return F.array_max(F.array_compact(F.array(*fits)))


def scan(docs: DataFrame, model: LogisticRegressionModel, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, line, family, probability, contained (share of the fitting notice's word triples, else 0), confirmed."""
    found = model.transform(vectors(paragraphs(docs, id_col, text_col)))
    found = found.select("id", "line", "around", F.col("prediction").cast("int").alias("label"), licence_probability().alias("probability"))
    # The families' own ranking decides when the paragraph as a whole counts as a licence.
    found = found.filter((F.col("probability") > threshold) & (F.col("label") > 0))
    found = found.withColumn("words", words_of(F.col("around"))).withColumn("own", joined("words", 3))
    found = found.withColumn("best", best_template(docs.sparkSession, F.col("own")))
    names = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.col("label"))
    return found.select("id", "line", F.coalesce("best.family", names).alias("family"), "probability",
                        F.coalesce("best.share", F.lit(0.0)).alias("contained"), F.col("best").isNotNull().alias("confirmed"))


def document_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document id: id, licences (confirmed families, sorted, joined by commas), confirmed and
    unconfirmed (paragraphs)."""
    model, threshold = train(docs, id_col, text_col)
    found = scan(docs, model, threshold, id_col, text_col)
    per = found.groupBy("id").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("licences"),
        F.count_if("confirmed").alias("confirmed"), F.count_if(~F.col("confirmed")).alias("unconfirmed"))
    per = stored(per, "licences").alias("p")
    ids = docs.select(F.col(id_col).alias("id")).alias("d")
    out = ids.join(per, F.col("d.id").eqNullSafe(F.col("p.id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select("d.id", F.coalesce("licences", F.lit("")).alias("licences"), zero(F.col("confirmed")).alias("confirmed"),
                      zero(F.col("unconfirmed")).alias("unconfirmed"))
