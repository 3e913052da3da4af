"""The corpus pipeline: documents pass through the stages in order, each on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paysheaf.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from paysheaf.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic (score of 0.5 or more) go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased), the one with the largest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 or more of their five-word shingles, the one with the smallest id stays."""
    return ngram_join.one_of_each_group(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by code point weigh 5, 2, 1, repeating; a document is there once for each pass that takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and the digest of what the ids decode to, for each row."""
    import public_tokenizers

    return bpe.encoded_documents(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("source mix", mix_sources),
    ("BPE", encode),
]

#: The stages train and apply a model and encode texts, which SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
