import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators might use themselves.
    T.StructField("id", T.StringType()), T.StructField("row", T.StringType()), T.StructField("n", T.IntegerType())])


def sentence(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta omega Sigma tau rho phi chi psi eta".split()) + str(rng.randrange(60)) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies, near copies, shared passages."""
    rng = random.Random(5)
    base = [sentence(rng, 60) + ". " + sentence(rng, 40) + ".\n" + sentence(rng, 30) for _ in range(6)]
    passage = sentence(rng, 55)
    texts = [None, "", "   \n\t ", "one", "two words", "a b c", "Ünïcode İstanbul ΣΑΣ", "x" * 30_000, sentence(rng, 20_000), "A.b!C?\n\n..", "no-break\x1cbar"]
    texts += base + [b.upper() for b in base[:3]] + [base[0], base[0]]
    near = base[1].split(" ")
    for k in range(8):
        near = [*near]
        near[10 + k] = f"changed{k}"
        texts.append(" ".join(near))
    texts += [sentence(rng, 50) + " " + passage + " " + sentence(rng, 50) for _ in range(12)]
    rows = [(k, t, "en", f"src{k % 4}" if k % 7 else None, None if t is None else len(t), "x", None, 1) for k, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, base[2], None, None, None, None, None, None), (None, None, None, None, None, None, None, None),
             (10_000, base[4], "fr", "src1", 3, None, "r", None)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    rows = edge_rows()
    return rows, spark.createDataFrame(rows, DOCS).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
