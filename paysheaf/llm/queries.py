"""Queries of the corpus operators: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, lexical, licenses, line_dedup, mixing, mtree, ngram_join, quality, sharding, simhash, toxicity, trie
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 low quality, 1 good but toxic, 2 good; selected: grade 1 or more is likely."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))
    return quality.score(docs, quality.train(docs, labels, grade, grades=3))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licences(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)
    return found.withColumnRenamed("id", "doc_id")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicate_lines(table(spark, sf_dir, "documents"), passages=True)
    return out.select(F.col("id").alias("doc_id"), "n_lines", "removed_lines", F.sha2("clean_text", 256).alias("clean_sha256"),
                      F.length("clean_text").cast("long").alias("clean_chars"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, bits=3)
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_quality, op3_source_mix, op4_licences, op5_ngram_jaccard, op6_exact_topk, op7_bpe, op8_shards, op9_line_dedup, op10_exact_dedup, op11_simhash, op12_ranked_search, op13_prefix_trie)}

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op5_ngram_jaccard": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda t: t <> '') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0) t),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.k >= 85 * (x.n + y.n - p.k)),
        ends AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, ends.b FROM r JOIN ends ON r.reach = ends.a)
        SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.reach) AS component_id
        FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op6_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
            SELECT q.vec_id AS query_id, x.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * x.c[i])) AS BIGINT) AS score
            FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, rank, vec_id, score FROM (
            SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM p) t WHERE rank <= 20""",
    "op12_ranked_search": f"""
        WITH d AS (SELECT doc_id, {_TERMS} AS t, row_number() OVER () AS r FROM documents),
        p AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d WHERE len(t) > 0),
        f AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM p GROUP BY r, term),
        g AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS words FROM d WHERE len(t) > 0),
        w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term),
        q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) b),
        s AS (
            SELECT q.item_id, f.r, f.doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words))))) AS BIGINT) AS score
            FROM q JOIN f USING (term) JOIN w USING (term), g GROUP BY q.item_id, f.r, f.doc_id)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
            FROM s WHERE score > 0) t WHERE rank <= 50""",
    "op13_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
                   {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT c, list(x ORDER BY pos) AS seq FROM t GROUP BY c),
        h AS (
            SELECT c, seq, c - c % 20 AS donor,
                   xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
                       lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, k: xor(r >> 1, (r & 1) * 3988292384)), 4294967295::BIGINT),
                       4294967295::BIGINT) % 4 AS h
            FROM own),
        r AS (SELECT h.c, coalesce(d.seq, [])[1:h.h] || h.seq[h.h + 1:] AS seq FROM h LEFT JOIN own d ON d.c = h.donor),
        p AS (SELECT c, d, seq[1:d] AS prefix, d = len(seq) AS ends FROM (SELECT c, seq, unnest(range(0, len(seq) + 1)) AS d FROM r) u),
        n AS (
            SELECT prefix, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
                   CASE WHEN any_value(d) = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(any_value(prefix[-1].text), '[^\x20\x09-\x0D]+')) END AS saved
            FROM p GROUP BY prefix),
        k AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
        v AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (prefix)),
        a AS (SELECT unnest(range(0, depth + 1)) AS d, v.prefix, v.n_children, v.saved FROM v),
        s AS (SELECT prefix[1:d] AS prefix, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM a GROUP BY 1)
        SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
        FROM v JOIN s USING (prefix) LEFT JOIN v q ON v.depth > 0 AND q.prefix = v.prefix[1:v.depth - 1]""",
    "op10_exact_dedup": f"""
        WITH d AS (
            SELECT doc_id, {_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
}
