"""Text-document queries over the given ``documents`` table (whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import documents as D
from ..session import spread
from ..sources.tables import read_table
from .catalog import query
from .oracle_fixtures import WS

_TOKENS = "list_filter(regexp_split_to_array(@X@, '" + WS + "+'), lambda t: t <> '')"


@query("line_tokens", f"""
SELECT doc_id, row_no, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM (SELECT doc_id, row_no, {_TOKENS.replace('@X@', 'line')} AS toks
      FROM (SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS row_no, unnest(l) AS line
            FROM (SELECT doc_id, string_split_regex(text, '\\r?\\n') AS l FROM documents) a) b) c""")
def line_tokens(spark, sf):
    """Every line of every document -> whitespace tokens."""
    docs = spread(read_table(spark, sf, "documents", "doc_id", "text"))
    lines = D.text_lines(docs, "text", keep=("doc_id",))
    toks = D.line_tokens(F.col("line"))
    return lines.select("doc_id", F.col("row_no").cast("bigint").alias("row_no"),
                        F.size(toks).cast("bigint").alias("n_tokens"),
                        F.array_join(toks, " ").alias("tokens"))


@query("text_fragmentation", f"""
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
  CASE WHEN len(toks[1:50]) = 0 THEN NULL
       ELSE CAST(len(list_filter(toks[1:50], lambda t: length(t) <= 2)) AS DOUBLE) / len(toks[1:50]) END
    AS short_share,
  COALESCE(len(toks) >= 10 AND CAST(len(list_filter(toks[1:50], lambda t: length(t) <= 2)) AS DOUBLE)
           / NULLIF(len(toks[1:50]), 0) > 0.4, false) AS fragmented
FROM (SELECT doc_id, {_TOKENS.replace('@X@', 'text')} AS toks FROM documents) d""")
def text_fragmentation(spark, sf):
    """Share of very short tokens among the first 50 of each whole document."""
    docs = spread(read_table(spark, sf, "documents", "doc_id", "text"))
    toks = D.line_tokens(F.col("text"))
    frag = D.fragmentation(toks)
    return docs.select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"),
                       frag["short_share"].alias("short_share"), frag["fragmented"].alias("fragmented"))
