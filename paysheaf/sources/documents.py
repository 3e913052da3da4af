"""Documents -> ordered rows of tokens or cells (the ``raw_rows`` shape).

* ``read_text_files``: whole files through ``binaryFile``, decoded as UTF-8, or as
  Latin-1 for the whole file when its bytes are not valid UTF-8.
* ``text_lines``: text -> one row per line with its 0-based position (``row_no``).
* ``line_tokens``: whitespace tokens of a line (an empty line gives no token).
* ``csv_cells``: cells of one CSV line (comma separated, double-quoted cells may hold
  commas and doubled quotes), each cell stripped.
* ``fragmentation``: share of very short tokens among the first 50 — flags text whose
  words were broken apart by a bad extraction.

All of it is column expressions; lines are exploded per document with ``posexplode``,
so a long document is split across the rows of its partition, not a Python loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WS_RUN, strip

# One CSV field: quoted (only when the quote is its first character; text after the closing
# quote belongs to it; without a closing quote it runs to the end) or an unquoted run.
# Possessive runs keep the match free of recursion, whatever a cell's length.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_CSV_FIELD = ",(" + _QUOTED + r'(?:"[^,]*+|\z)|[^,]*+)'
# A record of a whole file: fields up to a line end that is in no quoted field.
_FIELD_IN_FILE = "(?:" + _QUOTED + r'(?:"[^,\r\n]*+|\z)|[^,\r\n]*+)'
_CSV_RECORD = "(" + _FIELD_IN_FILE + "(?:," + _FIELD_IN_FILE + r")*+)(?:\r\n|\r|\n|\z)"

# Fragmentation test (fixed values): tokens looked at, short-token length, share, minimum.
FRAG_WINDOW = 50
FRAG_SHORT_LEN = 2
FRAG_SHARE = 0.4
FRAG_MIN_TOKENS = 10


def read_text_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, text): one row per file; Latin-1 fallback decided per whole file."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(path).select("path", "content")
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")),
                  F.decode("content", "UTF-8")).otherwise(F.decode("content", "ISO-8859-1"))
    return raw.select("path", text.alias("text"))


def text_lines(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line: ``keep`` columns, ``row_no`` (0-based), ``line``."""
    return df.select(*keep, F.posexplode(F.split(F.col(text_col), r"\r?\n")).alias("row_no", "line"))


def line_tokens(line: Column) -> Column:
    """Whitespace tokens of a line, empty tokens dropped."""
    return F.filter(F.split(line, WS_RUN), lambda t: t != "")


def _cell(c: Column) -> Column:
    """Unquote a field that starts with a quote ("" inside stands for one quote, text after
    the closing quote is kept), then strip it."""
    inner = F.replace(F.regexp_extract(c, "^\"([^\"]*+(?:\"\"[^\"]*+)*+)", 1), F.lit('""'), F.lit('"'))
    tail = F.regexp_extract(c, "(?s)^" + _QUOTED + '"(.*)$', 1)
    return strip(F.when(F.startswith(c, F.lit('"')), F.concat(inner, tail)).otherwise(c))


def csv_cells(line: Column) -> Column:
    """Cells of one CSV record, unquoted and stripped. An empty line gives no cell."""
    return F.when(line == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CSV_FIELD), 1), _cell))


def csv_records(files: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """One row per CSV record of each file: ``keep`` columns, ``row_no`` (0-based), ``cells``. A quoted
    cell may hold line ends; empty lines give a row without cells."""
    text = F.col(text_col)
    records = F.regexp_extract_all(text, F.lit(_CSV_RECORD), 1)
    # The match at the very end is empty: behind a last line end it is no record.
    closed = F.slice(records, 1, F.greatest(F.size(records) - 1, F.lit(0)))
    rows = files.select(*keep, F.posexplode_outer(closed).alias("row_no", "record")).filter(F.col("record").isNotNull())
    return rows.select(*keep, "row_no", csv_cells(F.col("record")).alias("cells"))


def fragmentation(tokens: Column) -> Column:
    """struct(short_share, fragmented): share of tokens of length <= 2 among the first 50;
    fragmented when the whole list has at least 10 tokens and that share is above 0.4."""
    head = F.slice(tokens, 1, FRAG_WINDOW)
    n = F.size(head)
    short = F.size(F.filter(head, lambda t: F.length(t) <= FRAG_SHORT_LEN))
    share = F.try_divide(short.cast("double"), n)
    return F.struct(share.alias("short_share"),
                    (F.coalesce(share > F.lit(FRAG_SHARE), F.lit(False))
                     & (F.size(tokens) >= FRAG_MIN_TOKENS)).alias("fragmented"))
