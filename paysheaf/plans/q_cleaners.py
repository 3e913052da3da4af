"""Cleaner queries (T1–T17) over the ``dirty_strings`` fixture and the club dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.clubs import ClubLookup, club_from_tokens, club_start
from ..sources.documents import line_tokens
from ..sources.fixtures import club_dim, dirty_strings, pay
from .catalog import query
from .oracle_fixtures import DIRTY_STRINGS, PAY, WS, with_

W = with_(DIRTY_STRINGS)
# ASCII whitespace the fixture uses (the oracle's trim set).
TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _ds(spark, sf):
    return dirty_strings(spark, sf)


@query("clean_money", W + f"""
SELECT id, CAST(CASE WHEN money_raw IS NULL OR money_raw = '' THEN NULL
  WHEN regexp_full_match(replace(replace(trim(money_raw, {TRIM}), '$', ''), ',', ''),
                         '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)\\s*')
  THEN TRY_CAST(trim(replace(replace(trim(money_raw, {TRIM}), '$', ''), ',', ''), {TRIM}) AS DECIMAL(18,2))
  END AS DOUBLE) AS money
FROM dirty_strings""")
def clean_money(spark, sf):
    """Money text -> number ('$' and ',' removed; NULL when not a plain number)."""
    return _ds(spark, sf).select("id", X.clean_money("money_raw").cast("double").alias("money"))


@query("clean_code", W + f"SELECT id, COALESCE(upper(trim(code_raw, {TRIM})), '') AS code FROM dirty_strings")
def clean_code(spark, sf):
    """Position code stripped and upper-cased."""
    return _ds(spark, sf).select("id", X.clean_code("code_raw").alias("code"))


@query("clean_name", W + f"""
SELECT id, COALESCE(trim(trim(trim(name_raw, {TRIM}), '"'), ''''), '') AS name FROM dirty_strings""")
def clean_name(spark, sf):
    """Name stripped of whitespace, then of double and single quotes."""
    return _ds(spark, sf).select("id", X.clean_name("name_raw").alias("name"))


@query("collapse_ws", W + f"""
SELECT id, COALESCE(trim(regexp_replace(text_raw, '{WS}+', ' ', 'g')), '') AS collapsed,
  NULLIF(trim(regexp_replace(code_raw, '{WS}+', ' ', 'g')), '') AS code_or_null
FROM dirty_strings""")
def collapse_ws(spark, sf):
    """T4/T5: whitespace runs collapsed; blank -> NULL variant."""
    d = _ds(spark, sf)
    return d.select("id", X.collapse_ws("text_raw").alias("collapsed"),
                    X.blank_to_null("code_raw").alias("code_or_null"))


@query("first_digits", W + "SELECT id, NULLIF(regexp_extract(jersey_raw, '(\\d+)', 1), '') AS jersey FROM dirty_strings")
def first_digits(spark, sf):
    """First digit run of a jersey text."""
    return _ds(spark, sf).select("id", X.first_digits("jersey_raw").alias("jersey"))


@query("normalize_key", W + f"""
SELECT id, regexp_replace(trim(regexp_replace(lower(text_raw), '[^\\w\\s]', '', 'g'), {TRIM}),
                          '\\s+', '_', 'g') AS key
FROM dirty_strings""")
def normalize_key(spark, sf):
    """Label -> snake-case key."""
    return _ds(spark, sf).select("id", X.normalize_key("text_raw").alias("key"))


@query("looks_like_code", W + f"""
SELECT id, COALESCE(regexp_full_match(replace(replace(trim(code_raw, {TRIM}), '-', ''), '/', ''),
                                      '\\p{{L}}{{1,4}}'), false) AS is_code
FROM dirty_strings""")
def looks_like_code(spark, sf):
    """One to four letters once '-' and '/' are removed."""
    return _ds(spark, sf).select("id", X.looks_like_code(X.strip("code_raw")).alias("is_code"))


_TOKS = f"list_filter(regexp_split_to_array(concat_ws(' ', text_raw, code_raw, money_raw, CAST(id AS VARCHAR)), '{WS}+'), lambda x: x <> '')"


@query("money_positions", W + f"""
SELECT id, array_to_string(list_filter(list_transform(range(len(t)), lambda i:
         CASE WHEN contains(t[i + 1], '$')
                OR regexp_full_match(replace(replace(t[i + 1], ',', ''), '.', ''), '[0-9]{{4,}}')
              THEN i END), lambda i: i IS NOT NULL), ',') AS positions
FROM (SELECT id, {_TOKS} AS t FROM dirty_strings) s""")
def money_positions(spark, sf):
    """Positions of money-looking tokens in a token row."""
    d = _ds(spark, sf)
    toks = line_tokens(F.concat_ws(" ", "text_raw", "code_raw", "money_raw", F.col("id").cast("string")))
    return d.select("id", F.array_join(X.money_positions(toks), ",").alias("positions"))


@query("prefer_nonblank", W + "SELECT id, COALESCE(NULLIF(code_raw, ''), name_raw) AS preferred FROM dirty_strings")
def prefer_nonblank(spark, sf):
    """First value unless blank, else the second."""
    return _ds(spark, sf).select("id", X.prefer_nonblank("code_raw", "name_raw").alias("preferred"))


_NAME_TOKS = f"list_filter(regexp_split_to_array(text_raw, '{WS}+'), lambda x: x <> '')"
_CLEAN = "COALESCE(trim(trim(trim({x}, " + TRIM + "), '\"'), ''''), '')"


@query("split_names", W + f"""
SELECT id,
  CASE WHEN len(t) <= 1 THEN '' WHEN id % 2 = 0 THEN {_CLEAN.format(x="array_to_string(t[2:], ' ')")}
       ELSE {_CLEAN.format(x="t[1]")} END AS first_name,
  CASE WHEN len(t) = 0 THEN '' WHEN len(t) = 1 THEN {_CLEAN.format(x="t[1]")}
       WHEN id % 2 = 0 THEN {_CLEAN.format(x="t[1]")}
       ELSE {_CLEAN.format(x="array_to_string(t[2:], ' ')")} END AS last_name
FROM (SELECT id, {_NAME_TOKS} AS t FROM dirty_strings) s""")
def split_names(spark, sf):
    """Name tokens -> (first, last) by header order (even ids: last name first)."""
    d = _ds(spark, sf)
    s = X.split_names(line_tokens(F.col("text_raw")), F.col("id") % 2 == 0)
    return d.select("id", s["first_name"].alias("first_name"), s["last_name"].alias("last_name"))


@query("longest_prefix_lookup", with_(PAY) + """
SELECT record_id, club,
  CAST(CASE WHEN record_id % 2 = 0 THEN 1 ELSE len(string_split(region, ' ')) + 1 END AS INTEGER) AS consumed,
  1 AS club_start
FROM pay""")
def longest_prefix_lookup(spark, sf):
    """Club from leading tokens (code or longest known name) and where a club
    starts after one name token."""
    lookup = ClubLookup.from_dim(club_dim(spark, sf))
    p = pay(spark, sf)
    club_text = F.when(F.col("record_id") % 2 == 0, F.concat(F.lit("N"), F.col("nk").cast("string"))) \
        .otherwise(F.concat_ws(" ", "region", "club"))
    toks = line_tokens(F.concat_ws(" ", club_text, F.col("last_name")))
    hit = club_from_tokens(toks, lookup)
    name_first = F.concat(F.array(F.col("last_name")), toks)
    return p.select("record_id", hit["club"].alias("club"), hit["consumed"].alias("consumed"),
                    club_start(name_first, lookup).alias("club_start"))


@query("club_join", with_(PAY) + """
SELECT record_id, club,
  CAST(CASE WHEN record_id % 2 = 0 THEN 1 ELSE len(string_split(region, ' ')) + 1 END AS INTEGER) AS consumed
FROM pay""")
def club_join(spark, sf):
    """The same lookup as joins on the dimension, for any number of clubs."""
    from ..operators.club_join import match_clubs
    p = pay(spark, sf)
    club_text = F.when(F.col("record_id") % 2 == 0, F.concat(F.lit("N"), F.col("nk").cast("string"))) \
        .otherwise(F.concat_ws(" ", "region", "club"))
    rows = p.select("record_id", line_tokens(F.concat_ws(" ", club_text, F.col("last_name"))).alias("tokens"))
    return match_clubs(rows, "tokens", club_dim(spark, sf)).select("record_id", "club", "consumed")
