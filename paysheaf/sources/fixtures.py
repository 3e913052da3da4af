"""Adapters that derive payroll-shaped data from the given tables.

Every adapter is a Spark job over the given tables, so its size grows with them.
``pay`` is the salary-record fixture: one record per order, club = the customer's
nation, last name = the customer's name. Values that must match the DuckDB oracle
text (``plans/oracle_fixtures.py``) are computed with the same arithmetic.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY
from ..session import cut_lineage, deal
from .tables import read_table

def _money(c: Column) -> Column:
    return c.cast(MONEY)


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region: (n_nationkey, n_name, r_name).

    No hint: both are plain Parquet scans whose size Spark knows from the files, so the
    planner broadcasts them under ``spark.sql.autoBroadcastJoinThreshold`` and falls back
    to a shuffle join above it — the size check without an extra job."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return geo.select("n_nationkey", "n_name", "r_name")


def pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary records: year, club, last_name, first_name, position, base_salary,
    guaranteed_comp (+ record_id, region, nk).

    orders ⋈ customer is the one large join (shuffle/sort-merge at scale, AQE may
    switch it); the geography side is broadcast by size (see ``geography``).
    """
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice",
                        "o_orderdate", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                          "c_acctbal", "c_mktsegment")
    geo = geography(spark, sf_dir)
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    base = _money(F.col("o_totalprice"))
    k = F.col("o_orderkey")
    return joined.select(
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("n_name").alias("club"),
        F.col("c_name").alias("last_name"),
        F.when(k % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("F"), (F.col("o_custkey") % 7).cast("string")))
         .alias("first_name"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
         .otherwise(F.substring("c_mktsegment", 1, 3)).alias("position"),
        base.alias("base_salary"),
        _money(F.when(k % 97 == 0, F.lit(0).cast(MONEY))
               .when(k % 101 == 0, F.lit(5) * base)
               .otherwise(base + F.lit(10) * _money(F.col("c_acctbal"))))
        .alias("guaranteed_comp"),
        k.alias("record_id"),
        F.col("r_name").alias("region"),
        F.col("n_nationkey").alias("nk"),
    )


def pay_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pay`` restricted to the record columns (+ record_id, which carries input order)."""
    return pay(spark, sf_dir).select("year", "club", "last_name", "first_name", "position",
                                     "base_salary", "guaranteed_comp", "record_id")


def club_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pay_records`` with the club written four ways (as is, lower case, with an ' FC'
    suffix, with accented vowels) — input for the spelling-variant check."""
    recs = pay_records(spark, sf_dir)
    k = F.col("record_id") % 4
    club = (F.when(k == 0, F.col("club"))
            .when(k == 1, F.lower("club"))
            .when(k == 2, F.concat(F.col("club"), F.lit(" FC")))
            .otherwise(F.translate("club", "AO", "ÁÖ")))
    return recs.withColumn("club", club)


def club_typos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pay_records`` with a slip in the club of every 20th record: a letter dropped, doubled or replaced, at a
    place that depends on the record."""
    recs = pay_records(spark, sf_dir)
    k, n = F.col("record_id"), F.length("club")
    at = F.pmod(F.floor(k / 20), n).cast("int") + 1
    head, tail = F.substring("club", F.lit(1), at - 1), F.substring("club", at + 1, n)
    letter = F.substring("club", at, F.lit(1))
    slip = F.when(k % 60 == 0, F.concat(head, tail)).when(k % 60 == 20, F.concat(head, letter, letter, tail)).otherwise(F.concat(head, F.lit("x"), tail))
    return recs.withColumn("club", F.when(k % 20 == 0, slip).otherwise(F.col("club")))


def club_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Club dimension over the given tables: code 'N<nationkey>' -> nation name, and
    full name '<region> <nation>' (lower case) -> nation name."""
    geo = geography(spark, sf_dir)
    codes = geo.select(F.lit("code").alias("kind"),
                       F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("key"),
                       F.col("n_name").alias("canonical"))
    names = geo.select(F.lit("name").alias("kind"),
                       F.lower(F.concat_ws(" ", "r_name", "n_name")).alias("key"),
                       F.col("n_name").alias("canonical"))
    return codes.unionByName(names)


# Layout of the payroll documents derived from ``pay`` (fixed values).
TITLE = "{year} Payroll Report - Alphabetical List"
CSV_HEADER = "Club,Last Name,First Name,Position,Base Salary,Guaranteed Compensation"
PDF_HEADER_CLUB_FIRST = "Club  Last Name  First Name  Pos  Base Salary  Guaranteed Comp"
PDF_HEADER_NAMES_FIRST = "First Name Last Name Club Position Base Salary Guaranteed Compensation"


def _csv_quote(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def raw_pay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll documents as text lines, one source per year:
    (source_id, year, source_format, row_no, line).

    Odd years are CSV documents (club first), even years PDF-like text (names first
    when the year is divisible by 4). Row 0 is a title, row 1 the header, data rows follow
    in record order (row_no = 10 * record_id + 10), with blank lines and 'Total' lines mixed in.
    The club is written as the code 'N<nk>' for even record ids, else as '<region> <nation>'.
    Money is written '$1,234.56'. PDF rows leave blank fields out.
    """
    p = pay(spark, sf_dir)
    rid = F.col("record_id")
    is_csv = F.col("year") % 2 == 1
    names_first = F.col("year") % 4 == 0
    club_text = F.when(rid % 2 == 0, F.concat(F.lit("N"), F.col("nk").cast("string"))) \
        .otherwise(F.concat_ws(" ", "region", "club"))
    money = {c: F.concat(F.lit("$"), F.format_number(c, 2)) for c in ("base_salary", "guaranteed_comp")}
    last_cell = F.when(rid % 5 == 0, F.concat(F.lit('  "'), F.col("last_name"), F.lit('" ')))\
        .otherwise(F.col("last_name"))
    csv_line = F.concat_ws(",", club_text, last_cell, F.coalesce("first_name", F.lit("")),
                           F.concat(F.lit(" "), F.col("position")),
                           _csv_quote(money["base_salary"]), _csv_quote(money["guaranteed_comp"]))
    first = F.col("first_name")
    pos = F.nullif(F.col("position"), F.lit(""))
    club_first_toks = F.array(club_text, F.col("last_name"), first, pos,
                              money["base_salary"], money["guaranteed_comp"])
    names_first_toks = F.array(first, F.col("last_name"), club_text, pos,
                               money["base_salary"], money["guaranteed_comp"])
    toks = F.when(names_first, names_first_toks).otherwise(club_first_toks)
    pdf_line = F.when(rid % 3 == 0, F.array_join(toks, "\t ")).otherwise(F.array_join(toks, " "))
    src = F.concat(F.lit("pay-"), F.col("year").cast("string"))
    fmt = F.when(is_csv, F.lit("csv")).otherwise(F.lit("pdf"))
    data = F.struct((rid * 10 + 10).alias("row_no"),
                    F.when(is_csv, csv_line).otherwise(pdf_line).alias("line"))
    noise = F.when((rid % 97 == 1) | (rid % 89 == 3), F.struct(
        (rid * 10 + 15).alias("row_no"),
        F.when(rid % 97 == 1, F.lit("   "))
         .when(is_csv, F.lit('SUBTOTAL,"$1"')).otherwise(F.lit("Total $1")).alias("line")))
    # One pass over the records emits their data row and, for some, a noise row.
    body = p.select(src.alias("source_id"), "year", fmt.alias("source_format"),
                    F.explode(F.filter(F.array(data, noise), lambda x: x.isNotNull())).alias("r"))
    body = body.select("source_id", "year", "source_format", "r.row_no", "r.line")
    years = p.select("year").distinct()
    y_src = F.concat(F.lit("pay-"), F.col("year").cast("string"))
    y_fmt = F.when(F.col("year") % 2 == 1, F.lit("csv")).otherwise(F.lit("pdf"))
    title = years.select(y_src.alias("source_id"), "year", y_fmt.alias("source_format"),
                         F.lit(0).cast("bigint").alias("row_no"),
                         F.concat(F.col("year").cast("string"),
                                  F.lit(TITLE.replace("{year}", ""))).alias("line"))
    header = years.select(y_src.alias("source_id"), "year", y_fmt.alias("source_format"),
                          F.lit(1).cast("bigint").alias("row_no"),
                          F.when(F.col("year") % 2 == 1, F.lit(CSV_HEADER))
                           .when(F.col("year") % 4 == 0, F.lit(PDF_HEADER_NAMES_FIRST))
                           .otherwise(F.lit(PDF_HEADER_CLUB_FIRST)).alias("line"))
    return body.unionByName(title).unionByName(header)


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def raw_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_pay_lines`` parsed into raw rows: CSV lines into stripped cells, PDF lines
    into whitespace tokens.

    The result is checkpointed into ``spark.checkpoint.dir`` once per application and
    input folder — it stands for document rows that live in storage. Without the cut,
    the optimizer's constraint inference over the derived lineage (unioned joins feeding a
    long expression chain) grows beyond driver memory."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), "raw_pay")
    if key not in _STORED:
        _STORED[key] = _raw_pay(spark, sf_dir)
    return _STORED[key]


def _raw_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .documents import csv_cells, line_tokens
    lines = raw_pay_lines(spark, sf_dir)
    tokens = F.when(F.col("source_format") == "csv", csv_cells(F.col("line"))) \
        .otherwise(line_tokens(F.col("line")))
    rows = lines.select("source_id", "year", "source_format", "row_no", tokens.alias("tokens"))
    return cut_lineage(rows)


def dirty_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with messy text fields built from its columns:
    money_raw, name_raw, code_raw, text_raw, jersey_raw (and the clean sources)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    acct = _money(F.col("c_acctbal"))
    fmt = F.format_number(acct, 2)
    plain = acct.cast("string")
    money_raw = (F.when(k % 8 == 0, F.concat(F.lit("$"), fmt))
                 .when(k % 8 == 1, F.concat(fmt, F.lit("$")))
                 .when(k % 8 == 2, F.concat(F.lit("  $"), plain, F.lit("\t")))
                 .when(k % 8 == 3, F.lit(""))
                 .when(k % 8 == 4, F.lit(None).cast("string"))
                 .when(k % 8 == 5, F.lit("-"))
                 .when(k % 8 == 6, F.concat(plain, F.lit(".5")))
                 .otherwise(F.concat(F.lit("$ "), fmt)))
    name = F.col("c_name")
    name_raw = (F.when(k % 5 == 0, F.concat(F.lit('  "'), name, F.lit('"  ')))
                .when(k % 5 == 1, F.concat(F.lit("'"), name, F.lit("'")))
                .when(k % 5 == 2, F.concat(F.lit("\"'"), name, F.lit("'\"")))
                .when(k % 5 == 3, F.concat(F.lit("\t"), name, F.lit(" \n")))
                .otherwise(F.lit(None).cast("string")))
    mkt = F.col("c_mktsegment")
    code_raw = (F.when(k % 4 == 0, F.concat(F.lit(" "), F.lower(F.substring(mkt, 1, 3)), F.lit("-f ")))
                .when(k % 4 == 1, F.concat(F.substring(mkt, 1, 2), F.lit("/"), F.substring(mkt, 3, 1)))
                .when(k % 4 == 2, mkt)
                .otherwise(F.lit("")))
    text_raw = F.concat(F.replace(name, F.lit("#"), F.lit(":  \t(#")),
                        F.when(k % 3 == 0, F.lit(" Ht. (cm)")).when(k % 3 == 1, F.lit("  "))
                        .otherwise(F.lit("")))
    jersey_raw = (F.when(k % 3 == 0, F.concat(F.lit("#"), (k % 100).cast("string")))
                  .when(k % 3 == 1, F.concat(F.lit("No. "), (k % 10).cast("string"), F.lit(" / 8")))
                  .otherwise(F.lit("--")))
    return c.select(k.alias("id"), money_raw.alias("money_raw"), name_raw.alias("name_raw"),
                    code_raw.alias("code_raw"), text_raw.alias("text_raw"),
                    jersey_raw.alias("jersey_raw"), name.alias("c_name"))


def team_slug(name: Column) -> Column:
    """'NATION_7' -> 'nation-7'."""
    return F.translate(F.lower(name), "_ ", "--")


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured guide page per order: (page_id, html).

    The page links its club's roster and stats pages and holds a salary-guide block with
    four links — the order year in the text (.csv for odd keys, .pdf otherwise), the same
    year only in the address (.CSV / .Pdf, a later link of the same year), a page of an
    unknown format, and a file without year — plus a season drop-down (year, 'all',
    year - 1) and its mobile copy."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    geo = geography(spark, sf_dir)
    d = deal(o.join(c, o.o_custkey == c.c_custkey).join(geo, F.col("c_nationkey") == F.col("n_nationkey")), o)
    k = F.col("o_orderkey")
    # Guide years run 25 years after the order years, into the 2000-2050 window.
    y = (F.year("o_orderdate") + 25).cast("string")
    y1 = (F.year("o_orderdate") + 24).cast("string")
    slug = team_slug(F.col("n_name"))
    ext1 = F.when(k % 2 == 1, F.lit("csv")).otherwise(F.lit("pdf"))
    ext2 = F.when(k % 3 == 0, F.lit("CSV")).otherwise(F.lit("Pdf"))
    html = F.concat(
        F.lit('<html><body><nav><a href="/clubs/'), slug, F.lit('/roster/">Roster</a> '),
        F.lit('<a class="x" href="/clubs/'), slug, F.lit('/stats/">Stats</a></nav>'),
        F.lit('<div class="wrap salaryGuides"><ul>'),
        F.lit('<li><a href="/files/'), y, F.lit("-guide."), ext1, F.lit('">Fall '), y,
        F.lit(' <b>Guide</b></a></li>'),
        F.lit('<li><a href="/files/'), y, F.lit("-update."), ext2, F.lit('">Update</a></li>'),
        F.lit('<li><a href="/files/notes.html">'), y1, F.lit(" notes</a></li>"),
        F.lit('<li><a href="/files/summary.pdf">Summary</a></li>'),
        F.lit("</ul></div>"),
        F.lit('<select class="mls-o-buttons__dropdown-button"><option value="'), y,
        F.lit('">'), y, F.lit('</option><option value="all">All</option><option value=" '), y1,
        F.lit(' ">'), y1, F.lit("</option></select>"),
        F.lit('<select class="mls-o-buttons__dropdown-button mobile"><option value="1999">1999</option></select>'),
        F.lit("</body></html>"))
    return d.select(k.alias("page_id"), html.alias("html"))


# Site root used to make relative player links absolute in the fixtures (parameter).
FIXTURE_BASE_URL = "https://league.example"


def roster_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured roster page per order: (page_id, team_name, team_slug, html).

    The team is the customer's nation. The roster table lists the customer as a player
    (link, image, name element, jersey, position, categories, status); pages with a key of 1 or 2
    modulo 6 have a row before that one with a table inside a cell and '>' in an attribute; every
    third page adds a row without a player link, every fourth a second roster table that repeats the player
    (first occurrence wins), every fifth a table without a 'player' header."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    geo = geography(spark, sf_dir)
    d = deal(o.join(c, o.o_custkey == c.c_custkey).join(geo, F.col("c_nationkey") == F.col("n_nationkey")), o)
    k = F.col("o_orderkey")
    cid = F.col("c_custkey").cast("string")
    slug = team_slug(F.col("n_name"))
    pos = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))\
        .otherwise(F.concat(F.lit(" "), F.substring("c_mktsegment", 1, 1), F.lit(" ")))
    category = F.when(k % 2 == 0, F.lit("Senior")).otherwise(F.lit("Supplemental"))
    pcat = F.when(k % 7 == 0, F.lit("Designated  Player")).otherwise(F.lit(""))
    status = F.when(F.col("o_orderstatus") == "F", F.lit("Active")).otherwise(F.lit("Injured"))
    main = F.concat(
        F.lit('<table class="mls-o-table"><thead><tr><th>Player</th><th>Jersey #</th><th>Position</th>'
              '<th>Roster Category</th><th>Player Category</th><th>Player Status</th></tr></thead><tbody>'),
        F.when((k % 6).isin(1, 2), F.lit('<tr><td title="a>b">Staff<table class="tip"><tr><td>Since</td><td>2020</td></tr></table></td>'
                                         "<td title='c > d'></td></tr>")).otherwise(F.lit("")),
        F.lit('<tr><td><a class="mls-o-table__href" title="club > player" href="/players/c'), cid,
        F.lit('/"><img src="/img/c'), cid, F.lit('.png"/><span class="short-name"> '),
        F.col("c_name"), F.lit(' </span></a></td><td>#'), (F.col("c_custkey") % 99).cast("string"),
        F.lit("</td><td>"), pos, F.lit("</td><td>"), category, F.lit("</td><td>"), pcat,
        F.lit("</td><td>"), status, F.lit("</td></tr>"),
        F.when(k % 3 == 0, F.lit("<tr><td>Coach</td><td></td><td>HC</td></tr>")).otherwise(F.lit("")),
        F.lit("</tbody></table>"))
    repeat = F.when(k % 4 == 0, F.concat(
        F.lit('<table><tr><th>Player</th><th>Position</th></tr><tr><td><a href="/players/c'), cid,
        F.lit('/">'), F.col("c_name"), F.lit("</a></td><td>X</td></tr></table>"))).otherwise(F.lit(""))
    other = F.when(k % 5 == 0, F.lit("<table><tr><th>Date</th><th>Note</th></tr>"
                                     "<tr><td>x</td><td>y</td></tr></table>")).otherwise(F.lit(""))
    html = F.concat(F.lit("<html><body><h1>"), F.col("n_name"), F.lit("</h1>"), main, repeat, other,
                    F.lit("</body></html>"))
    return d.select(k.alias("page_id"), F.initcap(F.translate(slug, "-", " ")).alias("team_name"),
                    slug.alias("team_slug"), html.alias("html"))


def stats_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured stats page per event: (page_id, team_name, team_slug, season,
    stat_type, html). Team = event type, season = event year, stat type cycles through the
    five tables. The stats table keys its columns by CSS class; a totals row with fewer
    than three cells is mixed in, on every fourth page also a row with a table inside a cell."""
    from ..schemas import STAT_TYPES
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    e = deal(e, e)
    uid = F.col("user_id").cast("string")
    kval = F.get_json_object("props", "$.k")
    stat_type = F.element_at(F.array(*[F.lit(s) for s in STAT_TYPES]),
                             (F.col("event_id") % len(STAT_TYPES) + 1).cast("int"))
    html = F.concat(
        F.lit('<html><body><table class="mls-o-table"><thead><tr>'
              '<th class="mls-o-table__header player">Player</th>'
              '<th class="mls-o-table__header club">Club</th>'
              '<th class="mls-o-table__header stats-type games_played">GP</th>'
              '<th class="mls-o-table__header mls-o-table__header--sorted value">Value</th>'
              '<th class="k">K</th></tr></thead><tbody>'),
        F.when(F.col("event_id") % 4 == 0, F.lit("<tr><td title='x>y'>Note<table><tr><td>n</td></tr></table></td><td></td></tr>")).otherwise(F.lit("")),
        F.lit('<tr><td class="mls-o-table__cell player"><a href="/players/u'), uid,
        F.lit('/"><img src="/img/u'), uid, F.lit('.png"><span class="mls-o-table__player-name">Player '),
        uid, F.lit('</span></a></td><td class="mls-o-table__cell club">'), F.upper(F.col("event_type")),
        F.lit('</td><td class="mls-o-table__cell games_played">'), (F.col("event_id") % 30).cast("string"),
        F.lit('</td><td class="mls-o-table__cell mls-o-table__cell--sorted value"> '),
        F.col("value").cast("decimal(18,2)").cast("string"),
        F.lit(' </td><td class="k">'), F.coalesce(kval, F.lit("")), F.lit("</td></tr>"),
        F.lit("<tr><td>Totals</td><td></td></tr></tbody></table></body></html>"))
    slug = F.col("event_type")
    return e.select(F.col("event_id").alias("page_id"),
                    F.initcap(F.translate(slug, "-", " ")).alias("team_name"), slug.alias("team_slug"),
                    F.year("ts").cast("int").alias("season"), stat_type.alias("stat_type"),
                    html.alias("html"))


def player_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured player profiles: (player_url, fetch_order, profile MAP<STRING,STRING>).

    Customers give profiles of the even user ids ('/players/u<2*custkey>/'), suppliers of
    the multiples of 3 ('/players/u<3*suppkey>/', fetched later): multiples of 6 have two
    profiles (the first fetched wins), ids that are neither have none."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_acctbal")
    url = lambda n: F.concat(F.lit(FIXTURE_BASE_URL + "/players/u"), n.cast("string"), F.lit("/"))
    cp = c.select(url(F.col("c_custkey") * 2).alias("player_url"), F.col("c_custkey").alias("fetch_order"),
                  F.create_map(F.lit("full_name"), F.col("c_name"),
                               F.lit("position"), F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")),
                               F.lit("height"), F.lit("")).alias("profile"))
    sp = s.select(url(F.col("s_suppkey") * 3).alias("player_url"),
                  (F.lit(1_000_000_000) + F.col("s_suppkey")).alias("fetch_order"),
                  F.create_map(F.lit("full_name"), F.col("s_name"),
                               F.lit("position"), F.lit("SUP")).alias("profile"))
    return cp.unionByName(sp)


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured profile page per customer: (page_id, player_url, html) — masthead with
    image (alt = name), club logo link, '#<jersey> <position>' info (on every fifth page behind an empty
    image box, an advertisement and the link of a former club), and detail items
    (height, date of birth with an inner tag, position, a blank nickname, a repeated
    height that replaces the first)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    geo = geography(spark, sf_dir)
    d = deal(c.join(geo, F.col("c_nationkey") == F.col("n_nationkey")), c)
    k = F.col("c_custkey")
    ks = k.cast("string")
    slug = team_slug(F.col("n_name"))

    def item(label, value):
        return F.concat(F.lit('<div class="mls-l-module--player-status-details__info"><h3>'), label,
                        F.lit("</h3><span>"), value, F.lit("</span></div>"))
    html = F.concat(
        F.lit("<html><body>"),
        F.when(k % 5 == 0, F.lit('<div class="mls-o-masthead__branded-image"></div><div class="ad"><img src="/ad.png" alt="Ad"></div>')).otherwise(F.lit("")),
        F.lit('<div class="mls-o-masthead">'),
        F.when(k % 5 == 0, F.lit('<div class="mls-o-masthead__branded-image"></div><a class="mls-o-masthead__club-logo-old" href="/clubs/old/">'
                                 '<img src="/logo/old.svg"></a>')).otherwise(F.lit("")),
        F.lit('<div class="mls-o-masthead__branded-image"><img src="/big/c'), ks, F.lit('.jpg" alt=" '), F.col("c_name"), F.lit(' "></div>'),
        F.lit('<a class="mls-o-masthead__club-logo" href="/clubs/'), slug, F.lit('/"><img src="/logo/'),
        slug, F.lit('.svg"></a><div class="mls-o-masthead__info-wrapper"><span>#'),
        (k % 99).cast("string"), F.lit("</span> <span>"), F.substring("c_mktsegment", 1, 1),
        F.lit("</span></div></div><div class=\"mls-l-module--player-status-details\">"),
        item(F.lit("Height (cm):"), (F.lit(170) + k % 30).cast("string")),
        item(F.lit("Date of  Birth"), F.concat(F.lit("19"), (F.lit(70) + k % 30).cast("string"),
                                               F.lit(" <b>(age ?)</b>"))),
        item(F.lit("Position"), F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" "))),
        item(F.lit("Nickname"), F.lit(" ")),
        F.when(k % 4 == 0, item(F.lit("Height (cm)"), F.lit("199"))).otherwise(F.lit("")),
        F.lit("</div></body></html>"))
    return d.select(k.alias("page_id"),
                    F.concat(F.lit(FIXTURE_BASE_URL + "/players/c"), ks, F.lit("/")).alias("player_url"),
                    html.alias("html"))
