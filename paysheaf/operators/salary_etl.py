"""Raw document rows -> salary records, for all sources in one job.

Plan: ``find_headers`` (tiny aggregate, one row per source) -> size-checked broadcast back
onto the raw rows -> drop rows at or before the header and blank rows -> per source pick
the route (index parse for complete CSV maps, token heuristics otherwise) -> records.
After the header table everything is map-only column expressions: no Python UDF, no
shuffle of the raw rows, so a source holding a third of all rows is simply spread over
the partitions it was read in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clubs import ClubLookup, club_parts, club_start
from ..functions.text import (clean_code, clean_money, clean_name, looks_like_code,
                              money_positions, split_name_parts, strip)
from ..session import cut_lineage, sized_broadcast
from .headers import header_table

# One header row per source is broadcast; above this many sources it is shuffle-joined.
MAX_BROADCAST_SOURCES = 200_000
REQUIRED_FOR_INDEX = ("club", "first_name", "last_name", "base_salary", "guaranteed_comp")

RECORD_COLS = ("year", "club", "last_name", "first_name", "position", "base_salary",
               "guaranteed_comp")


def _blank_row(tokens: Column) -> Column:
    return F.forall(tokens, lambda x: strip(x) == "")


def data_rows(raw_rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows after each source's header row, blank rows dropped, header facts attached.

    The header table (one row per source) is broadcast after a size check, so the raw rows
    are never shuffled; above the bound the join is left to the optimizer."""
    h = sized_broadcast(headers, MAX_BROADCAST_SOURCES)
    rows = raw_rows.join(h, "source_id")
    return rows.filter((F.col("row_no") > F.col("header_row_no"))
                       & (F.size("tokens") > 0) & ~_blank_row(F.col("tokens")))


def index_route(source_format: Column, cmap: Column) -> Column:
    """Index parse only for CSV sources whose header maps all five required fields."""
    ok = source_format == "csv"
    for f in REQUIRED_FOR_INDEX:
        ok = ok & cmap[f].isNotNull()
    return ok


OUT_FIELDS = ("club", "last_name", "first_name", "position", "base_salary", "guaranteed_comp")


def parse_indexed(rows: DataFrame, active: Column | None = None) -> DataFrame:
    """Adds ``i_<field>`` columns and ``i_ok`` from mapped cell positions; ``i_ok`` is false
    when a needed cell is missing or a money cell does not parse. The club is only
    stripped here, not normalised."""
    on = F.lit(True) if active is None else active
    c = F.col
    cm = lambda f: c(f"cmap.{f}")
    n = F.size("tokens")
    in_range = F.lit(True)
    for f in REQUIRED_FOR_INDEX:
        in_range = in_range & (cm(f) < n)
    in_range = in_range & (F.coalesce(cm("position"), F.lit(-1)) < n)
    d = rows.withColumns({
        "i_club": F.when(on, strip(F.get(c("tokens"), cm("club")))),
        "i_last_name": F.when(on, clean_name(F.get(c("tokens"), cm("last_name")))),
        "i_first_name": F.when(on, clean_name(F.get(c("tokens"), cm("first_name")))),
        "i_position": F.when(on & cm("position").isNotNull(),
                             clean_code(F.get(c("tokens"), cm("position")))).otherwise(F.lit("")),
        "i_base_salary": F.when(on, clean_money(F.get(c("tokens"), cm("base_salary")))),
        "i_guaranteed_comp": F.when(on, clean_money(F.get(c("tokens"), cm("guaranteed_comp")))),
    })
    return d.withColumn("i_ok", on & in_range & c("i_base_salary").isNotNull()
                        & c("i_guaranteed_comp").isNotNull())


def parse_heuristic(rows: DataFrame, lookup: ClubLookup, compat: bool = False,
                    active: Column | None = None) -> DataFrame:
    """Adds ``h_<field>`` columns and ``h_ok``: a record parsed from a token row anchored on
    its last two money tokens; ``h_ok`` is false when there are fewer than two money tokens
    or one of them does not parse.

    Position: the last token when the header puts position after the money columns,
    else the token before the base salary when it looks like a code. What precedes is
    club + names (club-first rows: longest known club prefix; names-first rows: the club
    starts at the first code or club first word, default after two name tokens).
    Fixed mode drops lone '$' tokens first (split '$ 1,000' cells); ``compat`` keeps them.

    Each step is a projection of scalar columns that refers to the previous step by name,
    so the optimizer keeps the expression tree linear (struct-valued steps would be
    inlined into every field access).
    """
    on = F.lit(True) if active is None else active
    c = F.col
    t0 = c("tokens") if compat else F.filter(c("tokens"), lambda x: x != "$")
    d = rows.withColumn("_t", F.when(on, t0))
    d = d.withColumn("_m", money_positions(c("_t")))
    d = d.withColumns({
        "_n": F.size("_t"),
        "_nm": F.size("_m"),
        "_bi": F.get(c("_m"), F.size("_m") - 2),
        "_gi": F.get(c("_m"), F.size("_m") - 1),
    })
    pos_map = F.coalesce(c("cmap.position"), F.lit(-1))
    d = d.withColumns({
        "h_base_salary": clean_money(F.get(c("_t"), c("_bi"))),
        "h_guaranteed_comp": clean_money(F.get(c("_t"), c("_gi"))),
        "_last": F.get(c("_t"), c("_n") - 1),
        "_before": F.get(c("_t"), c("_bi") - 1),
        "_trailing": (pos_map != -1) & (pos_map > F.coalesce(c("cmap.guaranteed_comp"), c("_gi"))),
    })
    d = d.withColumn("_before_code", ~c("_trailing") & (c("_bi") > 0) & looks_like_code(c("_before")))
    d = d.withColumns({
        "h_position": F.when(c("_trailing") & looks_like_code(c("_last")), clean_code(c("_last")))
                       .when(c("_before_code"), clean_code(c("_before"))).otherwise(F.lit("")),
        "_prefix": F.slice(c("_t"), 1, F.when(c("_before_code"), c("_bi") - 1).otherwise(c("_bi"))),
    })
    cf_club, cf_consumed = club_parts(c("_prefix"), lookup, compat)
    d = d.withColumns({
        "_cf_club": cf_club,
        "_cf_consumed": cf_consumed,
        "_start": club_start(c("_prefix"), lookup),
        "_np": F.size("_prefix"),
    })
    found = c("_start") > 0
    d = d.withColumns({
        "_cf_names": F.slice(c("_prefix"), c("_cf_consumed") + 1,
                             F.greatest(c("_np") - c("_cf_consumed"), F.lit(0))),
        "_nf_names": F.when(found, F.slice(c("_prefix"), 1, c("_start")))
                      .otherwise(F.slice(c("_prefix"), 1, 2)),
        "_nf_rest": F.when(found, F.slice(c("_prefix"), c("_start") + 1, c("_np")))
                     .otherwise(F.slice(c("_prefix"), 3, F.greatest(c("_np") - 2, F.lit(0)))),
    })
    nf_club, _ = club_parts(c("_nf_rest"), lookup, compat)
    d = d.withColumns({
        "h_club": F.when(c("club_first"), c("_cf_club")).otherwise(nf_club),
        "_names": F.when(c("club_first"), c("_cf_names")).otherwise(c("_nf_names")),
    })
    first, last = split_name_parts(c("_names"), c("last_first"))
    d = d.withColumns({"h_first_name": first, "h_last_name": last})
    d = d.withColumn("h_ok", on & (c("_nm") >= 2) & c("h_base_salary").isNotNull()
                     & c("h_guaranteed_comp").isNotNull())
    return d.drop(*[x for x in d.columns if x.startswith("_")])


def salary_records(raw_rows: DataFrame, lookup: ClubLookup, compat: bool = False,
                   headers: DataFrame | None = None) -> DataFrame:
    """raw_rows(source_id, year, source_format, row_no, tokens) -> salary records
    (year, club, last_name, first_name, position, base_salary, guaranteed_comp,
    source_id, row_no, route) — route: 'index', 'club_first' or 'names_first'. Sources
    without a header row yield nothing."""
    # Materialised once: the size check and the broadcast then read the small result
    # instead of scanning the raw rows again.
    h = cut_lineage(header_table(raw_rows)) if headers is None else headers
    rows = data_rows(raw_rows, h)
    rows = rows.withColumn("index_route", index_route(F.col("source_format"), F.col("cmap")))
    rows = parse_indexed(rows, active=F.col("index_route"))
    rows = parse_heuristic(rows, lookup, compat, active=~F.col("index_route"))
    r = F.col("index_route")
    ok = F.when(r, F.col("i_ok")).otherwise(F.col("h_ok"))
    rec = F.struct(*[F.when(r, F.col(f"i_{f}")).otherwise(F.col(f"h_{f}")).alias(f)
                     for f in OUT_FIELDS])
    # explode(when(ok, [rec])) instead of filter(ok): a filter on derived columns is pushed
    # down through every projection step by alias substitution, re-inlining the whole chain;
    # a generator keeps the steps apart.
    route = F.when(r, F.lit("index")).when(F.col("club_first"), F.lit("club_first")) \
        .otherwise(F.lit("names_first"))
    out = rows.select("year", "source_id", "row_no", route.alias("route"),
                      F.explode(F.when(ok, F.array(rec))).alias("rec"))
    return out.select("year", *[F.col(f"rec.{f}").alias(f) for f in OUT_FIELDS], "source_id", "row_no",
                      "route")
