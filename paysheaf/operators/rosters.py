"""Roster tables -> player records.

``roster_rows``: table rows of roster pages -> raw player rows (tables without a 'player'
header skipped, the header row skipped, rows without a player link dropped, cells mapped
to fields by the position of their header). ``first_per_key``: first occurrence per
(team, player) — a partial ``min_by`` aggregate, so a hot key is reduced map-side.
``roster_normalize``: cleaning plus the profile preference rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (blank, blank_to_null, collapse_ws, first_digits, let, prefer_nonblank,
                              strip_if_set)
from ..schemas import PLAYER_FIELDS

# Roster header text -> field (fixed values).
ROSTER_HEADERS = {
    "jersey #": "jersey_number",
    "position": "position",
    "roster category": "roster_category",
    "player category": "player_category",
    "player status": "player_status",
}
PLAYER_HEADER = "player"


def absolute_url(href: Column, base_url: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base_url), href))


def _last_index(headers: Column, name: str) -> Column:
    idx = F.transform(headers, lambda h, i: F.when(h == name, i))
    return F.array_max(F.filter(idx, lambda i: i.isNotNull()))


def roster_rows(rows: DataFrame, pages: DataFrame | None, base_url: str, key: str = "page_id") -> DataFrame:
    """rows: output of ``html_tables.table_rows``; pages: (key, team_name, team_slug), or
    None when ``rows`` already carries team_name and team_slug.

    Returns (team_name, team_slug, player_name, player_url, player_image_thumb,
    jersey_number, position, roster_category, player_category, player_status,
    page_id, table_no, row_no)."""
    low = F.transform("headers", lambda h: F.lower(h))
    r = rows.withColumn("_h", low).filter(
        F.array_contains("_h", PLAYER_HEADER) & (F.col("row_no") > 0) & F.col("link_href").isNotNull())
    fields = []
    for header, field in ROSTER_HEADERS.items():
        i = _last_index(F.col("_h"), header)
        val = F.when(i < F.size("cells"), F.nullif(F.get(F.col("cells"), i), F.lit("")))
        fields.append(val.alias(field))
    carried = [] if pages is not None else ["team_name", "team_slug"]
    r = r.select(
        key, "table_no", "row_no", *carried,
        F.coalesce("name_text", "link_text").alias("player_name"),
        absolute_url(F.col("link_href"), base_url).alias("player_url"),
        F.col("thumb").alias("player_image_thumb"),
        *fields)
    return r if pages is None else r.join(pages.select(key, "team_name", "team_slug"), key)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ``order`` (first-wins dedupe), as a partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("_v")).select(*keys, "_v.*")


def dedupe_players(raw: DataFrame) -> DataFrame:
    """One row per (team_slug, player_url): the first in page, table and row order."""
    return first_per_key(raw, ["team_slug", "player_url"], ["page_id", "table_no", "row_no"])


PROFILE_FACTS = ("player_image", "team_logo", "full_name", "club_slug", "jersey_number_profile")


def roster_normalize(raw: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """Raw player rows -> player records (``PLAYER_FIELDS`` + ``profile`` map).

    ``profiles``: profile facts (player_url, profile map, player_image, team_logo,
    full_name, club_slug, jersey_number_profile), one row per URL — e.g. from
    ``sources.profiles.profile_facts``. Profile values win over roster values for jersey,
    position and the two categories when set; the output ``profile`` map holds the set
    detail items (cleaned) plus full_name and club_slug. Rows whose cleaned name is blank
    are dropped."""
    empty = F.create_map().cast("map<string,string>")
    d = raw
    if profiles is not None:
        # One row per URL, whatever the profiles repeat: players are never multiplied.
        facts = profiles.select("player_url", "profile", *PROFILE_FACTS)
        facts = first_per_key(facts.withColumn("_order", F.xxhash64(F.to_json(F.struct("*")))), ["player_url"], ["_order"])
        d = d.join(facts.drop("_order"), "player_url", "left")
    else:
        d = d.withColumn("profile", empty)
        for c in PROFILE_FACTS:
            d = d.withColumn(c, F.lit(None).cast("string"))
    details = F.coalesce(F.col("profile"), empty)
    p = lambda k: details.getItem(k)
    extra = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("full_name").alias("k"), F.col("full_name").alias("v")),
        F.struct(F.lit("club_slug").alias("k"), F.col("club_slug").alias("v"))), lambda e: ~blank(e["v"])))
    kept = F.transform_values(F.map_filter(details, lambda k, v: ~blank(v)), lambda k, v: blank_to_null(v))
    profile_out = let(extra, lambda x: F.map_concat(F.map_filter(kept, lambda k, v: ~F.map_contains_key(x, k)), x))
    name = collapse_ws(F.col("player_name"))
    out = d.select(
        F.col("team_name"), F.col("team_slug"), name.alias("player_name"), F.col("player_url"),
        first_digits(prefer_nonblank(F.col("jersey_number_profile"), F.col("jersey_number"))).alias("jersey_number"),
        strip_if_set(prefer_nonblank(p("position"), F.col("position"))).alias("position"),
        blank_to_null(prefer_nonblank(p("roster_category"), F.col("roster_category"))).alias("roster_category"),
        blank_to_null(prefer_nonblank(p("player_category"), F.col("player_category"))).alias("player_category"),
        blank_to_null(F.col("player_status")).alias("player_status"),
        F.col("player_image_thumb"),
        F.col("player_image"),
        F.col("team_logo"),
        profile_out.alias("profile"),
    )
    return out.filter(F.col("player_name") != "").select(*PLAYER_FIELDS, "profile")
