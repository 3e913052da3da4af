"""Link discovery over captured HTML pages (a DataFrame with a page key and its HTML).

Each page is read once (``functions/html.py``): comments and scripts are dropped, nested elements are followed by depth, attributes may be quoted in any way, entities are
decoded, classes are compared as tokens. Links are exploded with their position.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import anchors, attr, clean, elements, has_class, pattern
from ..functions.text import collapse_ws, strip
from .page_rows import page_rows

# --- fixed values -------------------------------------------------------------------------
# A year between 2000 and 2050, first match in the text.
YEAR_PATTERN = r"(20([0-4][0-9]|50))"
# Class of the element that holds the salary-guide links.
GUIDE_CLASS = "salaryGuides"
# Class of the season drop-down and the class that marks its mobile copy.
SEASON_SELECT_CLASS = "mls-o-buttons__dropdown-button"
MOBILE_CLASS = "mobile"
# ------------------------------------------------------------------------------------------


def year_of(c: Column) -> Column:
    """First 2000–2050 year in a text, NULL when there is none."""
    return F.nullif(F.regexp_extract(c, YEAR_PATTERN, 1), F.lit("")).cast("int")


def extract_year(text: Column, href: Column) -> Column:
    """Year from the link text, else from its address."""
    return F.coalesce(year_of(text), year_of(href))


def detect_format(url: Column) -> Column:
    """'csv' when the address contains '.csv' (any case), else 'pdf' for '.pdf', else NULL."""
    u = F.lower(url)
    return F.when(u.contains(".csv"), F.lit("csv")).when(u.contains(".pdf"), F.lit("pdf"))


def guide_anchors(page: str) -> list[tuple[str, str]]:
    """Links of the first salary-guide <div> of a cleaned page (none when it has no such element)."""
    return anchors(next(iter(elements(page, "div", GUIDE_CLASS)), ""))


def season_values(page: str) -> list[str] | None:
    """Option values of the first season drop-down of a cleaned page that is not the mobile copy (None without one)."""
    for attrs, body in pattern(r"<select\b([^>]*)>(.*?)(?=</select\b|<select\b|\Z)").findall(page):
        if has_class(attrs, SEASON_SELECT_CLASS) and not has_class(attrs, MOBILE_CLASS):
            values = [attr(o, "value") for o in pattern(r"<option\b([^>]*)>").findall(body)]
            return [v for v in values if v is not None]
    return None


def read_guide(html: str | None) -> Iterator[tuple]:
    """(pos, href, text) of the guide links of a page."""
    for pos, (href, text) in enumerate(guide_anchors(clean(html)) if html is not None else []):
        yield pos, href, text


def read_links(html: str | None) -> Iterator[tuple]:
    """(pos, href) of all links of a page."""
    for pos, (href, _) in enumerate(anchors(clean(html)) if html is not None else []):
        yield pos, href


def read_seasons(html: str | None) -> Iterator[tuple]:
    """(pos, value) of the season options of a page."""
    yield from enumerate((season_values(clean(html)) if html is not None else None) or [])


def read_guide_seasons(html: str | None) -> Iterator[tuple]:
    """(pos, href, text, seasons) of the guide links of a page, seasons being the option values."""
    if html is not None:
        page = clean(html)
        seasons = season_values(page)
        for pos, (href, text) in enumerate(guide_anchors(page)):
            yield pos, href, text, seasons


def season(value: Column) -> Column:
    """An option value as an integer, NULL where it is none."""
    return F.when(strip(value).rlike(r"^[+-]?[0-9]+$"), strip(value).try_cast("int"))


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """All links of each page's guide block: (key, pos, href, text, year, format).

    ``text`` is the anchor text without tags, whitespace-collapsed; ``year`` comes from the
    text, else from the address; ``format`` from the address. Links without year or format
    are kept here (NULL) — ``guide_sources`` drops them."""
    found = page_rows(pages, [key], html, "pos int, href string, text string", read_guide)
    ex = found.select(key, "pos", strip(F.col("href")).alias("href"), collapse_ws(F.col("text")).alias("text"))
    return ex.select(key, "pos", "href", "text", extract_year(F.col("text"), F.col("href")).alias("year"),
                     detect_format(F.col("href")).alias("format"))


def guide_sources(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Usable guide links: year and format both known."""
    return page_links(pages, key, html).filter(F.col("year").isNotNull() & F.col("format").isNotNull())


def last_per_key(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """One row per key: the values of the row with the highest ``order`` (last wins).

    ``max_by`` is a partial aggregate, so a key holding a third of all rows is reduced in
    every map task before the shuffle."""
    pick = F.max_by(F.struct(*cols), F.col(order))
    return df.groupBy(*keys).agg(pick.alias("_v")).select(*keys, "_v.*")


def one_source_per_year(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, year, url, format): the last usable guide link of each year on each page."""
    links = guide_sources(pages, key).withColumnRenamed("href", "url")
    return last_per_key(links, [key, "year"], "pos", ["url", "format"])


def club_links(pages: DataFrame, kind: str = "roster", key: str = "page_id",
               html: str = "html", base_url: str = "") -> DataFrame:
    """Teams from '/clubs/<slug>/<kind>' links: (slug, name, roster_url, stats_url,
    first_key, first_pos) — one row per slug, the first occurrence decides its rank.

    The display name is the slug with '-' as spaces in title case."""
    hrefs = page_rows(pages, [key], html, "pos int, href string", read_links)
    slug = F.regexp_extract("href", r"/clubs/([^/]+)/" + kind, 1)
    found = hrefs.select(key, "pos", slug.alias("slug")).filter(F.col("slug") != "")
    first = found.groupBy("slug").agg(F.min(F.struct(key, "pos")).alias("_f"))
    return first.select(
        "slug",
        F.initcap(F.translate("slug", "-", " ")).alias("name"),
        F.concat(F.lit(base_url + "/clubs/"), "slug", F.lit("/roster/")).alias("roster_url"),
        F.concat(F.lit(base_url + "/clubs/"), "slug", F.lit("/stats/")).alias("stats_url"),
        F.col(f"_f.{key}").alias("first_" + key), F.col("_f.pos").alias("first_pos"))


def season_options(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, season): the integer options of the first season drop-down that is not the mobile copy."""
    out = page_rows(pages, [key], html, "pos int, value string", read_seasons)
    return out.select(key, "pos", season(F.col("value")).alias("season")).filter(F.col("season").isNotNull())


def links_in_season(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, year): guide links whose year is a season offered on the same page. Both lists
    are read from one page, so the semi join needs no shuffle."""
    d = page_rows(pages, [key], html, "pos int, href string, text string, seasons array<string>", read_guide_seasons)
    year = extract_year(collapse_ws(F.col("text")), strip(F.col("href"))).alias("year")
    d = d.select(key, "pos", year, F.transform("seasons", season).alias("seasons"))
    return d.filter(F.array_contains("seasons", F.col("year"))).select(key, "pos", "year")


def available_years(pages: DataFrame, requested: int | None = None, key: str = "page_id") -> DataFrame:
    """Years with a usable source, newest first; a ``requested`` year alone, or an error without it."""
    years = guide_sources(pages, key).select("year").distinct()
    if requested is None:
        return years.orderBy(F.desc("year"))
    found = years.filter(F.col("year") == requested)
    missing = F.raise_error(F.lit(f"no source for the year {requested}")).cast("int")
    return found.agg(F.max("year").alias("year")).select(F.coalesce("year", missing).alias("year"))
