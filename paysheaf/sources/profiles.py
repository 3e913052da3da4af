"""Player profile pages -> profile facts (one row per page).

Facts: the detail items (label -> value map; labels turned into keys, blank keys or
values dropped, a repeated key keeps its last value), the large player image and its alt
text (full name), the club logo, the club slug from the logo link, and the jersey number
('#<digits>') from the masthead info text.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import attr, clean, first_element, get_text, get_text_spaced, group, has_class, pattern, with_class
from ..functions.text import normalize_key
from .page_rows import page_rows

# --- fixed values: page classes ------------------------------------------------------------
MASTHEAD_CLASS = "mls-o-masthead"
DETAILS_CLASS = "mls-l-module--player-status-details"
DETAIL_ITEM_CLASS = "mls-l-module--player-status-details__info"
BRANDED_IMAGE_CLASS = "mls-o-masthead__branded-image"
CLUB_LOGO_CLASS = "mls-o-masthead__club-logo"
INFO_WRAPPER_CLASS = "mls-o-masthead__info-wrapper"
# ---------------------------------------------------------------------------------------------


_FACTS = ("_labels array<string>, _values array<string>, player_image string, full_name string, team_logo string, _club string, _info string")


def _image_in(html: str, cls: str) -> str | None:
    """Attribute string of the first <img> inside an element with class ``cls`` (None when there is none)."""
    found = pattern(r"<img\b(?:([^>]*)>)?").search("".join(with_class(html, cls)))
    return group(found) if found else None


def read_profile(html: str | None) -> Iterator[tuple]:
    """The facts of a page, in one row; the detail items as their labels and values."""
    if html is None:
        yield (None,) * 7
        return
    page = clean(html)
    head = next(iter(with_class(page, MASTHEAD_CLASS, first=True)), "")
    details = next(iter(with_class(page, DETAILS_CLASS, first=True)), page)
    items = [(first_element(it, "h3"), first_element(it, "span")) for it in with_class(details, DETAIL_ITEM_CLASS)]
    items = [(get_text(label), get_text_spaced(value)) for label, value in items if label is not None and value is not None]
    links = [a for a in pattern(r"<a\b([^>]*)>").findall(head) if has_class(a, CLUB_LOGO_CLASS)]
    image, logo = _image_in(head, BRANDED_IMAGE_CLASS), _image_in(head, CLUB_LOGO_CLASS)
    name = None if image is None else (attr(image, "alt") or "").strip()
    info = get_text_spaced(next(iter(with_class(head, INFO_WRAPPER_CLASS, first=True)), ""))
    yield ([k for k, _ in items], [v for _, v in items], attr(image, "src"), name, attr(logo, "src"),
           attr(links[0], "href") if links else None, info)


def profile_facts(pages: DataFrame, key: str = "page_id", html: str = "html",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, profile MAP, player_image, full_name, team_logo, club_slug,
    jersey_number_profile).

    Images, logo, link and info text are looked for inside the first masthead only, each inside an
    element of its class; the detail items inside the first details section, or on the whole page
    where it has no such section."""
    from ..operators.stats import last_wins_map
    kept = [key, *keep]
    found = page_rows(pages, kept, html, _FACTS, read_profile)
    entries = F.transform(F.arrays_zip("_labels", "_values"), lambda e: F.struct(
        normalize_key(e["_labels"]).alias("k"), e["_values"].alias("v")))
    return found.select(
        *kept,
        last_wins_map(F.filter(entries, lambda e: (e["k"] != "") & (e["v"] != ""))).alias("profile"),
        "player_image", "full_name", "team_logo",
        F.nullif(F.regexp_extract(F.coalesce("_club", F.lit("")), r"/clubs/([^/]+)/", 1), F.lit("")).alias("club_slug"),
        F.nullif(F.regexp_extract("_info", r"#(\d+)", 1), F.lit("")).alias("jersey_number_profile"),
    )
