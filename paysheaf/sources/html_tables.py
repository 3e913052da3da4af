"""HTML tables of captured pages -> one row per table row.

``table_rows`` emits neutral facts per ``<tr>`` — header texts and classes of its table,
cell texts and classes, the first player link with its name element and image.
Everything after that (which tables count, header -> field mapping, key prefixes,
cleaning) is column expressions in ``operators/rosters.py`` and ``operators/stats.py``.

A page is read once (``functions/html.py``): it is cleaned, its tables are cut by depth, then rows and
cells are pulled out with their positions. Cells and rows need no closing tags, attributes may be quoted in
any way and hold '>', classes are compared as tokens. A table inside a cell is a table of its own, with the
next number; to the outer table its rows and cells are no rows and cells, only text and links of the cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame

from ..functions.html import attr, attr_start, class_start, clean, closing, get_text, group, pattern, pieces_of, with_class
from .page_rows import page_rows

# Classes that mark the player-name element inside a player link (fixed values).
NAME_CLASSES = ("short-name", "mls-o-table__player-name")

# The tags of tables, as wholes, names and attributes: a cell ends at any of them, a row at a new row or body and at the ends below.
_PARTS = pattern(r"(<(/?(?:table|thead|tbody|tfoot|tr|td|th))\b([^>]*)>)")
_ROW_ENDS = frozenset(("tr", "tbody", "/tr", "/tbody", "/thead", "/table"))
_LINK = r"[^>]*)>(.*?)(?=</a\b|<a\b|\Z)"
_PLAYER = attr_start("href", "/players/")
# The first player link of a row, by the kind that is asked for.
_LINKS = {"any": pattern(rf"<a\b((?=(?:{_PLAYER}|{class_start('mls-o-table__href')})){_LINK}"), "players": pattern(rf"<a\b((?={_PLAYER}){_LINK}")}
_NAMES = "|".join(NAME_CLASSES)
_ANY_NAME = pattern(_NAMES)
# A name element up to its end tag.
_NAME = pattern(rf"<([a-z][a-z0-9]*)\b{class_start(_NAMES)}[^>]*>(.*?)</\1\s*>")
_IMAGE = pattern(r"<img\b([^>]*)>")
_TABLE = pattern(r"<table\b([^>]*)>")
_TABLE_START = pattern(r"<table\b")
_STRUCTURE = r"</?(?:table|caption|colgroup|col|thead|tbody|tfoot|tr|td|th)\b[^>]*>"
_FACTS = ("table_no int, table_class string, has_tbody boolean, row_no int, in_tbody boolean, headers array<string>, "
          "header_classes array<string>, cells array<string>, cell_classes array<string>, link_href string, link_class string, "
          "link_text string, name_text string, thumb string")


def tables(html: str) -> list[str]:
    """The markup of every table, in order of their start; of the tables inside it only what is not
    table markup stays."""
    ps, ds = pieces_of(html, "table")
    out = []
    for i, piece in enumerate(ps):
        if _TABLE_START.match(piece):
            end = closing(ds, i)
            inside = [pattern(r"^</[^>]*>" if ds[j] == ds[i] else _STRUCTURE).sub("<i>", ps[j]) for j in range(i + 1, end)]
            out.append("".join([piece, *inside]) if inside else piece)
    return out


def _player_link(row: str, link: str) -> tuple[str | None, str | None]:
    """Attributes and inner HTML of the first player link of a row (None when there is none)."""
    found = _LINKS[link].search(row) if "<a" in row or "<A" in row else None
    return (found[1], found[2]) if found and found[1] else (None, None)


def _name_text(inner: str | None) -> str | None:
    """Text of the first element of a link that has a name class (None when there is none)."""
    if inner is None or not _ANY_NAME.search(inner):
        return None
    # Text alone up to the end tag is the whole element. Markup inside, or no end tag, is followed by depth.
    simple = group(_NAME.search(inner), 2)
    if simple and "<" not in simple:
        return get_text(simple)
    found = with_class(inner, _NAMES, first=True) if any(n in inner for n in NAME_CLASSES) else []
    return get_text(found[0]) if found else None


@lru_cache(maxsize=1024)
def _class(attrs: str) -> str:
    """Class attribute of a cell ('' without one); tables repeat the same few."""
    return attr(attrs, "class") or ""


def read_tables(html: str | None, link: str) -> Iterator[tuple]:
    """The facts of every row with at least one ``<td>``."""
    if html is None:
        return
    for table_no, markup in enumerate(tables(clean(html))):
        parts = _PARTS.split(markup)
        names = [*map(str.lower, parts[2::4])]
        # A text without markup or entities only needs its blanks cut off.
        texts = [t.strip() if "<" not in t and "&" not in t else get_text(t) for t in parts[4::4]]
        headers, header_classes, rows, cells, has_tbody, inside = [], [], [], None, False, False
        for k, name in enumerate(names):
            if name == "td":
                if cells is not None:
                    cells.append(texts[k])
                    classes.append(_class(parts[4 * k + 3]))
            elif name == "th":
                headers.append(texts[k])
                header_classes.append(_class(parts[4 * k + 3]))
            elif name in _ROW_ENDS:
                if cells is not None:
                    rows[-1][1], cells = k, None
                if name == "tr":
                    cells, classes = [], []
                    rows.append([k, len(names), inside, cells, classes])
                elif name == "tbody" and not has_tbody:  # the rows of the first body, up to its end tag
                    has_tbody = inside = True
                elif name == "/tbody" and has_tbody:
                    inside = False
        table_class = _class(group(_TABLE.match(markup)))
        for row_no, (start, end, in_tbody, cells, classes) in enumerate(rows):
            if cells:
                attrs, inner = _player_link("".join(chain.from_iterable(zip(parts[4 * start + 1:4 * end:4], parts[4 * start + 4:4 * end + 1:4]))), link)
                href = attr(attrs, "href") if attrs else None
                image = attr(group(_IMAGE.search(inner)), "src") if inner else None
                yield (table_no, table_class, has_tbody, row_no, in_tbody, headers, header_classes, cells, classes,
                       href, attr(attrs, "class"), get_text(inner), _name_text(inner), image or None)


def table_rows(pages: DataFrame, key: str = "page_id", html: str = "html",
               keep: tuple[str, ...] = (), link: str = "any") -> DataFrame:
    """(page_id, table_no, table_class, has_tbody, row_no, in_tbody, headers, header_classes,
    cells, cell_classes, link_href, link_class, link_text, name_text, thumb, *keep) for
    every ``<tr>`` with at least one ``<td>``. ``keep`` page columns (team, season, ...) are
    carried along, so no join back to the pages is needed. ``link`` tells which anchor of a row is
    its player link: "any" the first with a player address or the table-link class, "players" the
    first with a player address."""
    src = pages.select(pages[key].cast("long").alias("page_id"), *[pages[k] for k in keep], pages[html].alias("_html"))
    found = page_rows(src, ["page_id", *keep], "_html", _FACTS, lambda page: read_tables(page, link))
    out = found.select("page_id", *[f.name for f in found.schema.fields[1 + len(keep):]], *keep)
    return out if key == "page_id" else out.withColumnRenamed("page_id", key)
