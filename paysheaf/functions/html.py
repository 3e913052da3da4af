"""Reading one HTML page: functions of a text, run for each page inside Spark tasks (``sources/page_rows.py``).

``clean`` brings a page into a form that plain patterns read exactly, once per page: comments and scripts
go, every entity becomes its character (the five that matter to markup stay escaped), and '<' and '>' inside
attribute values are escaped, so that a tag ends at the first '>'. Everything else here expects cleaned
markup. Elements that nest are followed by depth: an element ends at the end tag that brings the depth of
its name below its own, or with the page.
"""

from __future__ import annotations

import re
from functools import cache
from html.entities import html5

# A tag up to its end, quoted values included.
_TAG = r"""</?[A-Za-z](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>"""
# A tag with nothing to escape: no '<' or '>' inside. A tag that is not such a one, as a pattern of its own, spares a call for each plain tag.
_PLAIN_TAG = r"""</?[A-Za-z](?:[^<>=]++|=\s*+(?:"[^"<>]*+"|'[^'<>]*+')|=(?!\s*+(?:"[^"]*+"|'[^']*+')))*+>"""
_ODD_TAG = rf"(?!{_PLAIN_TAG}){_TAG}"
# The value of an attribute, with its quotes.
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Any attributes before the one that is looked for.
_BEFORE = r"""(?:[\s/]*+[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*?[\s/]*+"""
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"))


@cache
def pattern(text: str) -> re.Pattern:
    """A compiled pattern; classes and case are those of ASCII, '.' is any character."""
    return re.compile(text, re.ASCII | re.IGNORECASE | re.DOTALL)


def group(found: re.Match | None, k: int = 1) -> str:
    """A group of a match, '' where nothing was found."""
    return (found[k] or "") if found else ""


def escape(text: str) -> str:
    for char, name in _ESCAPES:
        text = text.replace(char, name)
    return text


def unescape(text: str) -> str:
    """The five entities that ``clean`` leaves, as characters."""
    if "&" in text:
        for char, name in (*_ESCAPES[1:], _ESCAPES[0]):
            text = text.replace(name, char)
    return text


def _entity(found: re.Match) -> str:
    """An entity as its character, escaped; unknown ones stay as they are."""
    dec, hexa, name = found.groups()
    if name:
        char = " " if name == "nbsp" else html5.get(name + ";")
    else:
        code = int(dec) if dec else int(hexa, 16) if hexa else 0
        char = chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else None
    return found[0] if char is None else escape(char)


def _inner_escaped(found: re.Match) -> str:
    return "<" + found[0][1:-1].replace("<", "&lt;").replace(">", "&gt;") + ">"


def clean(html: str) -> str:
    """The page without comments, scripts, styles and templates, entities decoded, tags ending at the first '>'."""
    html = html.replace("\x01", " ").replace("\x02", " ").replace("\x03", " ")
    if pattern(r"<(?:!--|script|style|template)").search(html):
        html = pattern(r"<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>").sub("", html)
    if pattern(r"&(?!(?-i:amp|lt|gt|quot|#39);)[A-Za-z#]").search(html):
        html = pattern(r"&(?:#([0-9]{1,7})|#[xX]([0-9a-fA-F]{1,6})|([A-Za-z][A-Za-z0-9]*)(?=;));?").sub(_entity, html)
    if pattern(r"""=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])""").search(html):
        html = pattern(_ODD_TAG).sub(_inner_escaped, html)
    return html


def _unquoted(value: str) -> str:
    value = value[1:] if value[:1] in ('"', "'") else value
    return value[:-1] if value[-1:] in ('"', "'") else value


def attr(attrs: str | None, name: str) -> str | None:
    """Value of one attribute in a tag's attribute string (None when absent or without a value). Text
    inside the values of other attributes is never taken for an attribute."""
    if not attrs or name not in attrs.lower():
        return None
    if plain := pattern(rf'\s*{name}="([^"]*)"').match(attrs):  # the first attribute, as most pages write it
        return unescape(plain[1])
    found = group(pattern(rf"^{_BEFORE}{name}\s*+=\s*+{_VALUE}").search(attrs))
    return unescape(_unquoted(found)) if found else None


def get_text(inner: str | None) -> str | None:
    """Text of an element: every text piece between tags decoded and stripped, blanks
    dropped, the rest joined without separator."""
    if inner is None or "<" not in inner:
        return None if inner is None else unescape(inner).strip() if "&" in inner else inner.strip()
    pieces = pattern(r"<[^>]*>").split(inner)
    return "".join([unescape(p).strip() for p in pieces] if "&" in inner else map(str.strip, pieces))


def get_text_spaced(inner: str) -> str:
    """Text pieces decoded, stripped, blanks dropped, joined with one space."""
    pieces = [unescape(p).strip() for p in pattern(r"<[^>]*>").split(inner)]
    return " ".join([p for p in pieces if p])


def has_class(attrs: str, token: str) -> bool:
    """Whether the class attribute holds the token as a whole word between blanks."""
    return token in pattern(r"\s+").split(attr(attrs, "class") or "")


def pieces_of(html: str, tag: str) -> tuple[list[str], list[int]]:
    """The page split at the tags of one name, and the depth behind the tag that each piece starts with."""
    cuts = [0, *[m.start() for m in pattern(rf"</?{tag}\b").finditer(html) if m.start()], len(html)]
    pieces, depths, depth = [html[a:b] for a, b in zip(cuts, cuts[1:])], [], 0
    opens, closes = f"<{tag.lower()}", f"</{tag.lower()}"
    for p in pieces:
        low = p[:24].lower()
        depth = max(0, depth + (-1 if low.startswith(closes) else 1 if low.startswith(opens) else 0))
        depths.append(depth)
    return pieces, depths


def closing(depths: list[int], at: int) -> int:
    """Index of the piece that closes the element opened by the piece ``at`` (the number of pieces if none)."""
    return next((j for j in range(at + 1, len(depths)) if depths[j] < depths[at]), len(depths))


def _inner(pieces: list[str], depths: list[int], at: int) -> str:
    return pattern(r"^<[^>]*>").sub("", "".join(pieces[at:closing(depths, at)]))


def elements(html: str, tag: str, token: str) -> list[str]:
    """Inner HTML of the ``tag`` elements with class ``token``, in order. Nested elements
    of the same tag are followed by depth; an element that is never closed ends with the page."""
    ps, ds = pieces_of(html, tag)
    own = pattern(rf"^<{tag}\b(?:([^>]*)>)?")
    return [_inner(ps, ds, i) for i, p in enumerate(ps) if (m := own.search(p)) and has_class(group(m), token)]


def first_element(html: str, tag: str) -> str | None:
    """Inner HTML of the first ``tag`` element (None when there is none)."""
    ps, ds = pieces_of(html, tag)
    at = next((i for i, p in enumerate(ps) if pattern(rf"^<{tag}\b").search(p)), None) if len(ps) > 1 else None
    return None if at is None else _inner(ps, ds, at)


def class_start(tokens: str) -> str:
    """Pattern of the rest of a start tag, behind its name, up to a class attribute that holds a token."""
    value = rf"""(?:"(?:[^"]*\s)?(?:{tokens})(?:\s[^"]*)?"|'(?:[^']*\s)?(?:{tokens})(?:\s[^']*)?'|(?:{tokens})(?=[\s/>]))"""
    return _BEFORE + r"class\s*+=\s*+" + value


def attr_start(name: str, inside: str) -> str:
    """Pattern of the rest of a start tag, behind its name, up to an attribute whose value holds ``inside``."""
    value = rf"""(?:"[^"]*{inside}[^"]*"|'[^']*{inside}[^']*'|[^\s"'>]*{inside}[^\s"'>]*)"""
    return _BEFORE + name + r"\s*+=\s*+" + value


def with_class(html: str, tokens: str, first: bool = False) -> list[str]:
    """Inner HTML of the elements, whatever their tag, whose class attribute holds a token
    (alternatives separated by '|'), in order; void elements have none. ``first``: only of the first one."""
    out = []
    for found in pattern(rf"(?=<([a-z][a-z0-9]*)\b{class_start(tokens)})").finditer(html):
        name, depth, end = found[1], 0, len(html)
        if name.lower() in VOID:
            out.append("")
        else:
            for tag in pattern(rf"</?{name}\b").finditer(html, found.start()):
                depth += -1 if tag[0][1] == "/" else 1
                if depth == 0:
                    end = tag.start()
                    break
            out.append(pattern(r"^<[^>]*>").sub("", html[found.start():end]))
        if first:
            break
    return out


def anchors(html: str) -> list[tuple[str, str]]:
    """(href, text) of the <a href> elements, in order; tags in the text become blanks."""
    out = []
    for attrs, inner in pattern(r"<a\b([^>]*)>(.*?)(?=</a\b|<a\b|\Z)").findall(html):
        href = attr(attrs, "href")
        if href is not None:
            out.append((href, unescape(pattern(r"<[^>]*>").sub(" ", inner))))
    return out
