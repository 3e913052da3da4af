"""Row-local cleaners as Column -> Column expressions (JVM side, whole-stage codegen).

No Python UDF: every function composes built-in Spark SQL functions, so the cleaners
run inside the scan's codegen stage and also work on streaming frames.

Whitespace follows Python's ``str.strip``/``str.split`` (tabs, newlines, NBSP and other
Unicode spaces), not Spark's ``trim`` which removes only the space character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

# Unicode whitespace as Python sees it (Java's (?U)\s plus the four separator controls).
WS_CLASS = r"[\s\x1c-\x1f]"
WS_RUN = r"(?U)" + WS_CLASS + "+"
# A plain decimal number: optional sign, digits with optional fraction, or a bare fraction.
_NUMBER = r"(?U)^" + WS_CLASS + r"*[+-]?(\d+\.?\d*|\.\d+)" + WS_CLASS + r"*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's whitespace characters (fixed values: what str.strip() removes).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once (bound as a lambda variable), however often ``use`` names it:
    an expression named inside a lambda is otherwise computed for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace (Python ``str.strip``); a character-set trim,
    no regular expression."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def blank(c: Column | str) -> Column:
    """True for NULL or the empty string (Python falsiness of a str)."""
    c = _c(c)
    return c.isNull() | (c == "")


def clean_money(c: Column | str) -> Column:
    """Money text -> DECIMAL(18,2): '$' and ',' removed, surrounding whitespace ignored.

    NULL for empty input and for anything that is not a plain decimal number after the
    removal ('-', '1.2.3', 'n/a'). Exponents, 'nan', 'inf' and digit underscores are
    rejected too, and values with more than two decimals are rounded to cents.
    """
    c = _c(c)
    cleaned = F.regexp_replace(strip(c), r"[$,]", "")
    ok = ~blank(c) & cleaned.rlike(_NUMBER)
    return F.when(ok, strip(cleaned).try_cast(MONEY))


def clean_code(c: Column | str) -> Column:
    """Position code: stripped, upper case; '' for NULL or empty."""
    return F.coalesce(F.upper(strip(c)), F.lit(""))


def clean_name(c: Column | str) -> Column:
    """Name: stripped, then double quotes and then single quotes removed at both ends;
    '' for NULL or empty."""
    return F.coalesce(F.btrim(F.btrim(strip(c), F.lit('"')), F.lit("'")), F.lit(""))


def collapse_ws(c: Column | str) -> Column:
    """Whitespace runs -> one space, stripped; '' for NULL or empty."""
    return F.coalesce(strip(F.regexp_replace(_c(c), WS_RUN, " ")), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    """``collapse_ws`` with a blank result turned into NULL."""
    return F.nullif(collapse_ws(c), F.lit(""))


def strip_or_null(c: Column | str) -> Column:
    """Stripped value, inner whitespace kept; blank -> NULL (stat cells)."""
    return F.nullif(strip(c), F.lit(""))


def first_digits(c: Column | str) -> Column:
    """First run of digits as a string, NULL when there is none."""
    return F.nullif(F.regexp_extract(_c(c), r"(?U)(\d+)", 1), F.lit(""))


def strip_if_set(c: Column | str) -> Column:
    """NULL for NULL/empty input, else the stripped value (which may be '')."""
    c = _c(c)
    return F.when(~blank(c), strip(c))


def normalize_key(c: Column | str) -> Column:
    """Label -> key: lower case, punctuation removed, stripped, whitespace runs -> '_'.

    ``\\w`` is Unicode-aware here, so letters such as 'ö' or 'ß' are kept."""
    no_punct = F.regexp_replace(F.lower(_c(c)), r"(?U)[^\w\s]", "")
    return F.regexp_replace(strip(no_punct), WS_RUN, "_")


def prefer_nonblank(a: Column | str, b: Column | str) -> Column:
    """``a`` unless it is NULL or empty, else ``b``."""
    return F.coalesce(F.nullif(_c(a), F.lit("")), _c(b))


def is_money_token(t: Column) -> Column:
    """Token holds a '$', or is at least four ASCII digits once ',' and '.' are removed."""
    return t.contains("$") | F.regexp_replace(t, r"[,.]", "").rlike(r"^[0-9]{4,}$")


def money_positions(tokens: Column | str) -> Column:
    """0-based positions of the money-looking tokens, in order."""
    idx = F.transform(_c(tokens), lambda x, i: F.when(is_money_token(x), i))
    return F.filter(idx, lambda i: i.isNotNull())


def looks_like_code(t: Column | str) -> Column:
    """One to four letters once '-' and '/' are removed (position codes such as M, M-F, D/M)."""
    t = _c(t)
    return F.coalesce(F.translate(t, "-/", "").rlike(r"^\p{L}{1,4}$"), F.lit(False))


def join_tokens(tokens: Column, start: Column | int, length: Column | int) -> Column:
    """Space-join of ``length`` tokens starting at 0-based ``start`` ('' when none)."""
    start_c = start if isinstance(start, Column) else F.lit(start)
    length_c = length if isinstance(length, Column) else F.lit(length)
    return F.array_join(F.slice(tokens, start_c + 1, F.greatest(length_c, F.lit(0))), " ")


def split_name_parts(names: Column, last_first: Column) -> tuple[Column, Column]:
    """Name tokens -> (first_name, last_name), both cleaned with ``clean_name``.

    No token: both ''. One token: it is the last name. More: the single-token end is the
    first token; ``last_first`` says whether that is the last name (else the first name).
    """
    n = F.size(names)
    head = clean_name(F.get(names, 0))
    rest = clean_name(join_tokens(names, 1, n - 1))
    first = (F.when(n <= 1, F.lit("")).when(last_first, rest).otherwise(head))
    last = (F.when(n == 0, F.lit("")).when(n == 1, head)
            .when(last_first, head).otherwise(rest))
    return first, last


def split_names(names: Column, last_first: Column) -> Column:
    """``split_name_parts`` as struct(first_name, last_name)."""
    first, last = split_name_parts(names, last_first)
    return F.struct(first.alias("first_name"), last.alias("last_name"))


def map_prefix_select(m: Column, prefix: str) -> Column:
    """Entries whose key starts with ``prefix`` and whose value is set; prefix cut from the
    key and the value cleaned with ``blank_to_null``."""
    kept = F.map_filter(m, lambda k, v: k.startswith(prefix) & ~blank(v))
    renamed = F.transform_keys(kept, lambda k, v: F.substring(k, len(prefix) + 1, 1 << 30))
    return F.transform_values(renamed, lambda k, v: blank_to_null(v))
