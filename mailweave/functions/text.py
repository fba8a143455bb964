"""Native text expressions: HTML to text, strip, address formatting, JSON repair.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen.  Python is used in one narrow place,
Arrow-batched and fed ``NULL`` for the rows that do not need it: full HTML
entity decoding (rows with an entity outside the native list).  JSON
validity (``json.loads`` semantics) lives with the repair step.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# HTML fallback conversion, applied in this order (case-insensitive, dot-all):
HTML_SCRIPT_STYLE = r"(?is)<(script|style).*?>.*?</\1>"   # -> ""
HTML_BREAK = r"(?is)<br\s*/?>"                            # -> "\n"
HTML_PARA_END = r"(?is)</p\s*>"                           # -> "\n\n"
HTML_TAG = r"(?is)<.*?>"                                  # -> ""
# Blocked-extraction markers: the first is case-sensitive, the second is
# matched on the lower-cased error text.
BLOCKED_MARKER = "data_inspection_failed"
BLOCKED_MARKER_LOWER = "inappropriate content"
# ---------------------------------------------------------------------------

# Entities decoded natively; "&amp;" must come last so "&amp;lt;" -> "&lt;".
_NATIVE_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"),
]
_NATIVE_NAMES = "|".join(e[0][1:-1] for e in _NATIVE_ENTITIES)
# any "&" that does not start one of the native entities needs html.unescape
_NEEDS_FULL_UNESCAPE = rf"&(?!(?:{_NATIVE_NAMES});)"

_WS_EDGES = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """``str.strip()``: Unicode whitespace at both ends (Spark trim is spaces only)."""
    return F.regexp_replace(c, _WS_EDGES, "")


@F.pandas_udf(T.StringType())
def _py_unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else _html.unescape(x))


def unescape(c: Column) -> Column:
    """``html.unescape``: native replaces, Python only for rows that need it."""
    return F.coalesce(_py_unescape(F.when(c.rlike(_NEEDS_FULL_UNESCAPE), c)), unescape_native(c))


# An anchor with a quoted or bare target: groups 1-3 are the target, 4 the content.
LINK_RE = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a\s*>"""


# Pieces of a page: comments and raw-text elements whole, tags, text, a stray "<".
HTML_TOKEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|noscript)\b.*?(?:</\1\s*>|\z)|</?[a-z](?:\"[^\"]*\"|'[^']*'|[^\"'>])*+>|<[/!?][^>]*>|[^<]++|<"
_NO_CONTENT = r"(?is)^<(?:!--|script\b|style\b|textarea\b|noscript\b)"
_ANCHOR_START, _ANCHOR_END = r"(?is)^<a(?=[\s>/])", r"(?is)^</a\s*>"
_HREF = r"""(?is)^<a\s(?:(?:"[^"]*"|'[^']*'|[^"'>])*?\s)??href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
ANCHORS = "array<struct<url:string,content:string>>"


def anchors(c: Column) -> Column:
    """The links of a page in order: target, and content with its own tags.

    The page is cut into tokens and folded: comments, scripts and the like hold
    no links; an anchor ends at its end tag, where the next anchor starts, or
    with the page, so one that is not closed swallows no other.
    """
    tokens = F.filter(F.regexp_extract_all(c, F.lit(HTML_TOKEN), F.lit(0)), lambda t: ~t.rlike(_NO_CONTENT))
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("url"), F.lit("").alias("content"), F.array().cast(ANCHORS).alias("found"))

    def closed(s: Column) -> Column:
        return F.when(s["url"].isNull(), s["found"]).otherwise(
            F.concat(s["found"], F.array(F.struct(s["url"].alias("url"), s["content"].alias("content")))))

    def step(s: Column, t: Column) -> Column:
        target = F.concat(*[F.regexp_extract(t, _HREF, g) for g in (1, 2, 3)])
        begins, ends = t.rlike(_ANCHOR_START), t.rlike(_ANCHOR_END)
        return (F.when(begins, F.struct(F.when(t.rlike(_HREF), target).alias("url"), F.lit("").alias("content"), closed(s).alias("found")))
                .when(ends, F.struct(none.alias("url"), F.lit("").alias("content"), closed(s).alias("found")))
                .when(s["url"].isNull(), s)
                .otherwise(F.struct(s["url"].alias("url"), F.concat(s["content"], t).alias("content"), s["found"].alias("found"))))
    return F.aggregate(tokens, start, step, closed)


def keep_links(c: Column) -> Column:
    """Anchors as ``[content](target)``; the content's own tags go later."""
    return F.regexp_replace(F.regexp_replace(c, HTML_SCRIPT_STYLE, ""), LINK_RE, r"[$4]($1$2$3)")


@F.pandas_udf(T.StringType())
def _py_fold_entities(s: pd.Series) -> pd.Series:
    import re
    native = {ch: ent for ent, ch in _NATIVE_ENTITIES if ch in "<>&\"'"}

    def one(m):
        ch = _html.unescape(m.group())
        return m.group() if ch == m.group() else "".join(native.get(x, x) for x in ch)
    return s.map(lambda x: None if x is None else re.sub(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?", one, x))


def fold_entities(c: Column) -> Column:
    """Entities outside the native list as their characters, markup characters
    as native entities: afterwards :func:`unescape_native` decodes all of them.
    Python sees only the rows that hold such an entity."""
    return F.coalesce(_py_fold_entities(F.when(c.rlike(_NEEDS_FULL_UNESCAPE), c)), c)


def unescape_native(c: Column) -> Column:
    for ent, ch in _NATIVE_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def html_tags_to_text(c: Column) -> Column:
    """The tag part of the HTML conversion, before entity decoding."""
    c = F.regexp_replace(c, HTML_SCRIPT_STYLE, "")
    c = F.regexp_replace(c, HTML_BREAK, "\n")
    c = F.regexp_replace(c, HTML_PARA_END, "\n\n")
    return F.regexp_replace(c, HTML_TAG, "")


def html_to_text(c: Column) -> Column:
    """HTML -> plain text: drop script/style, breaks and paragraphs to
    newlines, drop tags, decode entities, strip."""
    return strip(unescape(html_tags_to_text(c)))


# ---------------------------------------------------------------------------
# addresses
# ---------------------------------------------------------------------------
def format_addresses(c: Column) -> Column:
    """array<struct<name,addr>> -> ``Name <addr>`` strings, blanks dropped,
    duplicates dropped keeping the first occurrence."""
    def one(a: Column) -> Column:
        name, addr = a["name"], a["addr"]
        return (F.when(F.coalesce(addr, F.lit("")) != "",
                       F.when(F.coalesce(name, F.lit("")) != "", F.concat(name, F.lit(" <"), addr, F.lit(">")))
                       .otherwise(addr))
                .otherwise(F.coalesce(name, F.lit(""))))
    return F.array_distinct(F.filter(F.transform(c, one), lambda x: x != ""))


def address_of(c: Column) -> Column:
    """The bare e-mail address of ``Name <addr>`` (or the value itself)."""
    inner = F.regexp_extract(c, r"<([^<>]*)>\s*$", 1)
    return F.when(inner != "", inner).otherwise(c)


# ---------------------------------------------------------------------------
# JSON: validity and fence repair
# ---------------------------------------------------------------------------
def fence_slice(c: Column) -> Column:
    """From the first ``[`` to the last ``]``; NULL when there is none in order."""
    first = F.locate("[", c)                               # 1-based, 0 = absent
    last = F.length(c) - F.locate("]", F.reverse(c)) + 1   # 1-based position of last ']'
    ok = (first > 0) & (F.locate("]", F.reverse(c)) > 0) & (first < last)
    return F.when(ok, c.substr(first, last - first + 1))


def is_fenced(c: Column) -> Column:
    """Left-stripped text starts with three backticks."""
    return F.regexp_replace(c, r"(?U)^\s+", "").startswith("```")


# ---------------------------------------------------------------------------
# dates
# ---------------------------------------------------------------------------
def iso_date(fields: Column) -> Column:
    """[year, month, day, hour, minute, second, offset seconds] -> ISO 8601
    with offset; NULL when they are no point in time."""
    y, mo, d, h, mi, s, off = [F.get(fields, i) for i in range(7)]
    local = F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", y, mo, d, h, mi, s)
    size = F.abs(off)
    zone = F.concat(F.when(off < 0, F.lit("-")).otherwise(F.lit("+")),
                    F.format_string("%02d:%02d", F.floor(size / 3600), F.floor(size / 60) % 60),
                    F.when(size % 60 > 0, F.format_string(":%02d", size % 60)).otherwise(F.lit("")))
    known = F.try_to_timestamp(local, F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
    return F.when(fields.isNotNull() & known & (y > 0) & (size < 86400), F.concat(local, zone))
