"""Provider metadata text (size, thread id, labels) as native columns (#2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Fixed patterns of the metadata text.
SIZE_RE = r"RFC822\.SIZE\s+(\d+)"
THREAD_RE = r"X-GM-THRID\s+(\d+)"
LABELS_RE = r"(?s)X-GM-LABELS\s+\((.*?)\)"

# A token of a label group is a run of pieces: plain characters, an escaped
# character, a double-quoted or a single-quoted stretch.  All quantifiers are
# possessive, so a group of any length is matched without recursion.
PLAIN = r"[^ \t\r\n\"'\\]++"
PIECE = rf"""(?:{PLAIN}|\\[\s\S]|"(?:[^"\\]++|\\[\s\S])*+"|'[^']*+')"""
WELL_FORMED = rf"\A(?:[ \t\r\n]++|{PIECE})*+\z"


def _unquote(piece: Column) -> Column:
    inner = piece.substr(F.lit(2), F.length(piece) - 2)
    return (F.when(piece.startswith('"'), F.regexp_replace(inner, r'\\(["\\])', "$1"))
            .when(piece.startswith("'"), inner)
            .when(piece.startswith("\\"), piece.substr(F.lit(2), F.length(piece)))
            .otherwise(piece))


def label_tokens(content: Column) -> Column:
    """Tokens of a label group: white space separates, quotes group and are
    removed, a backslash escapes (within double quotes only a quote or another
    backslash); empty tokens are dropped.  A group with an open quote or a
    trailing backslash is cut at white space, quotes at the ends of the pieces
    removed."""
    pieces = F.transform(
        F.regexp_extract_all(content, F.lit(f"({PIECE}++)"), F.lit(1)),
        lambda token: F.array_join(F.transform(F.regexp_extract_all(token, F.lit(f"({PIECE})"), F.lit(1)), _unquote), ""))
    plain = F.transform(F.filter(F.split(content, r"(?U)\s+"), lambda t: t != ""),
                        lambda t: F.regexp_replace(t, "^[\"']+|[\"']+$", ""))
    return F.when(content.rlike(WELL_FORMED), F.filter(pieces, lambda t: t != "")).otherwise(plain)


def provider_meta(meta: Column) -> Column:
    """struct<size bigint, thread_id string, labels array<string>>; each NULL
    when absent; labels NULL also when the group is empty."""
    size = F.regexp_extract(meta, SIZE_RE, 1)
    thr = F.regexp_extract(meta, THREAD_RE, 1)
    has = meta.rlike(LABELS_RE)
    content = strip(F.regexp_extract(meta, LABELS_RE, 1))
    labels = F.when(has & (content != ""), label_tokens(content))
    return F.struct(
        F.when(size != "", size.try_cast("bigint")).alias("size"),
        F.when(thr != "", thr).alias("thread_id"),
        labels.alias("labels"),
    )
