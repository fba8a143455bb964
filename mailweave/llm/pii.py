"""Personal data by anchors: an Aho-Corasick pass finds at-signs, schemes,
digits, plus signs and identifier cues; small parsers expand each anchor to the
left and right, and validate what they find.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``.  The cues add
``userinfo`` (the credentials in a URL) and ``account`` (the identifier that
follows a cue such as "account" or "IBAN").  Positions are code points.
Texts are read whole; a null or empty text has no span.
"""

from __future__ import annotations

import hashlib
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "userinfo", "account")
#: words that announce an identifier, and those that announce a secret (in any case)
CUES = ("account", "acct", "iban", "passport", "ssn")
SECRETS = ("token", "password", "passwd", "api_key", "api key", "api-key", "apikey", "secret_key", "secret key")
#: words that may stand between a cue and its value
FILLERS = frozenset(("number", "no", "nr", "num", "id", "is", "key", "code", "value", "holder"))

DIGIT = frozenset("0123456789")
ALNUM = DIGIT | frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LABEL = ALNUM | {"-"}
LOCAL = ALNUM | frozenset("._%+-")
PHONE = DIGIT | frozenset(" ().-")
AUTHORITY_END = frozenset("/?#\"'<> \t\r\n")


@cache
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("@", ("at", 1))
    found.add_word("://", ("scheme", 3))
    for kind, words in (("cue", CUES), ("secret", SECRETS)):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign ``at`` that does not start before ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    n, end, dots = len(text), at + 1, 0
    while end < n and text[end] in LABEL:
        end += 1
    if start == at or end == at + 1:
        return None
    while end + 1 < n and text[end] == "." and text[end + 1] in LABEL:
        end += 2
        dots += 1
        while end < n and text[end] in LABEL:
            end += 1
    return (start, end) if dots else None


def digits_end(text: str, at: int) -> int:
    n = len(text)
    while at < n and text[at] in DIGIT:
        at += 1
    return at


def ip_from(text: str, start: int) -> tuple[int, bool] | None:
    """End and validity of the four dotted numbers that start a digit run."""
    n, at, valid = len(text), start, True
    for part in range(4):
        if part:
            if not (at + 1 < n and text[at] == "." and text[at + 1] in DIGIT):
                return None
            at += 1
        end = digits_end(text, at)
        number = text[at:end].lstrip("0")
        valid &= len(number) < 3 or (len(number) == 3 and number <= "255")
        at = end
    return at, valid


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def card_from(text: str, start: int) -> tuple[int, str]:
    """End and digits of the longest chain of digits with single separators."""
    n, at, out = len(text), start + 1, [text[start]]
    while at < n:
        step = 1 if text[at] in " -" and at + 1 < n else 0
        if text[at + step] not in DIGIT:
            break
        out.append(text[at + step])
        at += step + 1
    return at, "".join(out)


def phone_from(text: str, plus: int) -> tuple[int, int] | None:
    """End and number of digits of the number after a plus sign."""
    n = len(text)
    if plus + 1 >= n or text[plus + 1] not in DIGIT:
        return None
    end = plus + 2
    while end < n and text[end] in PHONE:
        end += 1
    while end > plus + 3 and text[end - 1] not in DIGIT:
        end -= 1
    if end <= plus + 3:
        return None
    return end, sum(c in DIGIT for c in text[plus:end])


def userinfo_from(text: str, scheme_end: int) -> tuple[int, int] | None:
    """The part of a URL's authority before its last at-sign."""
    n, end, at = len(text), scheme_end, -1
    while end < n and text[end] not in AUTHORITY_END:
        if text[end] == "@":
            at = end
        end += 1
    return (scheme_end, at) if at > scheme_end else None


def account_after(text: str, start: int, end: int, secret: bool = False) -> tuple[int, int] | None:
    """The value that follows the cue ``text[start:end]``, with separators and
    at most two filler words between them: at least six letters, digits, ``-``
    or ``_``.  An identifier has four digits or more; a secret has one or more
    and follows ``:``, ``=`` or "is"."""
    if start and text[start - 1] in ALNUM:
        return None
    n, at, fillers, told = len(text), end, 0, False
    while True:
        gap = at
        while at < n and at < gap + 6 and text[at] in " \t:=#\"'.":
            told |= text[at] in ":="
            at += 1
        stop = at
        while stop < n and (text[stop] in LABEL or text[stop] == "_"):
            stop += 1
        word = text[at:stop].lower()
        if at == gap or word not in FILLERS or fillers == 2:
            break
        told |= word == "is"
        fillers, at = fillers + 1, stop
    digits = sum(c in DIGIT for c in text[at:stop])
    enough = told and digits if secret else digits >= 4
    return (at, stop) if at > gap and stop - at >= 6 and enough else None


def folded(text: str) -> str:
    """``text`` in lower case, every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def find(text: str) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind number, end), by start, then kind."""
    out: list[tuple[int, int, int]] = []
    # where the next match of each kind may start; a match that fails its check is used up too
    email = ip = card = phone = 0
    for last, (kind, width) in anchors().iter(folded(text)):
        at = last - width + 1
        if kind == "digit":
            if at >= card:
                card_end, digits = card_from(text, at)
                if len(digits) > 1:
                    card = card_end
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((at, 2, card_end))
            if at >= ip and (at == 0 or text[at - 1] not in DIGIT):
                quad = ip_from(text, at)
                if quad:
                    ip = quad[0]
                    if quad[1]:
                        out.append((at, 1, ip))
        elif kind == "at":
            span = email_at(text, at, email)
            if span:
                email = span[1]
                out.append((span[0], 0, span[1]))
        elif kind == "plus":
            number = phone_from(text, at) if at >= phone else None
            if number:
                phone = number[0]
                if 9 <= number[1] <= 15:
                    out.append((at, 3, phone))
        elif kind == "scheme":
            span = userinfo_from(text, last + 1)
            if span:
                out.append((span[0], 4, span[1]))
        else:
            span = account_after(text, at, last + 1, kind == "secret")
            if span:
                out.append((span[0], 5, span[1]))
    return sorted(set(out))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; spans that
    overlap become one, named after the first."""
    out, done = [], 0
    at = 0
    while at < len(spans):
        start, kind, end = spans[at]
        at += 1
        while at < len(spans) and spans[at][0] < end:
            end = max(end, spans[at][2])
            at += 1
        out += [text[done:start], "[", KINDS[kind].upper(), "]"]
        done = end
    out.append(text[done:])
    return "".join(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> per row the counts and spans of personal data:
    ``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``.  One row
    per row, also for null or repeated ids; other columns are ignored."""
    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                rows = []
                for t in texts(b.column("text")):
                    spans = find(t)
                    base = [x for x in spans if x[1] < len(BASE)]
                    counts = [sum(k == kind for _, k, _ in base) for kind in range(len(BASE))]
                    rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
                cols = list(zip(*rows)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                     pa.array(cols[5], pa.string())],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced; a null or empty text
    stays as it is, repeated rows and all other columns too; an empty table
    gives an empty result."""
    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                k = b.schema.get_field_index("text")
                clean = [t if t is None else redact(t, find(t)) for t in b.column(k).to_pylist()]
                yield b.set_column(k, b.schema.field(k), pa.array(clean, b.schema.field(k).type))
    return docs.mapInArrow(run, docs.schema)
