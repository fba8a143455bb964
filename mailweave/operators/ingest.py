"""Ingest stage: raw messages -> documents, as DataFrame transformations.

Plan shape of one round (``streaming.rounds.ingest_round``)::

    raw --dedupe by key (keys-only count)--> [--high_water_filter (broadcast marks)-->]
        --insert_valid_if_absent (anti-join on the stored keys of the batch, found
          before from key columns: the archive's cut to the batch's uid ranges)-->
        --dealt evenly to all tasks by key-->
        --parse_messages (mapInArrow, map-only; invalid records flagged)-->
        to_documents (native columns)

The anti-join is placed *before* the Python stage on purpose: a Python
stage is opaque to Catalyst, so filters on its output are never pushed
below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mime, text
from ..schemas import KEYS, PARSED
from .joins import anti_join, anti_join_recent, bounded_broadcast, within_ranges

RAW_COLS = ["account", "mailbox", "uid", "raw", "size", "labels", "thread_id"]


# ---------------------------------------------------------------------------
# scan normalisation and validity (#1, #12)
# ---------------------------------------------------------------------------
def normalize_records(raw: DataFrame) -> DataFrame:
    """Record shape of a fetch: size falls back to the byte length of ``raw``
    when missing or zero, thread id is a string, labels a list or NULL."""
    return raw.select(
        "account", "mailbox", F.col("uid").cast("bigint").alias("uid"), "raw",
        F.when(F.coalesce(F.col("size"), F.lit(0)) == 0, F.octet_length("raw"))
        .otherwise(F.col("size")).cast("bigint").alias("size"),
        F.col("labels").cast("array<string>").alias("labels"),
        F.col("thread_id").cast("string").alias("thread_id"),
    )


def is_valid(df: DataFrame) -> Column:
    return (F.coalesce(F.col("uid"), F.lit(0)) != 0) & (F.coalesce(F.octet_length("raw"), F.lit(0)) > 0)


def valid_records(raw: DataFrame) -> DataFrame:
    """Drop records with uid 0 / NULL or an empty body."""
    return raw.where(is_valid(raw))


def invalid_records(raw: DataFrame) -> DataFrame:
    """The complement of :func:`valid_records`, in ``failures`` shape."""
    return raw.where(~is_valid(raw)).select(
        "account", "mailbox", "uid", F.lit("ingest").alias("stage"),
        F.lit(mime.INVALID_RECORD).alias("error"))


# ---------------------------------------------------------------------------
# incremental selection (#10, #11, #4, #5)
# ---------------------------------------------------------------------------
#: mailboxes whose marks are written into the scan's filter; more are joined
MAX_LITERAL_MARKS = 200


def above_marks(marks: dict[tuple[str, str], int]) -> Column:
    """``uid > mark`` per mailbox as one predicate of literals, which Parquet
    scans evaluate on their statistics; unknown mailboxes have the mark 0."""
    uid, least = F.col("uid"), min(marks.values(), default=0)
    here = [((F.col("account").eqNullSafe(F.lit(a))) & (F.col("mailbox").eqNullSafe(F.lit(m))), mark) for (a, m), mark in marks.items()]
    other = uid > 0
    above = F.lit(False)
    for same, mark in here:
        other = other & ~same
        above = above | (same & (uid > mark))
    # the first part holds for every row that the second lets through, and prunes by itself
    return (uid > min(least, 0)) & (above | other)


def high_water_filter(df: DataFrame, state: DataFrame | dict[tuple[str, str], int] | None, reset: bool = False) -> DataFrame:
    """Rows with ``uid > last_uid`` of their mailbox; unknown mailbox -> 0.

    Marks given as a dict become literal ranges inside the scan
    (``PushedFilters``), so files and row groups below the marks are not read.
    A state table has one row per mailbox and is joined; the planner chooses
    how, and no job runs while the plan is built.
    """
    if reset or state is None:
        return df.where(F.col("uid") > 0)
    if isinstance(state, dict):
        return df.where(above_marks(state))
    marks = state.select("account", "mailbox", F.col("last_uid").cast("bigint").alias("_mark"))
    return (df.join(marks, ["account", "mailbox"], "left")
            .where(F.col("uid") > F.coalesce(F.col("_mark"), F.lit(0)))
            .drop("_mark"))


def insert_if_absent(new: DataFrame, existing: DataFrame, state: DataFrame | None = None,
                     probe: DataFrame | None = None) -> DataFrame:
    """New rows whose key is not stored yet (an existing key is skipped).

    Only the key columns of ``existing`` are read, and only the rows inside
    the per-mailbox uid range of the new rows (``probe``: any superset of
    the new keys that is cheap to read, e.g. the batch's keys before the
    validity filter; default ``new``).  When the high-water ``state`` is
    given, ``existing`` is also cut to its tail above the mark.  The
    anti-join therefore shuffles the recent tail, not the whole archive.
    """
    ex = existing.select(*KEYS)
    if state is not None:
        ex = high_water_filter(ex, state)
    return anti_join_recent(new, ex, KEYS, probe)


def stored_keys(existing: DataFrame, probe: DataFrame, *also: str) -> DataFrame:
    """The keys of ``existing`` (and columns ``also``) that are among those of
    ``probe``; only these columns are read and exchanged."""
    return within_ranges(existing.select(*KEYS, *also), probe).join(probe.select(*KEYS), KEYS, "left_semi")


def insert_valid_if_absent(new: DataFrame, stored: DataFrame) -> DataFrame:
    """:func:`insert_if_absent` that lets invalid records through, whatever is
    stored: each of them is a failure of its own.  ``stored`` are the
    :func:`stored_keys` of the batch: none as a rule, and few otherwise, so
    that the raw messages stay where they are."""
    ex = bounded_broadcast(stored.select(*KEYS, F.lit(True).alias("_valid")))
    return new.withColumn("_valid", is_valid(new)).join(ex, [*KEYS, "_valid"], "left_anti").drop("_valid")


def replace_all(new: DataFrame, existing: DataFrame) -> DataFrame:
    """``--redownload-all``: new rows win, untouched existing rows stay."""
    return new.unionByName(anti_join(existing, new, KEYS), allowMissingColumns=True)


# ---------------------------------------------------------------------------
# the Python stage (#25) and its native continuation (#26-#29, #13)
# ---------------------------------------------------------------------------
def _parse_headers(batches):
    return mime.parse_batches(batches, with_payload=False)


def parse_messages(raw: DataFrame, with_payload: bool = True) -> DataFrame:
    """Raw bytes -> header columns + leaf ``parts``; map-only, errors per row.
    ``with_payload=False`` for readers of headers and attachment names only:
    no body is decoded or shipped back."""
    parsed = raw.select(*RAW_COLS).mapInArrow(mime.parse_batches if with_payload else _parse_headers, PARSED)
    return parsed.withColumn("date_fields", text.iso_date(F.col("date_fields"))).withColumnRenamed("date_fields", "date_iso")


def is_attachment(p: Column) -> Column:
    """Disposition ``attachment``, or ``inline`` with a file name; the test
    does not apply to a single-part message (part 0)."""
    disp = F.coalesce(p["disposition"], F.lit(""))
    return (p["part_no"] > 0) & ((disp == "attachment") | ((disp == "inline") & p["filename"].isNotNull()))


def _text_parts(parts: Column, ctype: str) -> Column:
    return F.filter(parts, lambda p: ~is_attachment(p) & (p["ctype"] == ctype) & p["payload"].isNotNull())


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: p["payload"]), "\n\n")


def html_source(parts: Column) -> Column:
    """All inline HTML payloads, joined; NULL when there is none."""
    h = _text_parts(parts, "text/html")
    return F.when(F.size(h) > 0, _joined(h))


def attachment_names(parts: Column) -> Column:
    """Decoded file names of attachment parts in part order; unnamed ones are
    excluded from the body but not listed."""
    return F.transform(F.filter(parts, lambda p: is_attachment(p) & p["filename"].isNotNull()),
                       lambda p: p["filename"])


def local_minute(date_iso: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` wall-clock time of the sender's own offset."""
    return F.when(F.length(date_iso) >= 16,
                  F.concat(F.substring(date_iso, 1, 10), F.lit(" "), F.substring(date_iso, 12, 5)))


def to_documents(parsed: DataFrame, keep_html: bool = False, html_converter=None,
                 skip_empty_plain: bool = False) -> DataFrame:
    """``documents_md`` rows from parsed messages (failed parses excluded).

    By default an empty text/plain part still wins over HTML (the reference
    behaviour); ``skip_empty_plain=True`` lets HTML win when the joined
    plain text is empty after stripping.

    Two projections: the first computes every native column and the HTML
    text with its tags removed; the second decodes entities and strips.  The
    split keeps Spark from evaluating the regex chain twice around the
    (rarely used) Python entity decoder.  A custom ``html_converter`` is
    applied in one step instead.
    """
    ok = parsed.where(F.col("parse_error").isNull())
    parts = F.col("parts")
    plain = _text_parts(parts, "text/plain")
    html = _text_parts(parts, "text/html")
    html_joined = text.strip(_joined(html))
    first = [
        "account", "mailbox", "uid",
        F.coalesce("message_id", F.lit("")).alias("message_id"),
        F.coalesce("subject", F.lit("")).alias("subject"),
        "date_iso",
        F.try_to_timestamp(F.col("date_iso")).alias("date_ts"),
        F.coalesce(F.try_element_at(text.format_addresses(F.col("from_list")), F.lit(1)), F.lit("")).alias("from_addr"),
        text.format_addresses(F.col("to_list")).alias("to"),
        text.format_addresses(F.col("cc_list")).alias("cc"),
        "size", "labels", "thread_id",
        (F.when((F.size(plain) > 0) & (text.strip(_joined(plain)) != ""), text.strip(_joined(plain)))
         if skip_empty_plain else F.when(F.size(plain) > 0, text.strip(_joined(plain)))).alias("_plain"),
        F.when(F.size(html) > 0, html_joined if html_converter else text.html_tags_to_text(text.keep_links(html_joined)))
        .alias("_html"),
        attachment_names(parts).alias("attachments"),
    ]
    if keep_html:
        first.append(html_source(parts).alias("html"))
    stage = ok.select(*first)
    conv = html_converter(F.col("_html")) if html_converter else text.strip(text.unescape(F.col("_html")))
    body = F.coalesce(F.col("_plain"), conv, F.lit(""))
    cols = [c for c in stage.columns if c not in ("_plain", "_html")]
    at = cols.index("attachments")
    return stage.select(*cols[:at], body.alias("body"), *cols[at:])


def parse_failures(parsed: DataFrame) -> DataFrame:
    """Failure rows of the parse stage; records that were invalid on arrival
    (uid 0, empty message) are reported as ingest failures."""
    invalid = F.col("parse_error") == mime.INVALID_RECORD
    return parsed.where(F.col("parse_error").isNotNull()).select(
        "account", "mailbox", "uid", F.when(invalid, F.lit("ingest")).otherwise(F.lit("parse")).alias("stage"),
        F.col("parse_error").alias("error"))


# ---------------------------------------------------------------------------
# default extractor (#36) and item defaults (#17)
# ---------------------------------------------------------------------------
def rule_item_array(html: Column, date_iso: Column, from_addr: Column) -> Column:
    """The rule extractor's items of one message as an array: one element per
    link (not those in comments or scripts), in document order; title = link text (tags removed, entities decoded,
    stripped), url = decoded target, date and sender of the message."""
    found = text.anchors(text.fold_entities(F.coalesce(html, F.lit(""))))
    d, s = local_minute(date_iso), text.address_of(from_addr)

    def item(x: Column) -> Column:
        title = text.strip(text.unescape_native(text.html_tags_to_text(x["content"])))
        url = text.unescape_native(x["url"])
        return F.struct(title.alias("title"), url.alias("url"), F.lit("").alias("summary"), d.alias("date"), s.alias("sender"))
    return F.transform(found, item)


def rule_items(docs: DataFrame) -> DataFrame:
    """:func:`rule_item_array` as rows, with ``pos`` from 1.  Needs ``html``
    (``to_documents(keep_html=True)``)."""
    items = rule_item_array(F.col("html"), F.col("date_iso"), F.col("from_addr"))
    return (docs.select(*KEYS, F.posexplode(items).alias("pos", "it"))
            .select(*KEYS, (F.col("pos") + 1).cast("int").alias("pos"),
                    *[F.col(f"it.{c}").alias(c) for c in ("title", "url", "summary", "date", "sender")]))


def normalize_item_date(c: Column) -> Column:
    ts = F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def apply_item_defaults(items: DataFrame) -> DataFrame:
    """Items with ``_msg_date`` / ``_msg_sender`` columns -> final items: a
    missing or unusable date takes the message's send time, a missing sender
    the message's sender address.  Native, no shuffle."""
    return items.select(
        *KEYS, "pos", "title", "url", "summary",
        F.coalesce(normalize_item_date(F.col("date")), F.col("_msg_date")).alias("date"),
        F.when(F.coalesce(F.col("sender"), F.lit("")) != "", F.col("sender"))
        .otherwise(F.col("_msg_sender")).alias("sender"),
    )


def rule_extract(docs: DataFrame) -> DataFrame:
    """The deterministic default extractor: link items with date and sender
    from the message."""
    return rule_items(docs)


def item_defaults(items: DataFrame, docs: DataFrame) -> DataFrame:
    """Defaults for items stored apart from their documents (model output):
    equi-join on the full key, so the shuffle is balanced even when one
    mailbox is huge; only the two message columns are read from ``docs``."""
    d = docs.select(*KEYS, local_minute(F.col("date_iso")).alias("_msg_date"),
                    text.address_of(F.col("from_addr")).alias("_msg_sender"))
    d = within_ranges(d, items.select(*KEYS))      # only the documents the items can belong to
    return apply_item_defaults(items.join(d, KEYS, "left"))
