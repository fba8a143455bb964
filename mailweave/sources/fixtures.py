"""Test inputs derived from the driver's tables with native expressions.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame whose work
grows with the source table.  Raw RFC 822 messages are assembled with
``concat`` / ``base64`` so that an oracle can read the *source* columns and
needs no mail parser (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Source rows spread over every core.

    The test tables are single-row-group files (one scan task each); the
    messages derived from them feed a CPU-bound parse stage, so they are
    dealt round-robin over ``defaultParallelism`` partitions first.  Landed
    production data arrives as many files and needs no such step.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def b64h(c: Column) -> Column:
    """base64 of the UTF-8 bytes on one line (for encoded-word headers)."""
    return F.regexp_replace(F.base64(F.encode(c, "UTF-8")), r"\s", "")


def b64b(c: Column) -> Column:
    """base64 body: 76-character lines joined by CRLF."""
    return F.regexp_replace(b64h(c), "(.{76})(?=.)", "$1\r\n")


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def url_host(c: Column) -> Column:
    return F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)


def html_title(c: Column) -> Column:
    return F.regexp_extract(c, r"(?s)<title>(.*?)</title>", 1)


# --------------------------------------------------------------------------
# F-A: pages as single-part HTML newsletters
# --------------------------------------------------------------------------
def fixture_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"))
    raw = F.concat(
        F.lit("From: =?utf-8?b?"), b64h(F.lit("新闻 Desk")), F.lit("?= <news@"),
        url_host(F.col("url")), F.lit(">" + CRLF),
        F.lit("To: a@x.org, B <b@x.org>, a@x.org" + CRLF),
        F.lit("Date: Tue, 01 Dec 2026 17:02:00 +0800" + CRLF),
        F.lit("Subject: =?utf-8?b?"), b64h(html_title(F.col("html"))), F.lit("?=" + CRLF),
        F.lit("Message-ID: <page-"), _s("page_id"), F.lit("@x.org>" + CRLF),
        F.lit("MIME-Version: 1.0" + CRLF),
        F.lit("Content-Type: text/html; charset=utf-8" + CRLF),
        F.lit("Content-Transfer-Encoding: 8bit" + CRLF + CRLF),
        F.col("html"),
    )
    return pages.select(
        F.lit("desk").alias("account"),
        F.lit("INBOX").alias("mailbox"),
        F.col("page_id").cast("bigint").alias("uid"),
        F.encode(raw, "UTF-8").alias("raw"),
        F.length("html").cast("bigint").alias("size"),
        F.lit(None).cast("array<string>").alias("labels"),
        F.lit(None).cast("string").alias("thread_id"),
    )


# --------------------------------------------------------------------------
# F-B: conversation turns as base64 text/plain messages in one thread each
# --------------------------------------------------------------------------
def _fb_day() -> Column:
    return (F.col("conv_id") % 28 + 1).cast("int")


def fixture_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = spread(table(spark, sf_dir, "conversations"))
    day = _fb_day()
    d = F.make_date(F.lit(2026), F.lit(12), day)
    zone = (F.when(F.col("conv_id") % 4 == 0, F.lit(" +0000"))
            .when(F.col("conv_id") % 4 == 1, F.lit(" +0800"))
            .when(F.col("conv_id") % 4 == 2, F.lit(" -0500"))
            .otherwise(F.lit("")))
    date_hdr = F.concat(
        F.date_format(d, "EEE"), F.lit(", "), F.lpad(day.cast("string"), 2, "0"),
        F.lit(" Dec 2026 "), F.lpad((F.col("conv_id") % 24).cast("string"), 2, "0"), F.lit(":"),
        F.lpad(_s("turn"), 2, "0"), F.lit(":00"), zone,
    )
    msg_id = F.when(F.col("turn") == 2, F.lit("")).otherwise(
        F.concat(F.lit("Message-ID: <c"), _s("conv_id"), F.lit("."), _s("turn"), F.lit("@x.org>" + CRLF)))
    raw = F.concat(
        F.lit("From: "), F.initcap("role"), F.lit(" <"), F.col("role"), F.lit("@chat.x.org>" + CRLF),
        F.lit("To: desk@x.org" + CRLF),
        F.lit("Date: "), date_hdr, F.lit(CRLF),
        F.lit("Subject: conv "), _s("conv_id"), F.lit(" turn "), _s("turn"), F.lit(CRLF),
        msg_id,
        F.lit("MIME-Version: 1.0" + CRLF),
        F.lit("Content-Type: text/plain; charset=utf-8" + CRLF),
        F.lit("Content-Transfer-Encoding: base64" + CRLF + CRLF),
        b64b(F.col("text")), F.lit(CRLF),
    )
    return conv.select(
        F.lit("desk").alias("account"),
        F.lit("[All]").alias("mailbox"),
        (F.col("conv_id") * 1000 + F.col("turn") + 1).cast("bigint").alias("uid"),
        F.encode(raw, "UTF-8").alias("raw"),
        F.lit(None).cast("bigint").alias("size"),
        F.array(F.col("role")).alias("labels"),
        _s("conv_id").alias("thread_id"),
    )


# --------------------------------------------------------------------------
# F-C: documents as multipart/mixed with plain, html alternative, attachment
# --------------------------------------------------------------------------
def fixture_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    did = _s("doc_id")
    boundary = F.concat(F.lit("--b"), did)
    plain_body = F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(b64b(F.col("text")))
    cc = F.when(F.col("doc_id") % 3 == 0,
                F.lit('Cc: "Doe, Jane" <jane@x.org>, lonely@x.org' + CRLF)).otherwise(F.lit(""))
    raw = F.concat(
        F.lit("From: Docs <docs@x.org>" + CRLF),
        F.lit("To: desk@x.org, Desk <desk@x.org>, desk@x.org" + CRLF),
        cc,
        F.lit("Date: Mon, 30 Nov 2026 08:00:00 +0000" + CRLF),
        F.lit("Subject: =?utf-8?b?"), b64h(F.concat(F.lit("doc "), did, F.lit(" "), F.col("lang"))),
        F.lit("?=" + CRLF),
        F.lit("Message-ID: <d"), did, F.lit("@x.org>" + CRLF),
        F.lit("MIME-Version: 1.0" + CRLF),
        F.lit('Content-Type: multipart/mixed; boundary="b'), did, F.lit('"' + CRLF + CRLF),
        boundary, F.lit(CRLF),
        F.lit("Content-Type: text/plain; charset=utf-8" + CRLF),
        F.lit("Content-Transfer-Encoding: base64" + CRLF + CRLF),
        plain_body, F.lit(CRLF),
        boundary, F.lit(CRLF),
        F.lit("Content-Type: text/html; charset=utf-8" + CRLF + CRLF),
        F.lit("<p>alt</p>" + CRLF),
        boundary, F.lit(CRLF),
        F.lit('Content-Type: text/csv; name="f'), did, F.lit('.csv"' + CRLF),
        F.lit('Content-Disposition: attachment; filename="f'), did, F.lit('.csv"' + CRLF + CRLF),
        F.lit("doc_id,lang" + CRLF), did, F.lit(","), F.col("lang"), F.lit(CRLF),
        boundary, F.lit("--" + CRLF),
    )
    return docs.select(
        F.lit("desk").alias("account"),
        F.lit("docs").alias("mailbox"),
        (F.col("doc_id") + 1).cast("bigint").alias("uid"),
        F.encode(raw, "UTF-8").alias("raw"),
        F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.lit(0)).cast("bigint").alias("size"),
        F.when(F.col("doc_id") % 3 == 1, F.array("source", "lang")).alias("labels"),
        F.when(F.col("doc_id") % 4 != 0, (F.col("doc_id") * 7).cast("string")).alias("thread_id"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-A ∪ F-B ∪ F-C: three mailboxes of one account."""
    return (fixture_a(spark, sf_dir)
            .unionByName(fixture_b(spark, sf_dir))
            .unionByName(fixture_c(spark, sf_dir)))


# --------------------------------------------------------------------------
# F-D: provider metadata text
# --------------------------------------------------------------------------
def fixture_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    did = _s("doc_id")
    thrid = F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit(" X-GM-THRID "), (F.col("doc_id") * 7).cast("string"))
                   ).otherwise(F.lit(""))
    m9 = F.col("doc_id") % 9
    labels = (F.when(F.col("doc_id") % 3 == 0, F.lit(""))
              .when(F.col("doc_id") % 3 == 1, F.lit(" X-GM-LABELS ()"))
              .when(m9 == 2, F.concat(F.lit(' X-GM-LABELS ("'), F.col("source"), F.lit(' x" '),
                                      F.col("lang"), F.lit(' "\\\\Inbox")')))
              .when(m9 == 5, F.concat(F.lit(" X-GM-LABELS (it's "), F.col("lang"), F.lit(")")))
              .otherwise(F.concat(F.lit(' X-GM-LABELS ("'), F.col("source"), F.lit(' x" '),
                                  F.col("lang"), F.lit(' "Inbox" a"b c"d)'))))
    meta = F.concat(F.lit("1 (UID "), did, F.lit(" RFC822.SIZE "), _s("n_chars"), thrid, labels, F.lit(")"))
    return docs.select(F.col("doc_id"), meta.alias("meta"))


# --------------------------------------------------------------------------
# F-E: state, existing documents and results, from the F-A..F-C keys
# --------------------------------------------------------------------------
def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(account, mailbox, uid) of F-A..F-C without building the raw bytes."""
    pages = table(spark, sf_dir, "pages").select(
        F.lit("desk").alias("account"), F.lit("INBOX").alias("mailbox"), F.col("page_id").cast("bigint").alias("uid"))
    conv = table(spark, sf_dir, "conversations").select(
        F.lit("desk").alias("account"), F.lit("[All]").alias("mailbox"),
        (F.col("conv_id") * 1000 + F.col("turn") + 1).cast("bigint").alias("uid"))
    docs = table(spark, sf_dir, "documents").select(
        F.lit("desk").alias("account"), F.lit("docs").alias("mailbox"), (F.col("doc_id") + 1).cast("bigint").alias("uid"))
    return pages.unionByName(conv).unionByName(docs)


def fixture_e_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """last_uid = 60 % of the max uid per mailbox; no row for ``docs``."""
    return (message_keys(spark, sf_dir)
            .where(F.col("mailbox") != "docs")
            .groupBy("account", "mailbox")
            .agg((F.max("uid") * 3 / 5).cast("bigint").alias("last_uid")))


def fixture_e_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_keys(spark, sf_dir).where(F.col("uid") % 3 == 0)


def fixture_e_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_keys(spark, sf_dir).where(F.col("uid") % 2 == 0)


def fixture_e_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_keys(spark, sf_dir).where(F.col("uid") % 5 == 0)


# --------------------------------------------------------------------------
# F-F: extraction attempts and responses, from documents
# --------------------------------------------------------------------------
def _doc_keys(df: DataFrame) -> list[Column]:
    return [F.lit("desk").alias("account"), F.lit("docs").alias("mailbox"),
            (F.col("doc_id") + 1).cast("bigint").alias("uid")]


def fixture_f_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model response per document, shaped by doc_id % 5.

    0 valid list / 1 fenced list / 2 fenced and broken / 3 prose /
    4 fence with ``]`` before ``[``.  Items omit ``date`` for odd ids and
    ``sender`` when doc_id % 3 = 0 so that item defaults have work to do.
    """
    docs = table(spark, sf_dir, "documents")
    did = _s("doc_id")
    date_part = F.when(F.col("doc_id") % 2 == 1, F.lit("")).otherwise(
        F.concat(F.lit(', "date": "2026-11-'), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"),
                 F.lit(' 09:30"')))
    sender_part = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.lit(', "sender": "news@src.example"'))
    item = F.concat(
        F.lit('{"title": "'), F.col("lang"), F.lit(" story "), did, F.lit('", "url": "https://n.example/'),
        did, F.lit('", "summary": "'), F.col("source"), F.lit('"'), date_part, sender_part, F.lit("}"))
    lst = F.concat(F.lit("["), item, F.lit(", "), item, F.lit("]"))
    m5 = F.col("doc_id") % 5
    resp = (F.when(m5 == 0, lst)
            .when(m5 == 1, F.concat(F.lit("```json\n"), lst, F.lit("\n```")))
            .when(m5 == 2, F.concat(F.lit("  ```json\n["), item, F.lit(",, ]\n```")))
            .when(m5 == 3, F.concat(F.lit("Here are the news: "), F.col("lang")))
            .otherwise(F.concat(F.lit("```\n] nothing ["), did, F.lit("\n```"))))
    return docs.select(*_doc_keys(docs), resp.alias("response"))


# Outcome patterns of F-F (fixed values of the fixture, by doc_id % 6):
# each entry is the attempt sequence (response, error) in attempt order.
F_PATTERNS = {
    0: [("ok", None)],
    1: [("", None), ("ok", None)],
    2: [(None, "timeout"), (None, "data_inspection_failed: blocked"), ("ok", None)],
    3: [(None, "error 1"), (None, "error 2"), (None, "error 3"), ("ok", None)],
    4: [(None, "Inappropriate Content detected"), ("ok", None)],
    5: [("", None), ("ok", None), (None, "late error")],
}


def fixture_f_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempt log: later attempts exist on purpose, the fold must ignore them."""
    docs = table(spark, sf_dir, "documents")
    resp = fixture_f_responses(spark, sf_dir).select("uid", "response")
    m6 = (F.col("doc_id") % 6).cast("int")
    seqs = None
    for k, seq in F_PATTERNS.items():
        arr = F.array(*[
            F.struct(F.lit(i + 1).alias("attempt_no"),
                     (F.lit(r) if r is not None else F.lit(None).cast("string")).alias("response"),
                     (F.lit(e) if e is not None else F.lit(None).cast("string")).alias("error"))
            for i, (r, e) in enumerate(seq)])
        seqs = F.when(m6 == k, arr) if seqs is None else seqs.when(m6 == k, arr)
    exploded = docs.select(*_doc_keys(docs), F.explode(seqs).alias("a"))
    out = exploded.join(resp, "uid")
    return out.select(
        "account", "mailbox", "uid", F.col("a.attempt_no").alias("attempt_no"),
        F.when(F.col("a.response") == "ok", F.col("response")).otherwise(F.col("a.response")).alias("response"),
        F.col("a.error").alias("error"))


# --------------------------------------------------------------------------
# F-G: document listing (id, mtime) from events
# --------------------------------------------------------------------------
def fixture_g(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ident = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("n"), _s("event_id"))).otherwise(
        ((F.col("event_id") * 37) % 10007).cast("string"))
    return ev.select(ident.alias("id"), F.col("ts").alias("mtime"))
