"""Hand-made edge messages through the parse stage and the native columns."""

import pytest

from mailweave.operators import ingest as ig

CRLF = "\r\n"


def msg(headers: list[str], body: str = "hello", ctype: str = "text/plain; charset=utf-8") -> bytes:
    h = list(headers) + [f"Content-Type: {ctype}", "MIME-Version: 1.0"]
    return (CRLF.join(h) + CRLF + CRLF + body).encode("utf-8")


def mp(headers: list[str], parts: list[str], boundary: str = "XYZ", sub: str = "mixed") -> bytes:
    out = CRLF.join(headers + [f'Content-Type: multipart/{sub}; boundary="{boundary}"', "MIME-Version: 1.0"])
    out += CRLF + CRLF
    for p in parts:
        out += f"--{boundary}{CRLF}{p}{CRLF}"
    out += f"--{boundary}--{CRLF}"
    return out.encode("utf-8")


CASES = {
    1: msg(["From: A <a@x.org>", "Subject: =?iso-8859-1?q?caf=E9?=", "Date: Tue, 01 Dec 2026 17:02:00"]),
    2: msg(['From: "Doe, Jane" <jane@x.org>', "To: a@x.org, B <b@x.org>, a@x.org, B <b@x.org>",
            "Cc: c@x.org", "Date: Tue, 01 Dec 2026 17:02:00 -0000"]),
    3: msg(["From: a@x.org", "Date: Tue, 01 Dec 26 17:02:00 +0100", "Message-ID: <m3@x.org>"]),
    4: msg(["From: a@x.org", "Date: not a date at all"]),
    5: mp(["From: a@x.org", "Subject: inline"], [
        "Content-Type: text/plain; charset=utf-8\r\n\r\nfirst",
        'Content-Type: text/plain; charset=utf-8\r\nContent-Disposition: inline; filename="note.txt"\r\n\r\nhidden',
        "Content-Type: text/plain; charset=utf-8\r\nContent-Disposition: inline\r\n\r\nsecond",
        "Content-Type: application/pdf\r\nContent-Disposition: attachment\r\n\r\nunnamed",
        'Content-Type: application/pdf\r\nContent-Disposition: attachment; filename="=?utf-8?q?r=C3=A9sum=C3=A9.pdf?="'
        "\r\n\r\npdf",
    ]),
    6: mp(["From: a@x.org"], [
        'Content-Type: multipart/alternative; boundary="ALT"\r\n\r\n--ALT\r\n'
        "Content-Type: text/plain; charset=utf-8\r\n\r\nplain text\r\n--ALT\r\n"
        "Content-Type: text/html; charset=utf-8\r\n\r\n<p>html</p>\r\n--ALT--",
        'Content-Type: text/csv\r\nContent-Disposition: attachment; filename="a.csv"\r\n\r\nx,y',
    ]),
    7: msg(["From: a@x.org"], "<html><style>x{}</style><p>Hi&nbsp;there &rsquo;q&#8217; &amp;lt;</p>"
           "<br>line</html>", "text/html; charset=utf-8"),
    8: ("From: a@x.org" + CRLF + "Content-Type: text/plain; charset=us-ascii" + CRLF
        + "Content-Transfer-Encoding: 8bit" + CRLF + CRLF + "naïve").encode("utf-8"),
    9: ("From: a@x.org" + CRLF + "Content-Type: text/plain; charset=utf-8" + CRLF
        + "Content-Disposition: attachment; filename=\"x.txt\"" + CRLF + CRLF + "single part body").encode("utf-8"),
    10: mp(["From: a@x.org"], [
        "Content-Type: text/html; charset=utf-8\r\n\r\n<p>only html</p>",
        "Content-Type: text/html; charset=utf-8\r\n\r\n<p>second</p>",
    ]),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("acc", "INBOX", uid, raw, 0 if uid % 2 else None, None, None) for uid, raw in CASES.items()]
    rows += [("acc", "INBOX", 0, b"From: a@x.org\r\n\r\nx", None, None, None),
             ("acc", "INBOX", 99, b"", None, None, None)]
    df = spark.createDataFrame(rows, "account string, mailbox string, uid bigint, raw binary, size bigint, "
                                     "labels array<string>, thread_id string")
    rec = ig.normalize_records(df)
    assert rec.where("uid in (0, 99)").count() == 2
    assert ig.valid_records(rec).count() == len(CASES)
    out = ig.to_documents(ig.parse_messages(ig.valid_records(rec))).collect()
    return {r.uid: r for r in out}


def test_encoded_word_non_utf8_and_naive_date(docs):
    d = docs[1]
    assert d.subject == "café"
    assert d.date_iso == "2026-12-01T17:02:00+00:00"
    assert d.message_id == ""
    assert d.size == len(CASES[1])


def test_addresses_quoted_comma_and_dedupe(docs):
    d = docs[2]
    assert d.from_addr == "Doe, Jane <jane@x.org>"
    assert d.to == ["a@x.org", "B <b@x.org>"]
    assert d.cc == ["c@x.org"]
    assert d.date_iso == "2026-12-01T17:02:00+00:00"      # -0000 is "no zone"


def test_two_digit_year_and_message_id(docs):
    assert docs[3].date_iso == "2026-12-01T17:02:00+01:00"
    assert docs[3].message_id == "<m3@x.org>"
    assert docs[3].from_addr == "a@x.org"


def test_garbage_date_is_null(docs):
    assert docs[4].date_iso is None
    assert docs[4].date_ts is None


def test_inline_and_unnamed_attachments(docs):
    d = docs[5]
    assert d.body == "first\n\nsecond"
    assert d.attachments == ["note.txt", "résumé.pdf"]


def test_nested_multipart_plain_wins(docs):
    assert docs[6].body == "plain text"
    assert docs[6].attachments == ["a.csv"]


def test_single_part_html_full_entities(docs):
    assert docs[7].body == "Hi\u00a0there \u2019q\u2019 &lt;\n\n\nline"


def test_charset_contradicting_bytes_replaced(docs):
    assert "�" in docs[8].body


def test_single_part_skips_attachment_test(docs):
    assert docs[9].body == "single part body"
    assert docs[9].attachments == []


def test_html_parts_joined_before_conversion(docs):
    assert docs[10].body == "only html\n\n\n\nsecond"


def test_skip_empty_plain_option(spark):
    raw = mp(["From: a@x.org"], ["Content-Type: text/plain; charset=utf-8\r\n\r\n  ",
                                 "Content-Type: text/html; charset=utf-8\r\n\r\n<p>from html</p>"])
    df = spark.createDataFrame([("acc", "INBOX", 1, raw, None, None, None)],
                               "account string, mailbox string, uid bigint, raw binary, size bigint, "
                               "labels array<string>, thread_id string")
    parsed = ig.parse_messages(ig.normalize_records(df))
    assert ig.to_documents(parsed).first().body == ""
    assert ig.to_documents(parsed, skip_empty_plain=True).first().body == "from html"


def _parse(raw: bytes) -> dict:
    from mailweave.functions import mime
    return mime.parse_one(raw)


def test_unknown_charset_keeps_the_message():
    single = _parse(b"Subject: s\r\nContent-Type: text/plain; charset=x-unknown-8\r\n\r\nbody\xff")
    assert single["subject"] == "s" and single["parts"][0]["payload"] is None
    multi = _parse(b'Subject: m\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="b"\r\n\r\n--b\r\n'
                   b"Content-Type: text/plain; charset=x-unknown-8\r\n\r\nlost\xff\r\n--b\r\n"
                   b"Content-Type: text/plain; charset=utf-8\r\n\r\nkept\r\n--b--\r\n")
    assert [p["payload"].strip() for p in multi["parts"]] == ["", "kept"]


def test_encoded_word_rules():
    from mailweave.functions.mime import decode_words
    assert decode_words("=?utf-8?q?a_b?= =?utf-8?q?c?=") == "a bc"           # the gap disappears
    assert decode_words("=?utf-8?b?5Lg=?= =?utf-8?b?rQ==?=") == "中"           # one character over two words
    assert decode_words("x =?iso-8859-1?q?=E9?= y") == "x é y"
    assert decode_words("=?nope-1?q?=C3=A9?=") == "é"
    assert decode_words("plain") == "plain" and decode_words(None) == ""


def test_headers_only_parse_equals_the_whole(spark):
    from pyspark.sql import functions as F
    from mailweave.operators import ingest as ig
    from mailweave.sources import fixtures as fx
    raw = ig.normalize_records(fx.raw_messages(spark, "/root/testdata/sf0.001"))
    cols = ["uid", "mailbox", "subject", "date_iso", "from_addr", F.concat_ws("|", "attachments").alias("att")]
    whole = ig.to_documents(ig.parse_messages(raw)).select(*cols)
    light = ig.to_documents(ig.parse_messages(raw, with_payload=False)).select(*cols)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, light.collect()))


def test_dates_without_a_point_in_time(spark):
    from pyspark.sql import functions as F
    from mailweave.functions import mime, text
    cases = {"Tue, 01 Dec 2026 17:02:00 +0800": "2026-12-01T17:02:00+08:00", "1 Dec 26 25:00:00 +0000": None,
             "31 Feb 2026 10:00:00 -0330": None, "1 Dec 2026 10:00:00 -0330": "2026-12-01T10:00:00-03:30",
             "1 Dec 2026 10:00": "2026-12-01T10:00:00+00:00", "": None, "never": None}
    df = spark.createDataFrame([(k, mime.date_fields(k)) for k in cases], "h string, f array<int>")
    assert {r.h: r.iso for r in df.select("h", text.iso_date(F.col("f")).alias("iso")).collect()} == cases
