"""Rows-only operators checked by behaviour: HTML -> Markdown and YAML front matter."""

import json

import yaml
from pyspark.sql import functions as F

from mailweave.functions.frontmatter import front_matter_json, render_markdown
from mailweave.functions.markdown import convert, html_to_markdown
from mailweave.operators import ingest as ig
from mailweave.plans.queries import documents
from mailweave.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_markdown_subset():
    html = ("<html><head><title>T</title><style>p{}</style></head><body>"
            "<h2>News</h2><p>Read <a href='https://x.org/a?b=1&amp;c=2'>the <b>story</b></a> now."
            "<img src='i.png' alt='pic'></p><ul><li>one</li><li><i>two</i></li></ul>"
            "<script>var x = '<p>';</script><p>a<br>b &copy; c</p></body></html>")
    md = convert(html)
    assert md == ("## News\n\nRead [the **story**](https://x.org/a?b=1&c=2) now.\n\n"
                  "* one\n* _two_\n\na\nb © c")
    assert convert("<a>no href</a>") == "no href"
    assert convert(None) is None


def test_markdown_udf_on_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.md for r in pages.select("page_id", html_to_markdown(F.col("html")).alias("md")).collect()}
    for r in pages.select("page_id", "html").collect():
        assert got[r.page_id] == convert(r.html)
        assert "<script" not in got[r.page_id] and "track(" not in got[r.page_id]


def test_markdown_as_body_converter(spark):
    raw = ig.valid_records(ig.normalize_records(fx.fixture_a(spark, SF)))
    docs = ig.to_documents(ig.parse_messages(raw), html_converter=html_to_markdown)
    bodies = [r.body for r in docs.limit(5).collect()]
    assert all("](/" in b for b in bodies)          # nav links kept as [text](href)


def test_yaml_front_matter_parses_back(spark):
    d = documents(spark, SF).select("uid", "mailbox", front_matter_json().alias("fm"), render_markdown().alias("doc"),
                                    "body")
    rows = d.collect()
    assert rows
    for r in rows:
        assert r.doc.startswith("---\n")
        head, _, rest = r.doc[4:].partition("\n---\n")
        assert yaml.safe_load(head) == json.loads(r.fm)
        assert rest == r.body
        keys = list(json.loads(r.fm))
        assert keys[:6] == ["uid", "message_id", "subject", "date", "from", "size"]
