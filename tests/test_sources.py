"""File sources: document folders and landed .eml files."""

import os

from pyspark.sql import functions as F

from mailweave.operators import ingest as ig
from mailweave.session import scratch_path
from mailweave.sources import tables as tb

from .conftest import SF_SMALL, local


def test_doc_scan_stems_text_and_mtime(spark):
    base = scratch_path(spark, "docs")
    os.makedirs(local(base))
    for name, body in [("12.md", "---\nuid: 12\n---\nbody one"), ("abc.md", "x\ny\n"), ("skip.txt", "no")]:
        with open(os.path.join(local(base), name), "w", encoding="utf-8") as f:
            f.write(body)
    rows = {r.id: r for r in tb.doc_scan(spark, base).collect()}
    assert set(rows) == {"12", "abc"}
    assert rows["12"].text == "---\nuid: 12\n---\nbody one"
    assert rows["abc"].text == "x\ny\n"
    assert rows["abc"].mtime is not None
    assert tb.doc_scan(spark, base + "-missing").count() == 0


def test_pick_doc_dir(spark, tmp_path):
    a, b = str(tmp_path / "mails"), str(tmp_path / "mail")
    assert tb.pick_doc_dir(spark, [a, b]) == b
    os.makedirs(a)
    assert tb.pick_doc_dir(spark, [a, b]) == a
    assert tb.pick_doc_dir(spark, [a, b], override="/x") == "/x"


def test_eml_files_parse(spark):
    base = scratch_path(spark, "eml")
    os.makedirs(local(base))
    raw = b"From: A <a@x.org>\r\nSubject: hi\r\nContent-Type: text/plain\r\n\r\nhello there\r\n"
    for name in ("5.eml", "7.eml", "bad.eml"):
        with open(os.path.join(local(base), name), "wb") as f:
            f.write(raw)
    df = tb.read_eml_files(spark, base, "acc", "INBOX")
    assert sorted(r.uid for r in df.collect()) == [0, 5, 7]
    docs = ig.to_documents(ig.parse_messages(ig.valid_records(df))).collect()
    assert sorted(d.uid for d in docs) == [5, 7]
    assert all(d.body == "hello there" and d.size == len(raw) for d in docs)


def test_overwrite_keys_replaces_touched_rows(spark):
    path = scratch_path(spark, "tbl")
    old = spark.createDataFrame([("a", "m", 1, "old"), ("a", "m", 2, "old"), ("a", "n", 1, "old")],
                                "account string, mailbox string, uid bigint, subject string")
    old.write.partitionBy("account", "mailbox").parquet(path)
    new = spark.createDataFrame([("a", "m", 2, "new"), ("a", "m", 3, "new")],
                                "account string, mailbox string, uid bigint, subject string")
    tb.overwrite_keys(new, spark.read.parquet(path), path)
    got = sorted((r.mailbox, r.uid, r.subject) for r in spark.read.parquet(path).collect())
    assert got == [("m", 1, "old"), ("m", 2, "new"), ("m", 3, "new"), ("n", 1, "old")]
    tb.append_if_absent(new.union(spark.createDataFrame([("a", "n", 9, "x")], new.schema)),
                        spark.read.parquet(path), path)
    assert spark.read.parquet(path).count() == 5


def test_read_raw_parquet_normalises(spark):
    from mailweave.sources import fixtures as fx
    path = scratch_path(spark, "landed")
    fx.fixture_c(spark, "/root/testdata/sf0.001").write.parquet(path)
    df = tb.read_raw_parquet(spark, path)
    rows = df.select("uid", "size", F.octet_length("raw").alias("n"), "thread_id").collect()
    assert len(rows) == 200
    assert all(r.size == r.n for r in rows)          # NULL / 0 sizes fall back to the byte length
    assert {r.thread_id for r in rows if r.uid % 4 == 1} == {None}


def test_export_refuses_several_mailboxes(spark):
    import pytest
    from mailweave.sources import fixtures as fx
    raw = ig.normalize_records(fx.raw_messages(spark, "/root/testdata/sf0.001"))
    docs = ig.to_documents(ig.parse_messages(ig.valid_records(raw.where("uid < 5"))))
    with pytest.raises(ValueError):
        tb.export_markdown(docs, scratch_path(spark, "export"))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    import pytest
    from mailweave import session
    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn", getConf=lambda: conf))
    with pytest.raises(ValueError):
        session.shared_dir(cluster)


def test_versions_replace_each_other(spark):
    path = scratch_path(spark, "versions")
    assert tb.read_version(spark, path, "x int") is None
    for n in (3, 2, 1):
        tb.write_version(spark.range(n).selectExpr("cast(id AS int) AS x"), path)
    assert tb.read_version(spark, path, "x int").count() == 1
    assert len(tb.folders(spark, path)) == 1
    # a version may be made from the one before
    tb.write_version(tb.read_version(spark, path, "x int").selectExpr("x + 7 AS x"), path)
    assert [r.x for r in tb.read_version(spark, path, "x int").collect()] == [7]


def test_export_in_subfolders_is_listed_by_tasks(spark, monkeypatch):
    """A large mailbox exported into subfolders reads back whole, with the same
    ids and texts as the flat folder, and without a driver's listing of files."""
    from mailweave.plans.queries import docs_only
    docs = docs_only(spark, SF_SMALL)
    flat, deep = scratch_path(spark, "flat"), scratch_path(spark, "deep")
    names = {r.name for r in tb.export_markdown(docs, deep, uids_per_folder=7).collect()}
    tb.export_markdown(docs, flat)
    want = sorted((r.id, r.text) for r in tb.doc_scan(spark, flat).collect())
    monkeypatch.setattr(tb, "doc_scan", None)
    got = tb.doc_scan_folders(spark, deep)
    assert sorted((r.id, r.text) for r in got.collect()) == want and len(want) == len(names) > 7
    assert all(n == f"{int(n.split('/')[1][:-3]) // 7}/{n.split('/')[1]}" for n in names)
    assert got.where("mtime IS NULL OR path NOT LIKE '%.md'").count() == 0
    assert len(got.inputFiles()) == 0
