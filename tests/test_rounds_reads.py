"""What a round reads and moves follows its batch, not the files of the archive."""

import pytest
from pyspark.sql import functions as F

from mailweave.functions import mime
from mailweave.operators import ingest as ig
from mailweave.session import scratch_path
from mailweave.sources.snapshots import Store
from mailweave.streaming import rounds

RAW = "account string, mailbox string, uid bigint, raw binary, size bigint, labels array<string>, thread_id string"


def batch(spark, uids, account="a"):
    """Messages with one link each, far apart, so that each has a bucket of its own."""
    html = '<a href="https://x/{0}">t{0}</a>'
    return spark.createDataFrame([(account, "m", u << rounds.BUCKET_BITS,
                                   f"From: n@x.org\r\nSubject: s{u}\r\nContent-Type: text/html\r\n\r\n{html.format(u)}".encode(),
                                   None, None, None) for u in uids], RAW)


def keys(df):
    return sorted(map(tuple, df.select("account", "mailbox", "uid").collect()), key=repr)


@pytest.fixture
def lay(spark):
    return rounds.Layout(scratch_path(spark, "reads"))


@pytest.fixture
def opened(monkeypatch):
    """The files of documents that plans were built on."""
    files, real = [], Store.read

    def read(self, table, *a, **k):
        df = real(self, table, *a, **k)
        if table == "documents":
            files.extend(df.inputFiles())
        return df
    monkeypatch.setattr(Store, "read", read)
    return files


def test_rounds_open_only_folders_with_open_documents(spark, lay, opened):
    none = spark.createDataFrame([], rounds.KEY_SCHEMA)
    for i, uids in enumerate(([1, 2, 3], [3, 4])):
        opened.clear()
        rounds.ingest_round(batch(spark, uids), lay)
        assert opened == []
        assert rounds.extract_round(spark, lay, i, candidates=none).rows == (3, 1)[i]
        # what the first round stored is not read again by the second
        assert len({f.split("bucket=")[1].split("/")[0] for f in opened}) == (3, 1)[i]
    opened.clear()
    assert rounds.extract_round(spark, lay, 2, candidates=none).rows == 0 and opened == []
    out = rounds.read_outputs(spark, lay)
    want = [u << rounds.BUCKET_BITS for u in (1, 2, 3, 4)]
    assert all(sorted(r[2] for r in keys(out[t])) == want for t in ("documents", "results"))


def test_noted_keys_are_those_of_the_documents(spark, lay):
    def same():
        tables = rounds.store(spark, lay)
        noted = rounds._document_keys(spark, tables)
        assert keys(noted) == keys(rounds.read(spark, lay, "documents"))
        assert {r.folder for r in noted.collect()} <= {e.folder for e in tables.manifest().tables["documents"]}
    rounds.ingest_round(batch(spark, [1, 2, 3]), lay)
    rounds.ingest_round(batch(spark, [3, 4]).union(batch(spark, [5], None)).union(batch(spark, [6], "")), lay)
    same()
    rounds.ingest_round(batch(spark, [2, 7]), lay, redownload=True)
    same()
    rounds.compact(spark, lay)
    same()
    assert len(rounds.store(spark, lay).manifest().tables["document_keys"]) == 1
    rounds.ingest_round(batch(spark, [7, 8]), lay)
    same()


def test_raw_messages_meet_only_stored_keys(spark):
    new, none = ig.normalize_records(batch(spark, [1, 2])), spark.createDataFrame([], rounds.KEY_SCHEMA)
    plan = ig.insert_valid_if_absent(new, none)
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString() and plan.count() == 2
    assert ig.insert_valid_if_absent(new, new.select("account", "mailbox", "uid").limit(1)).count() == 1


def test_few_files_are_parsed_by_all_tasks(spark):
    few = batch(spark, range(1, 400)).coalesce(1)
    held = [n for n in rounds._dealt(few).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert len(held) > cores and max(r["count"] for r in held) < 399 / cores


def test_header_classes_are_made_once():
    make = mime._POLICY.header_factory
    assert make["Subject"] is make["subject"] and make["Subject"] is not make["To"]
    for name, value in (("To", "A <a@x.org>, b@x.org"), ("Content-Type", 'text/plain; charset="utf-8"'), ("X-Other", "=?utf-8?q?a=C3=A4?=")):
        plain = mime.email.policy.default.header_factory(name, value)
        assert str(make(name, value)) == str(plain) and type(make(name, value)).__mro__[1:] == type(plain).__mro__[1:]
    assert type(make("X-One", "1")) is type(make("X-Two", "2"))
