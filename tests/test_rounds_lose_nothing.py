"""A round loses no message and no document, whatever fails in between."""

import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from mailweave.operators import extract as ex
from mailweave.operators import ingest as ig
from mailweave.session import scratch_path
from mailweave.sources.snapshots import Store
from mailweave.streaming import rounds

RAW = "account string, mailbox string, uid bigint, raw binary, size bigint, labels array<string>, thread_id string"


def message(uid, body="body"):
    return f"From: n <n{uid}@x.org>\r\nSubject: s{uid}\r\n\r\n{body}".encode()


def batch(spark, uids):
    return spark.createDataFrame([("a", "m", u, message(u), None, None, None) for u in uids], RAW)


def land(spark, lay, uids, name):
    batch(spark, uids).coalesce(1).write.parquet(f"{lay.landing}/arrival={name}")


def stored(spark, lay, table, col="uid"):
    return sorted(r[0] for r in rounds.read_outputs(spark, lay)[table].select(col).collect())


class Once:
    """Fails the first time it is called."""

    def __init__(self, real, method=False):
        self.real, self.calls, self.method = real, 0, method

    def __get__(self, obj, kind=None):
        return (lambda *a, **k: self(obj, *a, **k)) if self.method else self

    def __call__(self, *a, **k):
        self.calls += 1
        if self.calls == 1:
            raise RuntimeError("lost")
        return self.real(*a, **k)


def loop(spark, lay, n=1, **opts):
    rounds.run_loop(spark, lay.landing + "/*", lay, gap_s=0.0, max_rounds=n, wait_s=0.0, **opts)


@pytest.fixture
def lay(spark):
    return rounds.Layout(scratch_path(spark, "lossless"))


def test_failed_ingest_is_read_again(spark, lay, monkeypatch):
    land(spark, lay, [1, 2], 0)
    monkeypatch.setattr(rounds, "ingest_round", Once(rounds.ingest_round))
    loop(spark, lay)
    assert stored(spark, lay, "documents") == []
    log = rounds.read_outputs(spark, lay)["round_log"].collect()
    assert {(r.stage, r.exit_code) for r in log} == {("ingest", 1), ("extract", 0)}
    assert [r.error for r in log if r.stage == "ingest"] == ["lost"]
    land(spark, lay, [3], 1)
    loop(spark, lay, 2)
    assert stored(spark, lay, "documents") == stored(spark, lay, "results") == [1, 2, 3]


def test_crash_in_a_commit(spark, lay, monkeypatch):
    land(spark, lay, [1, 2], 0)
    monkeypatch.setattr(Store, "commit", Once(Store.commit, method=True))
    loop(spark, lay)                                  # nothing of the ingest is visible, its file is noted
    assert stored(spark, lay, "documents") == []
    loop(spark, lay)                                  # ingested again: all is stored and extracted
    assert stored(spark, lay, "documents") == stored(spark, lay, "results") == [1, 2]


def test_failed_extraction_is_taken_up_without_new_files(spark, lay, monkeypatch):
    land(spark, lay, [1, 2], 0)
    monkeypatch.setattr(ex, "document_text", Once(ex.document_text))
    loop(spark, lay, model=ex.StubModel())
    assert stored(spark, lay, "results") == []
    assert {r.exit_code for r in rounds.read_outputs(spark, lay)["round_log"].where("stage = 'extract'").collect()} == {2}
    loop(spark, lay, 2, model=lambda prompt: "[]")    # nothing new has landed
    assert stored(spark, lay, "results") == [1, 2]
    assert rounds.read(spark, lay, "unresolved").count() == 0


def test_fresh_checkpoint_calls_the_model(spark, lay):
    land(spark, lay, [1], 0)
    loop(spark, lay, model=lambda p: "[]")
    spark._jvm.org.apache.hadoop.fs.Path(lay.checkpoint).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(lay.checkpoint), True)
    land(spark, lay, [2], 1)
    loop(spark, lay, model=lambda p: "[]")            # batch numbers begin at 0 again
    assert stored(spark, lay, "results") == [1, 2]


def test_cut_off_attempts_are_ignored(spark, lay):
    rounds.ingest_round(batch(spark, [1, 2]), lay)
    done = spark.createDataFrame([("a", "m", 1, 1, "[1]", None)], ex.ATTEMPTS)
    done.write.parquet(f"{lay.attempts}/round=0/try=done")
    done.write.parquet(f"{lay.attempts}/round=0/try=cut")
    fs = spark._jvm.org.apache.hadoop.fs.Path(lay.attempts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{lay.attempts}/round=0/try=cut/_SUCCESS"), False)
    calls = spark.sparkContext.accumulator(0)

    def model(prompt):
        calls.add(1)
        return "[2]"
    rounds.extract_round(spark, lay, 0, model=model, wait_s=0.0)
    assert calls.value == 1
    assert {(r.uid, r.response) for r in rounds.read_outputs(spark, lay)["results"].collect()} == {(1, "[1]"), (2, "[2]")}


def test_exit_code_and_counts_of_failing_documents(spark, lay):
    def model(prompt):
        if "s1" in prompt:
            raise RuntimeError("upstream")
        if "s2" in prompt:
            raise RuntimeError("Inappropriate Content")
        return "[]"
    land(spark, lay, [1, 2, 3], 0)
    loop(spark, lay, 3, model=model)
    log = rounds.read_outputs(spark, lay)["round_log"].where("stage = 'extract'").orderBy("round").collect()
    assert [(r.exit_code, r.rows, r.failed, r.blocked) for r in log] == [(2, 3, 1, 1), (2, 1, 1, 0), (2, 1, 1, 0)]
    assert [r.uid for r in rounds.read(spark, lay, "unresolved").collect()] == [1]
    assert stored(spark, lay, "quarantine") == [2]


def test_limit_over_all_landed_files(spark, lay):
    for u in range(1, 7):
        land(spark, lay, [u], u)
    rounds.start(spark, lay.landing + "/*", lay, once=True, max_files_per_trigger=2, ingest_limit=1,
                 wait_s=0.0).awaitTermination()
    assert stored(spark, lay, "documents") == [6]


def test_replay_adds_no_row(spark, lay):
    bad = spark.createDataFrame([("a", "m", 0, b"x", None, None, None), ("a", "m", 0, b"y", None, None, None),
                                 ("a", "m", 5, b"", None, None, None), ("a", "m", 5, message(5), None, None, None)], RAW)
    rnd = rounds.make_round(lay, wait_s=0.0)
    for _ in range(2):
        rnd(bad, 0)
        out = rounds.read_outputs(spark, lay)
        assert sorted(r.uid for r in out["failures"].collect()) in ([0, 0, 5],)
        assert (out["round_log"].count(), out["documents"].count(), out["results"].count()) == (2, 1, 1)


def test_valid_twin_wins_whatever_the_order(spark, lay):
    big, small = message(5, "the longer body"), message(5, "b")
    rows = [("a", "m", 5, b"", None, None, None), ("a", "m", 5, small, None, None, None), ("a", "m", 5, big, None, None, None)]
    for k, order in enumerate((rows, rows[::-1])):
        one = rounds.Layout(f"{lay.base}-{k}")
        rounds.ingest_round(spark.createDataFrame(order, RAW), one)
        out = rounds.read_outputs(spark, one)
        assert [r.body for r in out["documents"].collect()] == ["the longer body"]
        assert [r.uid for r in out["failures"].collect()] == [5]


def test_ranks_see_keys_only(spark, lay):
    from mailweave.operators import numbering as nb
    land(spark, lay, [1, 2, 3], 0)
    rec = ig.normalize_records(spark.read.schema(RAW).parquet(lay.landing + "/*"))
    plan = nb.newest_n(rec.select("account", "mailbox", "uid"), 2, ["account", "mailbox"])._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert "row_number" in plan and scans and not any("raw" in line for line in scans)


def test_unusable_items_are_reported(spark, lay):
    rounds.ingest_round(batch(spark, [1]), lay)
    rounds.extract_round(spark, lay, 0, model=lambda p: '[{"title":"t"},"note"]', wait_s=0.0)
    out = rounds.read_outputs(spark, lay)
    assert [(r.pos, r.title) for r in out["news_items"].collect()] == [(1, "t")]
    assert [(r.stage, r.error) for r in out["failures"].collect()] == [("extract", "item 2 is no object")]


def test_model_options(spark, lay):
    rounds.ingest_round(batch(spark, [1, 2, 3, 4]), lay)

    def slow(prompt):
        assert prompt.endswith("\nbody\n") and "n1@x.org" in prompt or "s1" not in prompt
        time.sleep(0.0 if "s1" in prompt else 3.0)
        return "[]"
    rounds.extract_round(spark, lay, 0, model=slow, wait_s=0.0, concurrency=2, style="cli", timeout_s=0.5)
    assert stored(spark, lay, "results") == [1]
    att = spark.read.parquet(f"{lay.attempts}/round=0")
    assert {r.error for r in att.where("uid > 1").collect()} == {"no answer within 0.5 s"}


def test_full_rescan_and_redownload_as_round_options(spark, lay):
    land(spark, lay, [3], 0)
    loop(spark, lay, strict_high_water=True)
    land(spark, lay, [2], 1)
    loop(spark, lay, strict_high_water=True)          # below the mark
    assert stored(spark, lay, "documents") == [3]
    land(spark, lay, [1], 2)
    loop(spark, lay, strict_high_water=True, full_rescan=True)
    assert stored(spark, lay, "documents") == [1, 3]
    spark.createDataFrame([("a", "m", 3, message(3, "new"), None, None, None)], RAW).write.parquet(f"{lay.landing}/arrival=3")
    loop(spark, lay, redownload=True)
    docs = rounds.read_outputs(spark, lay)["documents"]
    assert {(r.uid, r.body) for r in docs.collect()} == {(1, "body"), (3, "new")}


def test_gap_follows_the_end_of_a_round(spark, lay, monkeypatch):
    pauses = []
    monkeypatch.setattr(rounds, "time", SimpleNamespace(sleep=pauses.append, time=time.time))
    land(spark, lay, [1], 0)
    rounds.run_loop(spark, lay.landing + "/*", lay, gap_s=7.0, max_rounds=3, wait_s=0.0)
    assert pauses == [7.0, 7.0]
    assert rounds.read_outputs(spark, lay)["round_log"].where("stage = 'extract'").count() == 3
