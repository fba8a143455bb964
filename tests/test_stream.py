"""Streaming rounds: replay after a crash, model-path rounds, stream = batch."""

import pytest
from pyspark.sql import functions as F

from mailweave.operators import extract as ex
from mailweave.session import scratch_path
from mailweave.sources import fixtures as fx
from mailweave.sources.snapshots import Store
from mailweave.streaming import rounds

from .conftest import local

SF = "/root/testdata/sf0.001"


def test_crash_before_the_commit_replays_harmlessly(spark, monkeypatch):
    lay = rounds.Layout(scratch_path(spark, "crash"))
    batch = fx.raw_messages(spark, SF)
    n_valid = batch.where("uid <> 0").count()

    def boom(*a, **k):
        raise RuntimeError("driver lost before the commit")
    monkeypatch.setattr(Store, "commit", boom)
    with pytest.raises(RuntimeError):
        rounds.ingest_round(batch, lay)
    monkeypatch.undo()
    out = rounds.read_outputs(spark, lay)
    assert out["documents"].count() == out["state"].count() == 0    # staged, not visible

    rounds.ingest_round(batch, lay)             # the replay
    rounds.ingest_round(batch, lay)             # and one after the commit
    out = rounds.read_outputs(spark, lay)
    docs = out["documents"]
    assert docs.count() == n_valid
    assert docs.select("account", "mailbox", "uid").distinct().count() == n_valid
    marks = {r.mailbox: r.last_uid for r in out["state"].collect()}
    want = {r.mailbox: r.m for r in batch.groupBy("mailbox").agg(F.max("uid").alias("m")).collect()}
    assert marks == want


def test_model_round_reuses_attempt_log(spark):
    lay = rounds.Layout(scratch_path(spark, "model"))
    rounds.ingest_round(fx.fixture_c(spark, SF), lay)
    calls = spark.sparkContext.accumulator(0)

    class Counting(ex.StubModel):
        def __call__(self, prompt, attempt=1):
            calls.add(1)
            return super().__call__(prompt, attempt)

    rounds.extract_round(spark, lay, 0, model=Counting(), wait_s=0.0)
    first = calls.value
    assert first > 0
    res1 = rounds.read(spark, lay, "results").count()
    q1 = rounds.read(spark, lay, "quarantine").count()
    items1 = rounds.read(spark, lay, "news_items").count()
    rounds.extract_round(spark, lay, 0, model=Counting(), wait_s=0.0)   # replay of round 0
    assert calls.value == first                      # no second call of the model
    assert rounds.read(spark, lay, "quarantine").count() == q1
    assert rounds.read(spark, lay, "news_items").count() == items1
    assert rounds.read(spark, lay, "results").count() == res1
    assert rounds.read(spark, lay, "results").select("account", "mailbox", "uid").distinct().count() == res1
    out = rounds.read_outputs(spark, lay)
    assert out["news_items"].count() > 0
    assert out["news_items"].where("date is null or sender is null").count() == 0
    assert q1 > 0
    # next round: only failed documents are pending again
    docs = out["documents"]
    pend = ex.pending_docs(docs, rounds.read(spark, lay, "results"), rounds.read(spark, lay, "quarantine"))
    failed = ex.attempt_outcome(spark.read.parquet(f"{lay.attempts}/round=0")).where("outcome = 'failed'")
    assert pend.count() == failed.count()


def _tables(spark, lay):
    def keyset(path, cols):
        return sorted(tuple(r) for r in rounds.read(spark, lay, path).select(*cols).collect())
    return (keyset("results", ["account", "mailbox", "uid", "response"]),
            keyset("quarantine", ["account", "mailbox", "uid", "error"]),
            keyset("news_items", ["uid", "pos", "title", "date", "sender"]))


def test_incremental_extract_equals_full_reconciliation(spark):
    raw = fx.fixture_c(spark, SF)
    halves = [raw.where(F.col("uid") % 2 == 0), raw.where(F.col("uid") % 2 == 1)]
    inc = rounds.Layout(scratch_path(spark, "inc"))
    full = rounds.Layout(scratch_path(spark, "full"))
    for rnd, half in enumerate(halves):
        _, written = rounds.ingest_round(half, inc)
        rounds.extract_round(spark, inc, rnd, model=ex.StubModel(), wait_s=0.0,
                             candidates=None if rnd == 0 else written)
        rounds.ingest_round(half, full)
        rounds.extract_round(spark, full, rnd, model=ex.StubModel(), wait_s=0.0)
    assert _tables(spark, inc) == _tables(spark, full)
    # round 1 called the model for its new documents and for round 0's failures only
    failed0 = ex.attempt_outcome(spark.read.parquet(f"{inc.attempts}/round=0")).where("outcome = 'failed'")
    called1 = spark.read.parquet(f"{inc.attempts}/round=1").select("uid").distinct()
    assert called1.count() == halves[1].count() + failed0.count()


def test_strict_high_water_and_limits(spark):
    lay = rounds.Layout(scratch_path(spark, "limits"))
    raw = fx.fixture_a(spark, SF)                       # mailbox INBOX, uids 0..49
    tables = rounds.store(spark, lay)
    tables.commit({"state_log": [tables.stage("state_log", spark.createDataFrame(
        [("desk", "INBOX", 30)], "account string, mailbox string, last_uid bigint"))]})
    n, written = rounds.ingest_round(raw, lay, strict_high_water=True, limit=5)
    uids = sorted(r.uid for r in written.collect())
    assert uids == [45, 46, 47, 48, 49]                 # above the mark, newest five only
    assert rounds.read_outputs(spark, lay)["state"].first().last_uid == 49
    # extraction limited to 2 per round; the deferred rest is picked up incrementally
    rounds.extract_round(spark, lay, 0, candidates=written, limit=2)
    done = {r.uid for r in rounds.read(spark, lay, "results").collect()}
    assert done == {48, 49}
    rounds.extract_round(spark, lay, 1, candidates=written.limit(0), limit=2)
    rounds.extract_round(spark, lay, 2, candidates=written.limit(0), limit=2)
    done = sorted(r.uid for r in rounds.read(spark, lay, "results").collect())
    assert done == uids


def test_compaction_keeps_tables_equal(spark):
    lay = rounds.Layout(scratch_path(spark, "compact"))
    raw = fx.fixture_b(spark, SF)
    for i in range(3):
        _, written = rounds.ingest_round(raw.where(F.col("uid") % 3 == i), lay)
        rounds.extract_round(spark, lay, i, candidates=None if i == 0 else written)
    before = {k: sorted(map(tuple, v.collect())) for k, v in rounds.read_outputs(spark, lay).items()
              if k in ("documents", "news_items", "results", "state")}
    n_files = len(rounds.read(spark, lay, "documents").inputFiles())
    rounds.compact(spark, lay)
    after = {k: sorted(map(tuple, v.collect())) for k, v in rounds.read_outputs(spark, lay).items()
             if k in ("documents", "news_items", "results", "state")}
    assert before == after
    assert len(rounds.read(spark, lay, "documents").inputFiles()) < n_files
    assert rounds.read(spark, lay, "state_log").count() == 1


def test_eml_folder_stream(spark):
    import os
    lay = rounds.Layout(scratch_path(spark, "eml-stream"))
    land = scratch_path(spark, "eml-landing")
    os.makedirs(local(land))

    def eml(u, sender):
        return (f"From: N <{sender}@x.org>\r\nSubject: s{u}\r\nContent-Type: text/html\r\n\r\n"
                f'<p>hi</p><a href="https://x/{u}">t{u}</a>').encode()
    for u in (3, 4, 5):
        with open(os.path.join(local(land), f"{u}.eml"), "wb") as f:
            f.write(eml(u, f"n{u}"))
    rounds.start_eml(spark, land, "acc", "INBOX", lay, once=True, wait_s=0.0).awaitTermination()
    with open(os.path.join(local(land), "6.eml"), "wb") as f:          # a later arrival
        f.write(eml(6, "n3"))
    rounds.start_eml(spark, land, "acc", "INBOX", lay, once=True, wait_s=0.0).awaitTermination()
    out = rounds.read_outputs(spark, lay)
    assert sorted((r.uid, r.subject) for r in out["documents"].collect()) == [
        (3, "s3"), (4, "s4"), (5, "s5"), (6, "s6")]
    items = sorted((r.uid, r.url, r.sender) for r in out["news_items"].collect())
    assert items == [(3, "https://x/3", "n3@x.org"), (4, "https://x/4", "n4@x.org"),
                     (5, "https://x/5", "n5@x.org"), (6, "https://x/6", "n3@x.org")]
    assert out["state"].first().last_uid == 6


def test_failed_ingest_does_not_stop_extraction(spark, monkeypatch):
    lay = rounds.Layout(scratch_path(spark, "isolation"))
    rounds.ingest_round(fx.fixture_a(spark, SF), lay)        # documents stored by an earlier round

    def broken(*a, **k):
        raise RuntimeError("mail source unreachable")
    monkeypatch.setattr(rounds, "ingest_round", broken)
    rnd = rounds.make_round(lay, wait_s=0.0)
    with pytest.raises(RuntimeError):                        # the batch has to come again
        rnd(fx.fixture_a(spark, SF), 7)
    log = {r.stage: r.exit_code for r in rounds.read(spark, lay, "round_log").collect()}
    assert log == {"ingest": 1, "extract": 0}
    # extraction ran as a full reconciliation over what was already stored
    assert rounds.read(spark, lay, "results").count() == fx.fixture_a(spark, SF).where("uid <> 0").count()


def test_redownload_replaces_documents(spark):
    lay = rounds.Layout(scratch_path(spark, "redownload"))
    schema = ("account string, mailbox string, uid bigint, raw binary, size bigint, "
              "labels array<string>, thread_id string")

    def batch(tag, uids):
        return spark.createDataFrame(
            [("acc", "INBOX", u, f"From: a@x.org\r\nSubject: {tag}{u}\r\n\r\nbody".encode(), None, None, None)
             for u in uids], schema)
    rounds.ingest_round(batch("old", [1, 2, 3]), lay)
    rounds.ingest_round(batch("new", [2, 3]), lay)                  # insert-if-absent: skipped
    subj = lambda: sorted((r.uid, r.subject) for r in rounds.read_outputs(spark, lay)["documents"].collect())
    assert subj() == [(1, "old1"), (2, "old2"), (3, "old3")]
    rounds.ingest_round(batch("new", [2, 3]), lay, redownload=True)  # replaced by key
    assert subj() == [(1, "old1"), (2, "new2"), (3, "new3")]


def test_bounded_micro_batches_drain_everything(spark):
    import os
    lay = rounds.Layout(scratch_path(spark, "bounded"))
    land = scratch_path(spark, "bounded-landing")
    os.makedirs(local(land))
    for u in range(1, 8):
        with open(os.path.join(local(land), f"{u}.eml"), "wb") as f:
            f.write(f"From: a@x.org\r\nSubject: s{u}\r\n\r\nbody".encode())
    q = rounds.start_eml(spark, land, "acc", "INBOX", lay, once=True, max_files_per_trigger=3,
                         stages=("ingest",))
    q.awaitTermination()
    out = rounds.read_outputs(spark, lay)
    assert out["documents"].count() == 7
    assert out["round_log"].count() == 3                 # 3 + 3 + 1 files


@pytest.mark.parametrize("model", [None, ex.StubModel()])
def test_crash_while_results_are_staged_replays_once(spark, monkeypatch, model):
    lay = rounds.Layout(scratch_path(spark, "items-crash"))
    rounds.ingest_round(fx.fixture_c(spark, SF) if model else fx.fixture_a(spark, SF), lay)
    real = Store.stage

    def stage_then_crash(self, table, *a, **k):          # the items are written, nothing after them
        out = real(self, table, *a, **k)
        if table == "news_items":
            raise RuntimeError("lost")
        return out
    monkeypatch.setattr(Store, "stage", stage_then_crash)
    with pytest.raises(RuntimeError):
        rounds.extract_round(spark, lay, 0, model=model, wait_s=0.0)
    monkeypatch.undo()
    assert rounds.read(spark, lay, "news_items").count() == rounds.read(spark, lay, "results").count() == 0
    rounds.extract_round(spark, lay, 0, model=model, wait_s=0.0)            # the replay
    n_items, n_results = (rounds.read(spark, lay, t).count() for t in ("news_items", "results"))
    assert n_items > 0 and n_results > 0
    rounds.extract_round(spark, lay, 0, model=model, wait_s=0.0)            # and another
    assert (n_items, n_results) == tuple(rounds.read(spark, lay, t).count() for t in ("news_items", "results"))
    if model is None:
        assert n_results == fx.fixture_a(spark, SF).where("uid <> 0").count()
