"""Files that cannot be ingested: isolated, retried, given up; the rest is stored."""

import re

import pytest

from mailweave.session import scratch_path
from mailweave.streaming import rounds

from .test_rounds_lose_nothing import land, lay, loop, message, stored  # noqa: F401


def bad(spark, lay, name):
    path = f"{lay.landing}/arrival={name}/part-0.parquet"
    rounds.store(spark, lay).files.create(path, b"no Parquet file")


def ledger(spark, lay):
    return {re.sub(r".*arrival=(\w+)/.*", r"\1", r.file): r.attempts for r in rounds.read(spark, lay, "ledger").collect()}


def test_isolate_finds_the_bad_ones():
    for n in (1, 2, 7, 64):
        for wrong in ({0}, {n - 1}, {0, n - 1}, set(range(n)), set()):
            done = []

            def work(group):
                if wrong & set(group):
                    raise ValueError("bad")
                done.extend(group)
            found, untold = rounds.isolate(list(range(n)), work)
            assert set(found) == wrong & set(range(n)) and not untold
            assert sorted(done) == [k for k in range(n) if k not in wrong]


def test_isolate_stops_trying():
    def work(group):
        raise ValueError("down")
    found, untold = rounds.isolate(list(range(1000)), work, max_tries=50)
    assert len(found) + len(untold) == 1000 and len(untold) > 900


def test_bad_files_block_nothing(spark, lay):  # noqa: F811
    """Two bad files among five arrivals; a bad one alone; all of it as a loop."""
    for k in range(3):
        land(spark, lay, [10 * k + 1, 10 * k + 2], k)
    bad(spark, lay, "x")
    bad(spark, lay, "y")
    loop(spark, lay)
    assert stored(spark, lay, "documents") == stored(spark, lay, "results") == [1, 2, 11, 12, 21, 22]
    assert ledger(spark, lay) == {"x": 1, "y": 1}
    land(spark, lay, [31], 3)                                  # later messages are not held up
    loop(spark, lay)
    assert 31 in stored(spark, lay, "documents") and ledger(spark, lay) == {"x": 2, "y": 2}
    bad(spark, lay, "z")
    loop(spark, lay, 2)
    assert ledger(spark, lay) == {"z": 2}
    failures = rounds.read(spark, lay, "failures").collect()
    assert {(r.uid, r.stage) for r in failures} == {(None, "ingest")} and len(failures) == 2
    assert all("part-0.parquet" in r.error for r in failures)
    loop(spark, lay, 3)
    assert ledger(spark, lay) == {} and rounds.read(spark, lay, "failures").count() == 3
    log = rounds.read(spark, lay, "round_log").where("stage = 'ingest'").orderBy("round").collect()
    assert [r.exit_code for r in log] == [1] * (len(log) - 0) and len({(r.round, r.stage) for r in log}) == len(log)


def test_a_file_that_recovers_is_stored(spark, lay, monkeypatch):  # noqa: F811
    """A file fails twice, then can be read: nothing is lost, nothing reported."""
    land(spark, lay, [1], 0)
    land(spark, lay, [2], 1)
    real, fails = rounds.ingest_round, [0]

    def flaky(batch, *a, **k):
        if any("arrival=1" in f for f in batch.inputFiles()) and fails[0] < 4:
            fails[0] += 1
            raise RuntimeError("not now")
        return real(batch, *a, **k)
    monkeypatch.setattr(rounds, "ingest_round", flaky)
    loop(spark, lay, 4)
    assert stored(spark, lay, "documents") == stored(spark, lay, "results") == [1, 2]
    assert ledger(spark, lay) == {} and rounds.read(spark, lay, "failures").count() == 0


def test_newest_n_is_chosen_among_the_good_files(spark, lay):  # noqa: F811
    for k in range(4):
        land(spark, lay, [k + 1], k)
    bad(spark, lay, "x")
    loop(spark, lay, ingest_limit=2)
    assert stored(spark, lay, "documents") == [3, 4]


def test_odd_folder_names_are_no_patterns(spark):
    import os

    from .conftest import local
    lay = rounds.Layout(scratch_path(spark, "odd-names"))
    land_ = scratch_path(spark, "odd-landing")
    os.makedirs(local(land_) + "/[All] {x}*?/a b")
    with open(local(land_) + "/[All] {x}*?/a b/5.eml", "wb") as f:
        f.write(message(5))
    rounds._ingest_files(spark, lay, rounds.eml_reader("acc", "box"), [land_ + "/[All] {x}*?/a b/5.eml"], "r", None)
    assert stored(spark, lay, "documents") == [5]
    spark.createDataFrame([(7, message(7))], "uid bigint, raw binary").write.parquet(land_ + "/account=a/mailbox=[All]")
    got = rounds.parquet_reader(land_)(spark, [land_ + "/account=a/mailbox=%5BAll%5D/" + n for n in os.listdir(
        local(land_) + "/account=a/mailbox=%5BAll%5D") if n.endswith(".parquet")]) if os.path.isdir(
        local(land_) + "/account=a/mailbox=%5BAll%5D") else None
    if got is not None:
        assert [(r.account, r.uid) for r in got.collect()] == [("a", 7)]


def test_options_of_the_loop(spark, lay):  # noqa: F811
    for k in range(3):
        land(spark, lay, [k + 1], k)
    loop(spark, lay, max_files_per_trigger=1)
    assert stored(spark, lay, "documents") == [1, 2, 3]


def test_rounds_are_numbered_in_one_sequence(spark, lay):  # noqa: F811
    land(spark, lay, [1, 2], 0)
    loop(spark, lay, 2)                                        # the second finds nothing new
    land(spark, lay, [2, 3], 1)
    loop(spark, lay)
    log = rounds.read(spark, lay, "round_log").orderBy("round", "stage").collect()
    assert [(r.round, r.stage) for r in log] == [(0, "extract"), (0, "ingest"), (1, "extract"), (2, "extract"), (2, "ingest")]
    assert [(r.new, r.skipped, r.failed, r.processed) for r in log if r.stage == "ingest"] == [(2, 0, 0, 2), (1, 1, 0, 2)]
