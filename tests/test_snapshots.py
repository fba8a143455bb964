"""Snapshot tables: a crash after any file-system call loses and repeats nothing."""

import itertools
import os
import re

import pytest
from pyspark.sql import functions as F

from mailweave.session import scratch_path
from mailweave.sources import snapshots
from mailweave.sources.snapshots import Files, Store
from mailweave.streaming import rounds

from .conftest import local
from .test_rounds_lose_nothing import batch

SCHEMA, KEYS, PARTS = "k bigint, v string, b bigint", ["k"], ("b",)


class Crash(Exception):
    pass


class Crashing(Files):
    """Changes fail at the ``at``-th one: before it, after it, or half done."""

    def __init__(self, spark, at, how):
        super().__init__(spark)
        self.left, self.how = at, how

    def _step(self, change, half=None):
        self.left -= 1
        if self.left == -1:
            if self.how == "after":
                change()
            elif self.how == "half" and half:
                half()
            raise Crash
        change()

    def create(self, path, data):
        self._step(lambda: Files.create(self, path, data), lambda: Files.create(self, path, data[:len(data) // 2]))

    def delete(self, path):
        self._step(lambda: Files.delete(self, path))

    def write(self, df, path, partition_by):
        self._step(lambda: Files.write(self, df, path, partition_by), lambda: Files.write(self, df.limit(1), path, partition_by))


def rows(spark, pairs):
    return spark.createDataFrame([(k, v, k >> 2) for k, v in pairs], SCHEMA).coalesce(1)


def content(st):
    return sorted((r.k, r.v) for r in st.read("t", SCHEMA, PARTS).collect())


def append(st, spark, pairs):
    st.commit({"t": [st.stage("t", rows(spark, pairs), PARTS)]})


def compacted(st):
    entries = st.stage_compacted("t", SCHEMA, PARTS, [F.col("b")])
    if entries is not None:
        st.commit(replace={"t": entries})
    st.vacuum(keep=1)


@pytest.mark.parametrize("how", ["before", "after", "half"])
def test_crash_at_every_step(spark, how):
    """Append, replace, compact and vacuum, cut off at every change in turn;
    what is read is always the state before or after, and a normal run that
    follows ends in the full table."""
    base = [(k, "old") for k in range(6)]
    stages = {"append": lambda st: append(st, spark, [(9, "new")]),
              "merge": lambda st: st.commit(replace={"t": st.stage_merge("t", rows(spark, [(1, "new"), (40, "new")]), SCHEMA, KEYS, PARTS)}),
              "compact": compacted}
    want = {"append": [*base, (9, "new")], "merge": sorted([(0, "old"), (1, "new"), *base[2:], (40, "new")]), "compact": base}
    for name, stage in stages.items():
        for at in itertools.count():
            path = scratch_path(spark, "crash")
            good = Store(spark, path)
            append(good, spark, base[:3])
            append(good, spark, base[3:])
            try:
                stage(Store(spark, path, Crashing(spark, at, how)))
                done = True
            except Crash:
                done = False
            now = content(good)
            assert now == want[name] or (not done and now == base), (name, at)
            if now == base:
                stage(good)                                  # the next run does it again
            append(good, spark, [(100, "later")])
            compacted(good)
            assert content(good) == sorted([*want[name], (100, "later")]), (name, at)
            if done:
                break
        assert at >= 2


def test_rounds_after_a_crash_in_compaction(spark, monkeypatch):
    """Rounds go on after compactions cut off while folders are written, at the
    manifest, and while old folders are deleted."""
    lay = rounds.Layout(scratch_path(spark, "compact-crash"))
    plain = snapshots.Files
    rounds.ingest_round(batch(spark, [1]), lay)
    rounds.extract_round(spark, lay)
    for uid, at in enumerate((1, 5, 6, 9, None), 2):
        rounds.ingest_round(batch(spark, [uid]), lay)
        rounds.extract_round(spark, lay, candidates=spark.createDataFrame([], rounds.KEY_SCHEMA))
        monkeypatch.setattr(snapshots, "Files", lambda s: Crashing(s, 1000 if at is None else at, ("before", "half", "after")[uid % 3]))
        if at is None:
            rounds.compact(spark, lay)
        else:
            with pytest.raises(Crash):
                rounds.compact(spark, lay)
        monkeypatch.setattr(snapshots, "Files", plain)
        out = rounds.read_outputs(spark, lay)
        assert [sorted(r.uid for r in out[t].select("uid").collect()) for t in ("documents", "results")] == [list(range(1, uid + 1))] * 2
    assert len(rounds.store(spark, lay).manifest().tables["documents"]) == 1


def test_replacing_one_message_rewrites_one_bucket(spark):
    """100,000 messages of a mailbox lie in two buckets; replacing one message
    writes that message and the rest of its bucket, nothing else."""
    lay = rounds.Layout(scratch_path(spark, "merge"))
    st = rounds.store(spark, lay)
    docs = spark.range(1, 100_001).select(
        F.lit("a").alias("account"), F.lit("m").alias("mailbox"), F.col("id").alias("uid"), F.lit("old").alias("subject"))
    full = spark.createDataFrame([], rounds.DOCS_SCHEMA)
    docs = full.unionByName(docs, allowMissingColumns=True)
    st.commit({"documents": [st.stage("documents", rounds._bucketed(docs), rounds.DOCS_PARTITION)]})

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(local(lay.documents)) for f in fs if f.endswith(".parquet")}
    before = files()
    assert len({f.split("bucket=")[1].split("/")[0] for f in before}) == 2
    new = full.unionByName(docs.where("uid = 70000").withColumn("subject", F.lit("new")), allowMissingColumns=True)
    st.commit(replace={"documents": st.stage_merge("documents", rounds._bucketed(new), rounds.DOCS_STORED, ["account", "mailbox", "uid"],
                                                   rounds.DOCS_PARTITION)})
    written = files() - before
    assert before <= files() and {f.split("bucket=")[1].split("/")[0] for f in written} == {"1"}
    assert spark.read.parquet(*written).count() == 100_000 - 65_535
    out = rounds.read(spark, lay, "documents")
    assert out.count() == 100_000 and [r.uid for r in out.where("subject = 'new'").collect()] == [70_000]
    # the hidden partition is pruned at listing, not filtered row by row
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"PartitionFilters: \[\(NOT \(commit#\d+ = ", plan)


def test_merge_of_many_partitions_writes_the_table_anew(spark, monkeypatch):
    st = Store(spark, scratch_path(spark, "many"))
    append(st, spark, [(k, "old") for k in range(40)])
    monkeypatch.setattr(snapshots, "HIDDEN", 3)
    for tag in ("one", "two"):
        st.commit(replace={"t": st.stage_merge("t", rows(spark, [(k, tag) for k in range(0, 44, 4)]), SCHEMA, KEYS, PARTS)})
        assert content(st) == sorted([(k, "old") for k in range(40) if k % 4] + [(k, tag) for k in range(0, 44, 4)])
    assert not any(e.without for e in st.manifest().tables["t"])


def test_tagged_entries_replace_each_other_and_rounds_are_numbered(spark):
    st = Store(spark, scratch_path(spark, "tags"))
    for v in ("a", "b"):
        st.commit({"t": [st.stage("t", rows(spark, [(1, v)]), PARTS, tag="run")]}, facts=st.begun("run"))
    assert content(st) == [(1, "b")]
    assert (st.round_of("run"), st.round_of("next")) == (0, 1)
    st.commit(facts=st.begun("next"))
    assert (st.round_of("run"), st.round_of("next"), st.round_of("third")) == (0, 1, 2)


def test_two_writers_meet(spark):
    st = Store(spark, scratch_path(spark, "two"))
    append(st, spark, [(1, "a")])
    with pytest.raises(Exception, match="exists"):
        st.files.create(f"{st.base}/{snapshots.MANIFESTS}/{0:012d}.json", b"x")
    assert content(st) == [(1, "a")]


def test_a_thousand_hidden_partitions_make_one_flat_filter(spark):
    """What a merge hides does not nest: a table with hundreds of hidden
    partitions is read by one filter, and exactly those are left out."""
    schema, parts = "k bigint, v string, a string, b bigint", ("a", "b")
    table = spark.createDataFrame([(0, "x", "1:", 5), (1, "x", None, 5), (2, "x", "1", 5), (3, "x", "-", 15)], schema)
    st = Store(spark, scratch_path(spark, "flat"))
    staged = [st.stage("t", table.coalesce(1), parts) for _ in range(2)]
    places = tuple((a, b) for b in range(6, 500) for a in ("1:", "-"))[:988]
    hide = (*places, (None, 5), ("1", 5))
    first = snapshots.Entry(staged[0].folder, None, hide)
    st.commit({"t": [first, staged[1]]})
    out = st.read("t", schema, parts)
    assert out._jdf.queryExecution().logical().toString().count("Filter") == 1
    # the second folder hides nothing; of the first, ("-", 15) is among the long list
    assert sorted(r.k for r in out.collect()) == [0, 0, 1, 2, 3]
    assert [r.k for r in table.where(snapshots._among(parts, hide)).orderBy("k").collect()] == [1, 2, 3]


def test_merge_over_two_hundred_partitions(spark):
    schema, parts = "k bigint, v string, b bigint", ("b",)
    table = spark.range(200).selectExpr("id AS k", "'old' AS v", "id AS b").coalesce(1)
    st = Store(spark, scratch_path(spark, "hits"))
    st.commit({"t": [st.stage("t", table, parts)]})
    for tag in ("new", "newer"):
        st.commit(replace={"t": st.stage_merge("t", table.where("k % 2 = 0").withColumn("v", F.lit(tag)), schema, KEYS, parts)})
        assert sorted((r.k, r.v) for r in st.read("t", schema, parts).collect()) == [(k, "old" if k % 2 else tag) for k in range(200)]
