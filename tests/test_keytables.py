"""Key tables in buckets: equal to plain set differences, without an exchange."""

import random

import pytest

from mailweave.schemas import KEYS
from mailweave.session import scratch_path
from mailweave.sources.keytables import BUCKETS_CONF, FOLDERS, SCHEMA, KeyTables
from mailweave.sources.snapshots import Files, Store


@pytest.fixture
def tables(spark):
    store = Store(spark, scratch_path(spark, "keytables"))
    spark.conf.set(BUCKETS_CONF, "4")
    yield store
    spark.conf.unset(BUCKETS_CONF)


def add(store, table, keys):
    df = store.spark.createDataFrame([(*k, "wide") for k in keys], f"{SCHEMA}, body string")
    store.commit({table: [store.stage(table, df)]})


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def keys(df):
    return sorted(map(tuple, df.collect()))


def some(rng, n):
    # a third of all rows in one mailbox
    return [(rng.choice("ab"), "INBOX" if rng.random() < 0.3 else f"m{rng.randrange(9)}", rng.randrange(400)) for _ in range(n)]


def test_pending_equals_the_set_difference(spark, tables):
    rng, kt = random.Random(1), KeyTables(tables)
    stored = {"documents": set(), "results": set(), "quarantine": set()}
    for step in range(4):
        for t, n in (("documents", 300), ("results", 120), ("quarantine", 9)):
            if step or t != "quarantine":
                new = some(rng, n)
                stored[t] |= set(new)
                add(tables, t, new)
        kt.sync("documents", "results", "quarantine")
        for t in stored:
            assert keys(kt.read(t)) == sorted(stored[t])
        assert keys(kt.missing("documents", "results", "quarantine")) == sorted(stored["documents"] - stored["results"] - stored["quarantine"])


def test_no_exchange_on_either_side(spark, tables):
    kt, rng = KeyTables(tables), random.Random(2)
    for t in ("documents", "results", "quarantine"):
        for _ in range(2):
            add(tables, t, some(rng, 200))
            kt.sync(t)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            text = plan(kt.missing("documents", "results", "quarantine"))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert "Exchange" not in text and text.count("SortMergeJoin") >= 2 and "PartitionFilters: [commit" in text


def test_building_the_plan_runs_no_job(spark, tables):
    kt = KeyTables(tables)
    for t in ("documents", "results"):
        add(tables, t, [("a", "m", 1), ("a", "m", 2)] if t == "documents" else [("a", "m", 2)])
    kt.sync("documents", "results")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-missing", "build")
    try:
        df = kt.missing("documents", "results")
        assert len(tracker.getJobIdsForGroup("build-missing")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert keys(df) == [("a", "m", 1)]


def test_rewritten_folders_add_no_key(spark, tables):
    """Compaction and keyed replacement repeat keys; a sync after them adds none."""
    kt, schema = KeyTables(tables), f"{SCHEMA}, body string"
    for k in range(3):
        add(tables, "documents", [("a", "m", 10 * k + j) for j in range(5)])
    kt.sync("documents")
    want = keys(kt.read("documents"))
    tables.commit(replace={"documents": tables.stage_compacted("documents", schema)})
    kt.sync("documents")
    new = spark.createDataFrame([("a", "m", 3, "new"), ("a", "m", 99, "new")], schema)
    tables.commit(replace={"documents": tables.stage_merge("documents", new, schema, KEYS, ("account", "mailbox"))})
    kt.sync("documents")
    assert keys(kt.read("documents")) == sorted([*want, ("a", "m", 99)])


def test_a_sync_cut_off_is_not_seen_and_comes_again(spark, tables):
    class NoCommit(Files):
        def create(self, path, data):
            raise OSError("cut off")
    add(tables, "documents", [("a", "m", 1)])
    KeyTables(tables).sync("documents")
    add(tables, "documents", [("a", "m", 2)])
    with pytest.raises(OSError):
        KeyTables(Store(spark, tables.base, NoCommit(spark))).sync("documents")
    assert keys(KeyTables(tables).read("documents")) == [("a", "m", 1)]
    KeyTables(tables).sync("documents")
    assert keys(KeyTables(tables).read("documents")) == [("a", "m", 1), ("a", "m", 2)]
    tables.vacuum(keep=1)
    assert keys(KeyTables(tables).read("documents")) == [("a", "m", 1), ("a", "m", 2)]


def test_many_folders_become_one(spark, tables):
    kt = KeyTables(tables)
    for k in range(FOLDERS + 1):
        add(tables, "results", [("a", "m", k)])
        kt.sync("results")
    assert len(tables.manifest().tables["results_keys"]) == 1
    assert keys(kt.read("results")) == [("a", "m", k) for k in range(FOLDERS + 1)]


def test_empty_tables_and_the_number_of_buckets(spark, tables):
    kt = KeyTables(tables)
    kt.sync("documents", "results")
    assert keys(kt.missing("documents", "results")) == []
    add(tables, "documents", [])
    add(tables, "results", [("a", "m", 1)])
    kt.sync("documents", "results")
    assert keys(kt.missing("documents", "results")) == [] and keys(kt.missing("results", "documents")) == [("a", "m", 1)]
    spark.conf.set(BUCKETS_CONF, "7")           # a store keeps the number it began with
    assert KeyTables(tables).buckets == 4


def test_full_reconciliation_of_rounds(spark, tmp_path):
    """Rounds in between change what is pending; every call sees the last commit."""
    from mailweave.operators import ingest as ig
    from mailweave.sources import fixtures as fx
    from mailweave.streaming import rounds

    from .conftest import SF_SMALL
    lay = rounds.Layout(scratch_path(spark, "keytables-rounds"))
    raw = fx.fixture_a(spark, SF_SMALL)
    uids = sorted(r.uid for r in ig.valid_records(ig.normalize_records(raw)).select("uid").collect())
    half = uids[len(uids) // 2]
    assert keys(rounds.pending_keys(spark, lay)) == []
    rounds.ingest_round(raw.where(f"uid < {half}"), lay)
    assert [k[2] for k in keys(rounds.pending_keys(spark, lay))] == [u for u in uids if u < half]
    rounds.extract_round(spark, lay)
    assert keys(rounds.pending_keys(spark, lay)) == []
    rounds.ingest_round(raw, lay)
    rounds.compact(spark, lay)
    assert [k[2] for k in keys(rounds.pending_keys(spark, lay))] == [u for u in uids if u >= half]
    assert rounds.extract_round(spark, lay).rows == sum(u >= half for u in uids)
    assert keys(rounds.pending_keys(spark, lay)) == []
