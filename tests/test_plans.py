"""Plan properties the scale design relies on (guards against regressions)."""

import re

from mailweave.operators import extract as ex
from mailweave.operators import ingest as ig
from mailweave.operators import numbering as nb
from mailweave.session import scratch_path
from mailweave.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
KEYS = ["account", "mailbox", "uid"]


def physical(df) -> str:
    """The planned physical plan before adaptive re-planning."""
    return df._jdf.queryExecution().sparkPlan().toString()


def jobs_of(spark, build):
    """Jobs that run while ``build()`` makes a plan."""
    import uuid
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "build")
    try:
        df = build()
        return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def landed(spark, mailboxes=3, n=1000):
    """Raw messages in Parquet files, one per mailbox and 250 uids."""
    from mailweave.schemas import RAW_MESSAGES
    path = scratch_path(spark, "landed")
    df = spark.range(1, n + 1).selectExpr(f"explode(sequence(1, {mailboxes})) AS m", "id AS uid").selectExpr(
        "'a' AS account", "concat('m', m) AS mailbox", "uid", "encode('x', 'UTF-8') AS raw", "1L AS size",
        "CAST(NULL AS array<string>) AS labels", "CAST(NULL AS string) AS thread_id", "CAST((uid - 1) / 250 AS int) AS piece")
    for m in range(1, mailboxes + 1):
        for piece in range(n // 250):
            df.where(f"mailbox = 'm{m}' AND piece = {piece}").drop("piece").coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(RAW_MESSAGES).parquet(path)


def test_marks_are_pushed_into_the_scan(spark):
    raw = landed(spark)
    marks = {("a", "m1"): 900, ("a", "m2"): 990}
    got, jobs = jobs_of(spark, lambda: ig.high_water_filter(raw, marks).select(*KEYS))
    assert jobs == 0
    explained = spark.sparkContext._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: (.*)", explained)[1]
    assert "GreaterThan(uid,900)" in pushed and "GreaterThan(uid,990)" in pushed
    state = spark.createDataFrame([(a, m, u) for (a, m), u in marks.items()], "account string, mailbox string, last_uid bigint")
    want = ig.high_water_filter(raw, state).select(*KEYS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 100 + 10 + 1000
    # all files of m1 but the last are passed over by their statistics: the scan gives fewer rows than there are
    one = ig.high_water_filter(raw.where("mailbox <> 'm3'"), marks).select(*KEYS)
    one.collect()
    scans = [int(x.replace(",", "")) for x in scan_rows(one)]
    assert sum(scans) <= 500 < 2000


def scan_rows(df):
    """Rows that the file scans of an executed plan gave out."""
    node = df._jdf.queryExecution().executedPlan()
    leaves = node.collectLeaves()
    out = []
    for i in range(leaves.length()):
        leaf = leaves.apply(i)
        inner = leaf.executedPlan().collectLeaves() if leaf.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else None
        for x in ([inner.apply(j) for j in range(inner.length())] if inner else [leaf]):
            if x.metrics().contains("numOutputRows"):
                out.append(str(x.metrics().apply("numOutputRows").value()))
    return out


def test_plans_are_built_without_jobs(spark):
    """No operator runs a job while its plan is built; reconcile has one exchange by key."""
    from mailweave.operators import report as rp
    from mailweave.operators import state as st
    raw = landed(spark, 1)
    stored = landed(spark, 2, 500).select(*KEYS)
    state = spark.createDataFrame([("a", "m1", 10)], "account string, mailbox string, last_uid bigint")
    for build in (lambda: ig.high_water_filter(raw, state),
                  lambda: ig.insert_if_absent(raw, stored, probe=raw.select(*KEYS)),
                  lambda: ex.pending_docs(raw, stored, stored),
                  lambda: ex.pending_docs(raw, stored, None, candidates=stored),
                  lambda: nb.newest_n(raw.select(*KEYS), 5, ["account", "mailbox"]),
                  lambda: st.advance(state, raw),
                  lambda: rp.ingest_summary(rp.run_reconcile(raw, stored, stored), ig.invalid_records(raw))):
        assert jobs_of(spark, build)[1] == 0
    plan = physical(rp.run_reconcile(raw, stored, stored))
    assert plan.count("hashpartitioning(account") <= 1 and plan.count("SortMergeJoin") == 0
    aggregates = [line for line in plan.splitlines() if "bit_or" in line]
    assert len(aggregates) == 2 and "partial_bit_or" in "".join(aggregates)         # combined before the exchange


def test_newest_n_ranks_only_the_last_ranges(spark):
    """Ranges before those that hold the newest N are dropped before the window."""
    df = spark.range(1, 200_001).selectExpr("'a' AS account", "CAST(id % 2 AS string) AS mailbox", "id AS uid")
    for n in (1, 5, 700):
        got = nb.newest_n(df, n, ["account", "mailbox"])
        assert sorted(r.uid for r in got.collect()) == list(range(200_001 - 2 * n, 200_001))
    seen = nb.rank_in_group(df, ["account", "mailbox"], "uid", bits=10, descending=True, newest=100)
    assert seen.count() <= 2 * (100 + 1024) and seen.where("rank <= 100").count() == 200
    gaps = df.where("mailbox = '0' AND uid % 50000 < 3")
    assert sorted(r.uid for r in nb.rank_in_group(gaps, ["account", "mailbox"], "uid", bits=4, descending=True, newest=3)
                  .where("rank <= 3").collect()) == sorted(r.uid for r in gaps.collect())[-3:]


def test_high_water_marks_are_broadcast(spark):
    raw = ig.normalize_records(fx.raw_messages(spark, SF))
    plan = physical(ig.high_water_filter(raw, fx.fixture_e_state(spark, SF)))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_insert_if_absent_cuts_the_archive_by_range_map_side(spark):
    path = scratch_path(spark, "plan-docs")
    fx.message_keys(spark, SF).write.partitionBy("account", "mailbox").parquet(path)
    batch = spark.read.parquet(path).where("uid % 5 = 0")
    existing = spark.read.parquet(path)
    plan = physical(ig.insert_if_absent(batch, existing, probe=batch.select(*KEYS)))
    # the range cut is a broadcast join with the uid-range condition
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan)
    assert "_lo" in plan and "_hi" in plan


def test_rank_windows_are_bounded_by_uid_range(spark):
    df = fx.message_keys(spark, SF)
    plan = physical(nb.newest_n(df, 10, ["account", "mailbox"]))
    row_number_windows = [l for l in plan.splitlines() if "row_number()" in l]
    assert row_number_windows and all("_r" in l for l in row_number_windows)


def test_pending_candidates_read_only_keys_of_results(spark):
    res_path = scratch_path(spark, "plan-results")
    ex.repair(fx.fixture_f_responses(spark, SF).selectExpr("*", "'ok' as outcome")) \
        .write.parquet(res_path)
    results = spark.read.parquet(res_path)
    docs = fx.message_keys(spark, SF).selectExpr("*", "'body' as body")
    cand = fx.message_keys(spark, SF).where("uid % 7 = 0")
    plan = physical(ex.pending_docs(docs, results, None, candidates=cand))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "response" not in l and "uid" in l]
    assert scans                                             # results scanned without the response column
    assert not any("response" in l for l in plan.splitlines() if "FileScan" in l)


def test_parse_is_one_map_only_python_stage(spark):
    raw = ig.normalize_records(fx.fixture_a(spark, SF))
    plan = physical(ig.to_documents(ig.parse_messages(raw)))
    assert plan.count("MapInArrow") == 1
    assert "BatchEvalPython" not in plan                     # no row-at-a-time Python UDF
