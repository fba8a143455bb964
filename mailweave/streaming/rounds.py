"""Streaming rounds: ingest, then extract (#38-#41).

A file stream over the landing folder finds new files without opening them;
``foreachBatch`` runs one round per micro-batch, which reads those files as a
batch plan, so that column pruning and pushed filters reach them:

1. ingest  - one row per key -> insert-if-absent against the document table ->
   parse -> documents, failures, state marks and the keys still to extract;
2. extract - unresolved documents without a result and not quarantined ->
   default rule extractor, or a model callable with bounded retries whose
   completed attempts are never repeated -> results, items, quarantine;
3. a row per (round, stage) in ``round_log``.

The keys of a data folder of documents are noted beside it, in
``document_keys``: what a round compares with is read from there, and of the
documents only folders that hold an open one.

Tables live in a :class:`~mailweave.sources.snapshots.Store`: everything a
stage writes becomes visible with one commit, or not at all, so a stage that
is cut off anywhere is simply run again.

A file that cannot be ingested stops nothing: a failed batch is halved until
the bad files stand alone, the rest is stored, and the bad ones go to
``ledger``, to be tried again in the rounds that follow; after ``GIVE_UP``
failures a file becomes a row of ``failures``.  A failed ingest does not stop
the extraction of what is stored, and every open document is looked at in every
round.  :func:`run_loop` repeats rounds with the pause counted from the end of
a round, also when nothing new has landed.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract as ex
from ..operators import ingest as ig
from ..operators import joins
from ..operators import numbering as nb
from ..operators import report as rp
from ..operators import state as st
from ..schemas import DOCUMENTS_MD, FAILURES, KEYS, LEDGER, NEWS_ITEMS, QUARANTINE, RAW_MESSAGES, RESULTS, STATE
from ..session import scratch_path, shared_dir
from ..sources import tables as tb
from ..sources.keytables import KeyTables
from ..sources.snapshots import Entry, Store

DEFAULT_INTERVAL_S = 901
# Files per micro-batch: a first start over a large landing folder drains it
# in bounded rounds (availableNow honours it too) instead of one huge batch.
# With a limit all landed files make one batch, since the newest N are chosen
# among everything that is not processed yet.
MAX_FILES_PER_TRIGGER = 10_000
#: failures of a file by itself after which it is given up: first try + 3 retries
GIVE_UP = 4
#: tries to split a failed batch in one round; files not told apart by then wait for the next round
MAX_TRIES = 200
#: rounds between two compactions
COMPACT_EVERY = 50
#: tasks for each core that messages are parsed and searched in
TASKS_PER_CORE = 4
KEY_SCHEMA = "account string, mailbox string, uid bigint"
DOCS_SCHEMA = DOCUMENTS_MD + ", html string"
#: stored documents also carry their bucket, a range of uids: what a keyed replacement rewrites
BUCKET_BITS = 16
DOCS_STORED, DOCS_PARTITION = DOCS_SCHEMA + ", bucket bigint", ("account", "mailbox", "bucket")
SCHEMAS = {"documents": DOCS_SCHEMA, "state_log": STATE, "failures": FAILURES, "results": RESULTS, "news_items": NEWS_ITEMS,
           "quarantine": QUARANTINE, "round_log": rp.ROUND_LOG, "unresolved": KEY_SCHEMA, "ledger": LEDGER}
FOLDERS = (*SCHEMAS, "attempts", "checkpoint", "landing")


@dataclass
class Layout:
    """Table folders of one pipeline, all under the shared folder."""
    base: str

    def __getattr__(self, name):
        if name in FOLDERS:
            return f"{self.base}/{name}"
        raise AttributeError(name)


class Extracted(NamedTuple):
    """Documents a round extracted, and of them those that failed or were blocked."""
    rows: int
    failed: int
    blocked: int


class Ingested(tuple):
    """(messages parsed, keys of the batch that are stored now), and the run's
    ``counts``: new, skipped, failed, processed."""

    def __new__(cls, rows: int, stored: DataFrame, counts: dict[str, int]):
        self = super().__new__(cls, (rows, stored))
        self.counts = counts
        return self


def store(spark: SparkSession, lay: Layout) -> Store:
    return Store(spark, lay.base)


def read(spark: SparkSession, lay: Layout, table: str) -> DataFrame:
    """A stored table, as of its last commit."""
    if table == "documents":
        return _documents(store(spark, lay)).drop("bucket")
    return store(spark, lay).read(table, SCHEMAS[table])


def _documents(tables: Store, **which) -> DataFrame:
    return tables.read("documents", DOCS_STORED, DOCS_PARTITION, **which)


def _note_keys(spark: SparkSession, tables: Store, keys: DataFrame, folder: str) -> Entry:
    """The keys of a data folder of documents, staged in a few files, as the
    folder gives them back: an empty partition value comes back as NULL."""
    account, mailbox = (F.nullif(F.col(c), F.lit("")).alias(c) for c in ("account", "mailbox"))
    keys = keys.select(account, mailbox, "uid", F.lit(folder).alias("folder")).coalesce(spark.sparkContext.defaultParallelism)
    return tables.stage("document_keys", keys, tag=folder)


def _document_keys(spark: SparkSession, tables: Store) -> DataFrame:
    """Keys and data ``folder`` of the stored documents.  A folder whose keys
    were noted is not opened: its documents lie in a file or more per bucket."""
    manifest = tables.manifest()
    noted = {e.tag: e.folder for e in manifest.tables.get("document_keys", [])}
    others = {e.folder for e in manifest.tables.get("documents", []) if e.without or e.folder not in noted}
    here = {noted[e.folder] for e in manifest.tables.get("documents", []) if e.folder not in others}
    read = _documents(tables, manifest=manifest, folder="folder", only=others).select(*KEYS, "folder")
    return (tables.read("document_keys", KEY_SCHEMA + ", folder string", manifest=manifest, only=here)
            .unionByName(read.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))


def _bucketed(docs: DataFrame) -> DataFrame:
    """Documents as they are stored: few files of even size, a large mailbox in several of them."""
    return docs.withColumn("bucket", F.shiftright(F.col("uid"), BUCKET_BITS)).hint("rebalance", *map(F.col, DOCS_PARTITION))


def _dealt(messages: DataFrame) -> DataFrame:
    """Messages dealt evenly, by key, to a few tasks for each core: files differ in
    what a message of theirs costs, and are as many as the writer made."""
    return messages.repartition(TASKS_PER_CORE * messages.sparkSession.sparkContext.defaultParallelism, *map(F.col, KEYS))


def _marks(state: DataFrame):
    """The state for :func:`~mailweave.operators.ingest.high_water_filter`:
    literal marks while they are few, else the table."""
    rows = state.select("account", "mailbox", "last_uid").limit(ig.MAX_LITERAL_MARKS + 1).collect()
    return state if len(rows) > ig.MAX_LITERAL_MARKS else {(r.account, r.mailbox): r.last_uid for r in rows}


def ingest_round(batch: DataFrame, lay: Layout, strict_high_water: bool = False, limit: int | None = None,
                 redownload: bool = False, full_rescan: bool = False, run: str | None = None) -> Ingested:
    """One ingest round over raw messages, visible with its one commit.

    ``limit`` keeps only the newest ``limit`` messages per mailbox (the mark
    still advances past the others, so they are never fetched later).
    ``full_rescan`` ignores the high-water marks; ``redownload`` does so too
    and replaces stored documents of the same key instead of skipping them.
    ``run`` names the round; a replay under the same name replaces the
    failures it reported.  Returns (messages parsed, keys of the batch that
    are stored now), the extraction stage's candidates.
    """
    spark = batch.sparkSession
    shared_dir(spark)
    tables, run = store(spark, lay), run or uuid.uuid4().hex
    rec = ig.normalize_records(batch)
    keys = rec.select(*KEYS)               # key columns only: never reads the raw bytes
    old_state = st.fold(tables.read("state_log", STATE))
    chosen = keys.where(F.col("uid") != 0).distinct()
    if strict_high_water and not (full_rescan or redownload):
        marks = _marks(old_state)
        chosen, rec = ig.high_water_filter(chosen, marks), ig.high_water_filter(rec, marks)
    cand = joins.dedupe_by_key(rec, KEYS, ig.is_valid(rec), [F.col("size"), F.md5("raw")])
    if limit:
        # ranks are taken of keys; the wide rows follow by a semi-join
        cand = cand.join(joins.bounded_broadcast(nb.newest_n(chosen, limit, ["account", "mailbox"])), KEYS, "left_semi")
    # the batch's keys bound the part of the archive to compare with, which is read once
    before = ig.stored_keys(_document_keys(spark, tables), keys).checkpoint(eager=True)
    new = cand if redownload else ig.insert_valid_if_absent(cand, before)
    # Invalid records (uid 0, empty message) ride along and come out of the
    # parse stage flagged, so the raw column is read exactly once.  Reliable
    # checkpoint, not persist: a lost executor never re-runs the parse.
    parsed = ig.parse_messages(_dealt(new)).checkpoint(eager=True)
    docs = _bucketed(ig.to_documents(parsed, keep_html=True))
    # what became of every listed message: from keys and errors, so that the payloads are not read for each count
    outcome = parsed.select(*KEYS, "parse_error").checkpoint(eager=True)
    failures = ig.parse_failures(outcome)
    written = outcome.where(F.col("parse_error").isNull()).select(*KEYS)
    status = rp.run_reconcile(keys.where(F.col("uid") != 0), before, before.unionByName(written)).checkpoint(eager=True)
    total = rp.ingest_summary(status, failures).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rp.COUNTS]).first()
    stored = status.where("status <> 'missing'").select(*KEYS)

    add: dict[str, list[Entry]] = {"failures": [tables.stage("failures", failures, tag=f"{run}-ingest")]} if total.failed else {}
    replace: dict[str, list[Entry]] = {}
    if redownload:
        replace["documents"] = tables.stage_merge("documents", docs, DOCS_STORED, KEYS, DOCS_PARTITION)
    else:
        staged = tables.stage("documents", docs, DOCS_PARTITION)
        add["documents"], add["document_keys"] = [staged], [_note_keys(spark, tables, written, staged.folder)]
    # every fetched record counts toward the mark, as in the reference
    replace["state_log"] = [tables.stage("state_log", st.advance(old_state, keys.where(F.col("uid") > 0)).coalesce(1))]
    replace["unresolved"] = [tables.stage("unresolved", _unresolved(spark, lay).unionByName(stored).distinct())]
    tables.commit(add, replace)
    counts = {c: total[c] for c in rp.COUNTS}
    return Ingested(written.count(), stored, counts)


def _unresolved(spark: SparkSession, lay: Layout) -> DataFrame:
    """Keys of stored documents that have neither a result nor a quarantine
    row; where no round has noted them yet, everything stored counts."""
    tables = store(spark, lay)
    if "unresolved" in tables.manifest().tables:
        return tables.read("unresolved", KEY_SCHEMA)
    return _document_keys(spark, tables).select(*KEYS)


def pending_keys(spark: SparkSession, lay: Layout) -> DataFrame:
    """Keys of all stored documents without a result or a quarantine row: the
    full reconciliation.  The key tables are brought up to date first, which
    exchanges the keys written since the last time; then bucket meets bucket."""
    known = KeyTables(store(spark, lay))
    known.sync("documents", "results", "quarantine")
    return known.missing("documents", "results", "quarantine")


def _attempts(spark: SparkSession, lay: Layout, rnd: str, pending: DataFrame, model, wait_s: float,
              concurrency: int | None, style: str, timeout_s: float | None) -> DataFrame:
    """All attempts of the round; the model is called only for pending
    documents without a completed attempt in it."""
    folder = f"{lay.attempts}/round={rnd}"
    tries = [spark.read.schema(ex.ATTEMPTS).parquet(f"{folder}/{name}") for name in tb.folders(spark, folder)]
    todo = pending
    for t in tries:
        todo = joins.anti_join_recent(todo, t, KEYS)
    prompts = todo.select(*KEYS, ex.prompt_assemble(todo, ex.document_text(), style).alias("prompt"))
    path = f"{folder}/try={uuid.uuid4().hex[:12]}"
    ex.batch_extract(prompts, model, wait_s=wait_s, concurrency=concurrency, timeout_s=timeout_s).write.parquet(path)
    out = spark.read.schema(ex.ATTEMPTS).parquet(path)
    for t in tries:
        out = out.unionByName(t)
    return out.join(pending.select(*KEYS), KEYS, "left_semi") if tries else out


def extract_round(spark: SparkSession, lay: Layout, rnd: int | str | None = None,
                  model: Callable[[str], str] | None = None, wait_s: float = ex.RETRY_WAIT_S,
                  candidates: DataFrame | None = None, limit: int | None = None, concurrency: int | None = None,
                  style: str = "api", timeout_s: float | None = None) -> Extracted:
    """One extraction round, visible with its one commit.

    It looks at the unresolved keys, with ``candidates`` added to them;
    without candidates at every stored document.  ``rnd`` names the round:
    under the same name completed attempts are not repeated (by default every
    call is a round of its own).  ``limit`` processes only the last ``limit``
    pending documents per mailbox in processing (uid) order; the rest stay
    unresolved.  ``concurrency`` bounds the simultaneous model calls, ``style``
    chooses the prompt form, ``timeout_s`` bounds one call.
    """
    shared_dir(spark)
    tables, rnd = store(spark, lay), uuid.uuid4().hex if rnd is None else str(rnd)
    if candidates is None:
        keys, docs = pending_keys(spark, lay).checkpoint(eager=True), _documents(tables)
    else:
        open_ = _unresolved(spark, lay).unionByName(candidates.select(*KEYS)).distinct()
        for table in ("results", "quarantine"):
            open_ = joins.anti_join(open_, ig.stored_keys(read(spark, lay, table), open_), KEYS)
        found = ig.stored_keys(_document_keys(spark, tables), open_, "folder").checkpoint(eager=True)
        # the other folders hold no open document and are not read
        keys, docs = found.select(*KEYS), _documents(tables, only={r.folder for r in found.select("folder").distinct().collect()})
    chosen = nb.newest_n(keys, limit, ["account", "mailbox"]) if limit else keys
    pending = docs.drop("bucket").join(joins.bounded_broadcast(chosen), KEYS, "left_semi")
    add: dict[str, list[Entry]] = {}
    if model is None:
        # one item array per pending document, computed once for both sinks; long pages lie in few files
        pages = _dealt(pending.select(*KEYS, "html", "date_iso", "from_addr"))
        per_doc = pages.select(*KEYS, ig.rule_item_array(F.col("html"), F.col("date_iso"), F.col("from_addr"))
                               .alias("items")).checkpoint(eager=True)
        items = per_doc.select(*KEYS, F.posexplode("items").alias("pos", "it")).select(
            *KEYS, (F.col("pos") + 1).cast("int").alias("pos"),
            *[F.col(f"it.{c}").alias(c) for c in ("title", "url", "summary", "date", "sender")])
        # documents without links still count as processed (an empty list)
        found = per_doc.select(*KEYS, F.to_json("items").alias("response"), F.lit(False).alias("repaired"),
                               F.lit(True).alias("valid_json"))
        resolved, done = per_doc.select(*KEYS), Extracted(per_doc.count(), 0, 0)
    else:
        outcomes = ex.attempt_outcome(_attempts(spark, lay, rnd, pending, model, wait_s, concurrency, style, timeout_s))
        outcomes = outcomes.checkpoint(eager=True)
        found = ex.new_results(ex.repair(outcomes), None).checkpoint(eager=True)
        items = ig.item_defaults(ex.news_items(found), docs)
        add["failures"] = [tables.stage("failures", ex.unusable_items(found), tag=f"{rnd}-extract")]
        total = ex.extract_summary(outcomes, []).first()
        done = Extracted(total.ok + total.failed + total.blocked, total.failed, total.blocked)
        if done.blocked:
            add["quarantine"] = [tables.stage("quarantine", ex.quarantine_rows(outcomes))]
        # a document that failed has no result and stays unresolved
        resolved = outcomes.where(F.col("outcome") != "failed").select(*KEYS)
    if done.rows:
        add["results"], add["news_items"] = [tables.stage("results", found)], [tables.stage("news_items", items)]
    left = tables.stage("unresolved", joins.anti_join(keys, resolved, KEYS))
    tables.commit(add, {"unresolved": [left]})
    return done


# ---------------------------------------------------------------------------
# bad files
# ---------------------------------------------------------------------------
def isolate(files: list[str], work: Callable[[list[str]], None], max_tries: int = MAX_TRIES
            ) -> tuple[dict[str, str], dict[str, str]]:
    """Run ``work`` over the files, halving what fails: (files that fail by
    themselves, files that were not told apart after ``max_tries``), each with
    the error.  All others are done."""
    bad, untold, tries = {}, {}, 0
    stack = [files] if files else []
    while stack:
        group = stack.pop()
        tries += 1
        try:
            work(group)
        except Exception as e:
            error = (str(e) or type(e).__name__)[:2000]
            if len(group) == 1:
                bad[group[0]] = error
            elif tries >= max_tries:
                untold |= {f: error for f in group}
            else:
                half = len(group) // 2
                stack += [group[half:], group[:half]]
    return bad, untold


def _note_files(spark: SparkSession, lay: Layout, known: dict[str, int], bad: dict[str, str], untold: dict[str, str]) -> None:
    """The ledger after a round; files given up become failures."""
    tables = store(spark, lay)
    if not (known or bad or untold):
        return
    tries = {f: known.get(f, 0) + 1 for f in bad}
    rows = [(f, n, bad[f]) for f, n in tries.items() if n < GIVE_UP] + [(f, known.get(f, 0), e) for f, e in untold.items()]
    given_up = [f for f, n in tries.items() if n >= GIVE_UP]
    add = {"failures": [tables.stage("failures", spark.createDataFrame(
        [(None, None, None, "ingest", f"{f}: {bad[f]}")], FAILURES).coalesce(1), tag=f"file-{hashlib.md5(f.encode()).hexdigest()}")
        for f in given_up]}
    ledger = [tables.stage("ledger", spark.createDataFrame(rows, LEDGER).coalesce(1))] if rows else []
    tables.commit(add, {"ledger": ledger})


def _ingest_files(spark: SparkSession, lay: Layout, reader, files: list[str], run: str, limit: int | None, **opts):
    """Ingest new files and those of the ledger; (rows, counts, error)."""
    tables = store(spark, lay)
    known = {r.file: r.attempts for r in read(spark, lay, "ledger").collect()}
    # a replay reports its failures anew
    reported = tables.manifest().tables.get("failures", [])
    kept = [e for e in reported if not (e.tag or "").startswith(f"{run}/")]
    if len(kept) < len(reported):
        tables.commit(replace={"failures": kept})
    done: list[Ingested] = []

    def ingest(group):
        done.append(ingest_round(reader(spark, group), lay, limit=limit, run=f"{run}/{len(done)}", **opts))

    def probe(group):
        ig.parse_messages(ig.normalize_records(reader(spark, group))).write.format("noop").mode("overwrite").save()
    todo = sorted({*files, *known})
    if limit and todo:
        # the newest N are chosen among all good files, so the bad ones are found first
        try:
            ingest(todo)
            bad, untold = {}, {}
        except Exception:
            bad, untold = isolate(todo, probe)
            good = [f for f in todo if f not in bad and f not in untold]
            if len(good) == len(todo):
                raise
            if good:
                ingest(good)
    else:
        bad, untold = isolate(todo, ingest)
    _note_files(spark, lay, known, bad, untold)
    counts = {c: sum(d.counts[c] for d in done) for c in rp.COUNTS}
    return sum(d[0] for d in done), counts, next(iter({**bad, **untold}.values()), None)


# ---------------------------------------------------------------------------
# a round
# ---------------------------------------------------------------------------
def make_round(lay: Layout, stages=("ingest", "extract"), model=None, strict_high_water: bool = False,
               wait_s: float = ex.RETRY_WAIT_S, ingest_limit: int | None = None, extract_limit: int | None = None,
               compact_every: int = COMPACT_EVERY, full_rescan: bool = False, redownload: bool = False,
               concurrency: int | None = None, style: str = "api", timeout_s: float | None = None, reader=None):
    """The function of one round: ``run(batch, batch_id)``, or ``run(None,
    batch_id, spark)`` for a round without new files.

    ``batch`` holds raw messages, or with ``reader(spark, files)`` the ``path``
    of files that it reads.  A failed batch of messages is raised again after
    the second stage has run; bad files are isolated instead.
    """
    ingest = {"strict_high_water": strict_high_water, "redownload": redownload, "full_rescan": full_rescan}

    def run(batch: DataFrame | None, batch_id: int, spark: SparkSession | None = None) -> None:
        spark = spark or batch.sparkSession
        shared_dir(spark)
        tables = store(spark, lay)
        # batch numbers begin anew with a fresh checkpoint, the query's id does not repeat
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") if batch is not None else None
        name = f"{query or 'round'}-{batch_id}" if batch is not None else f"idle-{uuid.uuid4().hex[:12]}"
        number, log, broken = tables.round_of(name), [], None
        if compact_every and number > 0 and number % compact_every == 0:
            compact(spark, lay)
        if "ingest" in stages and (batch is not None or reader):
            t0, rows, counts, error = time.time(), 0, dict.fromkeys(rp.COUNTS, 0), None
            try:
                if reader:
                    # paths of one micro-batch, which the stream's own log holds on the driver too
                    files = [r.path for r in batch.select("path").collect()] if batch is not None else []
                    rows, counts, error = _ingest_files(spark, lay, reader, files, name, ingest_limit, **ingest)
                else:
                    done = ingest_round(batch, lay, limit=ingest_limit, run=name, **ingest)
                    rows, counts = done[0], done.counts
            except Exception as e:   # the second stage still runs, as in the reference loop
                broken, error = e, str(e)[:2000]
            if batch is not None or rows or error:
                log.append(_log_row(number, "ingest", t0, 1 if error else 0, rows, counts["failed"], 0, error, counts))
        if "extract" in stages:
            t0, done, error = time.time(), Extracted(0, 0, 0), None
            try:
                done = extract_round(spark, lay, name, model, wait_s, spark.createDataFrame([], KEY_SCHEMA), extract_limit,
                                     concurrency, style, timeout_s)
            except Exception as e:   # its documents stay unresolved and are looked at in the next round
                error = str(e)[:2000]
            log.append(_log_row(number, "extract", t0, 2 if error or done.failed else 0, *done, error))
        if log:
            rows = spark.createDataFrame(log, rp.ROUND_LOG).coalesce(1)
            tables.commit({"round_log": [tables.stage("round_log", rows, tag=name)]}, facts=tables.begun(name))
        if broken:
            raise broken             # the batch is not done: the stream reads its files again
    return run


def _log_row(number: int, stage: str, t0: float, code: int, rows: int, failed: int, blocked: int, error: str | None,
             counts: dict[str, int] | None = None) -> tuple:
    from datetime import datetime, timezone
    began = datetime.fromtimestamp(t0, timezone.utc)
    some = counts or {}
    return (number, stage, began, code, time.time() - t0, rows, failed, blocked, error,
            *[some.get(c) for c in ("new", "skipped", "processed")])


def compact(spark: SparkSession, lay: Layout) -> None:
    """Join the small data folders of the tables that grow by appends, in one
    commit, and delete what no kept manifest names."""
    tables = store(spark, lay)
    spread = [F.col("account"), F.col("mailbox"), F.shiftright(F.col("uid"), 20)]
    done = {"documents": tables.stage_compacted("documents", DOCS_STORED, DOCS_PARTITION, [F.col(c) for c in DOCS_PARTITION])}
    for t in ("results", "news_items", "quarantine", "failures"):
        done[t] = tables.stage_compacted(t, SCHEMAS[t], (), spread)
    done["round_log"] = tables.stage_compacted("round_log", rp.ROUND_LOG)
    found = {t: entries for t, entries in done.items() if entries is not None}
    if "documents" in found:
        folders, noted = {e.folder for e in found["documents"]}, tables.manifest().tables.get("document_keys", [])
        found["document_keys"] = [e for e in noted if e.tag in folders]
        joined = found["documents"][-1].folder
        if joined not in {e.tag for e in noted}:
            keys = spark.read.schema(DOCS_STORED).parquet(f"{lay.documents}/commit={joined}").select(*KEYS)
            found["document_keys"].append(_note_keys(spark, tables, keys, joined))
    if found:
        tables.commit(replace=found)
    tables.vacuum()


# ---------------------------------------------------------------------------
# streams of rounds
# ---------------------------------------------------------------------------
def _escaped(path: str) -> str:
    """A path that is not taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def parquet_reader(landing: str):
    """``reader(spark, files)`` of landed raw-message Parquet files.  Account and
    mailbox may also stand in the folder names below ``landing``."""
    root = re.split(r"/[^/]*[\[{*?]", landing)[0]

    def reader(spark: SparkSession, files: list[str]) -> DataFrame:
        r = spark.read.schema(RAW_MESSAGES)
        if any("/account=" in f or "/mailbox=" in f for f in files):
            r = r.option("basePath", root)
        return r.parquet(*map(_escaped, files))
    return reader


def eml_reader(account: str, mailbox: str):
    """``reader(spark, files)`` of ``<uid>.eml`` files of one mailbox."""
    def reader(spark: SparkSession, files: list[str]) -> DataFrame:
        return tb.eml_records(spark.read.format("binaryFile").load([_escaped(f) for f in files]), account, mailbox)
    return reader


def _files(spark: SparkSession, landing: str, max_files: int, round_opts: dict, glob: str | None = None) -> DataFrame:
    """The landing folder as a stream of file names; no file is opened."""
    reader = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length bigint, content binary"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if not (round_opts.get("ingest_limit") or round_opts.get("extract_limit")):
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing).select("path")


def _started(stream: DataFrame, lay: Layout, rnd, once: bool, interval_s: int):
    w = stream.writeStream.foreachBatch(rnd).option("checkpointLocation", lay.checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=f"{interval_s} seconds")
    return w.start()


def start(spark: SparkSession, landing: str, lay: Layout, once: bool = False,
          interval_s: int = DEFAULT_INTERVAL_S, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, rnd=None, **round_opts):
    """Start the two-stage stream; ``once`` = rounds over what is landed, then
    stop.  ``round_opts`` are those of :func:`make_round`."""
    rnd = rnd or make_round(lay, reader=parquet_reader(landing), **round_opts)
    return _started(_files(spark, landing, max_files_per_trigger, round_opts), lay, rnd, once, interval_s)


def start_eml(spark: SparkSession, landing: str, account: str, mailbox: str, lay: Layout,
              once: bool = False, interval_s: int = DEFAULT_INTERVAL_S,
              max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, **round_opts):
    """The same rounds over a folder of landed ``<uid>.eml`` files (each new
    file is one message)."""
    rnd = make_round(lay, reader=eml_reader(account, mailbox), **round_opts)
    return _started(_files(spark, landing, max_files_per_trigger, round_opts, "*.eml"), lay, rnd, once, interval_s)


def run_loop(spark: SparkSession, landing: str, lay: Layout, gap_s: float = DEFAULT_INTERVAL_S,
             max_rounds: int | None = None, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, **round_opts) -> None:
    """Rounds over what has landed, ``gap_s`` after the end of the one before.

    A round runs also when nothing new has landed: open documents and the
    files of the ledger are tried again.
    """
    number = 0
    while max_rounds is None or number < max_rounds:
        if number:
            time.sleep(gap_s)
        ran = []
        inner = make_round(lay, reader=parquet_reader(landing), **round_opts)

        def rnd(batch, batch_id):
            ran.append(batch_id)
            inner(batch, batch_id)
        try:
            start(spark, landing, lay, once=True, rnd=rnd, max_files_per_trigger=max_files_per_trigger, **round_opts).awaitTermination()
        except StreamingQueryException:
            pass                     # logged by the round; the checkpoint still holds the batch
        if not ran:
            inner(None, 0, spark)
        number += 1


def read_outputs(spark: SparkSession, lay: Layout) -> dict[str, DataFrame]:
    out = {t: read(spark, lay, t) for t in SCHEMAS if t != "state_log"}
    out["state"] = st.fold(read(spark, lay, "state_log"))
    return out


def run_fixture_stream(spark: SparkSession, sf_dir: str, stages=("ingest",), pieces: int = 3, model=None) -> dict[str, DataFrame]:
    """Land the F-A..F-C messages in ``pieces`` arrivals (plus a duplicate
    re-landing of the first), run one availableNow round after each, and
    return the stored tables."""
    from ..sources import fixtures as fx
    lay = Layout(scratch_path(spark, "stream"))
    raw = fx.raw_messages(spark, sf_dir)
    arrivals = [raw.where((F.col("uid") % pieces) == i) for i in range(pieces)]
    if pieces > 1:
        arrivals.append(arrivals[0])
    for i, part in enumerate(arrivals):
        part.write.mode("append").parquet(f"{lay.landing}/arrival={i}")
        q = start(spark, lay.landing + "/*", lay, once=True, stages=stages, wait_s=0.0, model=model)
        q.awaitTermination()
    return read_outputs(spark, lay)


def run_poisoned_loop(spark: SparkSession, sf_dir: str, pieces: int = 5) -> dict[str, DataFrame]:
    """Land the F-A..F-C messages in ``pieces`` arrivals, one of them with an
    unreadable file beside its messages, and repeat rounds until that file is
    given up; the stored tables."""
    from ..sources import fixtures as fx
    lay = Layout(scratch_path(spark, "poison"))
    # all arrivals in one pass, each in files that follow its size, so that every core writes and later parses
    arrival = F.col("uid") % pieces
    (fx.raw_messages(spark, sf_dir).where(arrival >= 0).withColumn("arrival", arrival).hint("rebalance", F.col("arrival"))
     .write.partitionBy("arrival").parquet(lay.landing))
    store(spark, lay).files.create(f"{lay.landing}/arrival=2/part-unreadable.parquet", b"no Parquet file")
    run_loop(spark, lay.landing + "/*", lay, gap_s=0.0, max_rounds=GIVE_UP + 1, stages=("ingest",))
    return read_outputs(spark, lay)
