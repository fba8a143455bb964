"""Extraction stage: pending documents -> model attempts -> results / items.

Plan of one round (``streaming.rounds.extract_round``)::

    candidates (new and unresolved keys) or all keys
      --anti(results)--anti(quarantine), both cut to the candidates' ranges-->
      pending keys --semi-join--> pending documents
      --prompt_assemble (concat with a literal)-->
      --batch_extract (mapInArrow; the one non-repeatable step, written
        to storage before anything reads it)-->
      attempts --attempt_outcome (group by key, partial aggregation)-->
      outcomes --repair (native slice + Arrow json.loads)--> results
      results --news_items (from_json + posexplode)--> items

Every shuffle here is keyed by the full ``(account, mailbox, uid)`` key, so
a huge mailbox spreads evenly.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import multiprocessing
import time
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..functions.batches import PIECE_ROWS, pieces
from ..functions.frontmatter import front_matter_json
from ..functions.prompt import PROMPT_TEXT
from ..schemas import ATTEMPTS, KEYS, NEWS_ITEM
from .joins import anti_join, anti_join_recent
from .numbering import global_positions

# Fixed values of the extraction stage.
MAX_ATTEMPTS = 3          # first call + 2 retries
RETRY_WAIT_S = 1.0        # pause between attempts
EMPTY_RESPONSE = "empty response"


# ---------------------------------------------------------------------------
# pending set and its order (#14, #23, #22, #37)
# ---------------------------------------------------------------------------
def pending_docs(docs: DataFrame, results: DataFrame, quarantine: DataFrame | None = None,
                 keys: list[str] = KEYS, candidates: DataFrame | None = None) -> DataFrame:
    """Documents with no stored result and not quarantined.

    Without ``candidates`` this is the full reconciliation (two key-pruned
    anti-joins over the archive).  With ``candidates`` (the keys a round can
    have made pending: its new documents plus the retry set) only those
    documents are considered and the result / quarantine tables are cut to
    the candidates' key ranges first - the work follows the round, not the
    archive.
    """
    if candidates is None:
        # keys-only anti-joins on one partitioning, then the wide rows (body, html) by a semi-join that
        # adaptive execution turns map-side where the pending keys turn out to be few; no job runs here
        pk = anti_join(docs.select(*keys), results, keys)
        if quarantine is not None:
            pk = anti_join(pk, quarantine, keys)
        return docs.join(pk, keys, "left_semi")
    cand = candidates.select(*keys).distinct()
    p = docs.join(cand, keys, "left_semi")
    p = anti_join_recent(p, results, keys, cand)
    return p if quarantine is None else anti_join_recent(p, quarantine, keys, cand)


def order_keys(id_col: Column, mtime: Column) -> list[Column]:
    """All-ASCII-digit ids first by integer value, then the rest by mtime
    (unknown mtime last); the id itself breaks remaining ties.

    The integer order of digit strings of any length is (length without
    leading zeros, then text) - exact, no numeric cast that could overflow.
    Every key is a plain ascending value, as range partitioning needs.
    """
    digits = id_col.rlike(r"^[0-9]+$")
    stripped = F.regexp_replace(id_col, r"^0+", "")
    return [
        F.when(digits, F.lit(0)).otherwise(F.lit(1)),
        F.when(digits, F.length(stripped)),
        F.when(digits, stripped),
        F.when(~digits, mtime.isNull()),
        F.when(~digits, mtime),
        id_col,
    ]


def pending_order(listing: DataFrame, id_col: str = "id", mtime_col: str = "mtime",
                  num_partitions: int | None = None) -> DataFrame:
    """The listing with its 1-based processing position ``pos``."""
    return global_positions(listing, order_keys(F.col(id_col), F.col(mtime_col)), num_partitions)


def dry_run(listing: DataFrame, limit: int | None = None, read_dir: str = "read",
            id_col: str = "id", mtime_col: str = "mtime") -> DataFrame:
    """What a round would process, in order, with its target; no model call.

    ``limit`` keeps the *last* ``limit`` ids of the processing order.
    """
    ordered = pending_order(listing, id_col, mtime_col)
    if limit is not None and limit > 0:
        ordered = ordered.orderBy(F.col("pos").desc()).limit(limit)
    return ordered.select(F.col(id_col).alias("id"), "pos",
                          F.concat(F.lit(read_dir.rstrip("/") + "/"), F.col(id_col), F.lit(".json")).alias("target"))


# ---------------------------------------------------------------------------
# prompt (#16)
# ---------------------------------------------------------------------------
def document_text() -> Column:
    """A stored document as the model reads it: front matter, then the body."""
    return F.concat(F.lit("---\n"), front_matter_json(), F.lit("\n---\n"), F.col("body"))


def prompt_assemble(docs: DataFrame, text_col: str | Column = "text", style: str = "api",
                    prompt: str = PROMPT_TEXT) -> Column:
    """``prompt + "\\n\\n" + text`` (api style) or ``prompt + "\\n" + text + "\\n"``
    (cli style).  A literal concatenation: no join, no shuffle."""
    content = F.col(text_col) if isinstance(text_col, str) else text_col
    if style == "api":
        return F.concat(F.lit(prompt + "\n\n"), content)
    if style == "cli":
        return F.concat(F.lit(prompt + "\n"), content, F.lit("\n"))
    raise ValueError(f"unknown prompt style {style!r}")


# ---------------------------------------------------------------------------
# model calls (#35)
# ---------------------------------------------------------------------------
def is_blocked(error: str | None) -> bool:
    return bool(error) and (text.BLOCKED_MARKER in error or text.BLOCKED_MARKER_LOWER in error.lower())


def blocked_col(error: Column) -> Column:
    return F.coalesce(error.contains(text.BLOCKED_MARKER)
                      | F.lower(error).contains(text.BLOCKED_MARKER_LOWER), F.lit(False))


def accepts_attempt(model: Callable) -> bool:
    """Whether ``model`` takes the attempt number as keyword ``attempt``."""
    try:
        return "attempt" in inspect.signature(model).parameters
    except (TypeError, ValueError):
        return False


def _call_in_child(call: Callable[[], str], out) -> None:
    try:
        out.send((True, call()))
    except Exception as e:
        out.send((False, str(e) or type(e).__name__))


def _within(timeout_s: float | None, call: Callable[[], str]) -> str:
    """``call()``; with a limit in a process of its own, which is ended when
    the limit is over, so that no call goes on behind its attempt's back."""
    if not timeout_s:
        return call()
    context = multiprocessing.get_context("fork")
    here, there = context.Pipe(duplex=False)
    child = context.Process(target=_call_in_child, args=(call, there), daemon=True)
    child.start()
    there.close()
    try:
        if not here.poll(timeout_s):
            raise TimeoutError(f"no answer within {timeout_s:g} s")
        try:
            good, answer = here.recv()
        except EOFError:
            raise RuntimeError("the model's process ended without an answer") from None
    finally:
        if child.is_alive():
            child.kill()
        child.join()
        here.close()
    if not good:
        raise RuntimeError(answer)
    return answer


def _attempt_rows(model: Callable[..., str], prompt: str, max_attempts: int, wait_s: float,
                  pass_attempt: bool = False, timeout_s: float | None = None):
    """Call ``model`` until a non-empty answer or a blocked error; at most
    ``max_attempts`` calls.  Yields (attempt_no, response, error)."""
    for n in range(1, max_attempts + 1):
        if n > 1 and wait_s > 0:
            time.sleep(wait_s)
        try:
            out = _within(timeout_s, lambda: model(prompt, attempt=n) if pass_attempt else model(prompt))
            resp = out.strip() if isinstance(out, str) else ""
            yield n, resp, (None if resp else EMPTY_RESPONSE)
            if resp:
                return
        except Exception as e:  # the model's failure is data, not a task failure
            err = str(e) or type(e).__name__
            yield n, None, err
            if is_blocked(err):
                return


def batch_extract(prompts: DataFrame, model: Callable[..., str], max_attempts: int = MAX_ATTEMPTS,
                  wait_s: float = RETRY_WAIT_S, concurrency: int | None = None,
                  keys: list[str] = KEYS, prompt_col: str = "prompt", timeout_s: float | None = None,
                  calls_per_task: int = 1) -> DataFrame:
    """Attempt log of calling ``model`` on every prompt (``attempts`` shape).

    ``model(prompt) -> str`` answers or raises; a model that also takes a
    keyword ``attempt`` is told the 1-based attempt number.  ``concurrency``
    bounds the calls in flight, over all tasks: it is the number of tasks times
    ``calls_per_task``, the calls a task keeps in flight at once (its attempts
    of one prompt follow each other; rows come out in the prompts' order).
    ``timeout_s`` bounds one call and ends it.  The result is not
    repeatable (a remote model is not deterministic): write it to storage
    before deriving anything (the stream keeps one attempt log per round and
    reuses it on replay), so that no recomputation calls the model again.
    """
    src = prompts.select(*keys, prompt_col)
    if concurrency:
        calls_per_task = max(1, min(calls_per_task, concurrency))
        src = src.repartition(max(1, concurrency // calls_per_task))
    pass_attempt = accepts_attempt(model)

    def attempts(rec: tuple) -> list[tuple]:
        return [(*rec[:-1], n, resp, err) for n, resp, err in
                _attempt_rows(model, rec[-1], max_attempts, wait_s, pass_attempt, timeout_s)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = max(PIECE_ROWS, 16 * calls_per_task)
        with ThreadPoolExecutor(calls_per_task) as pool:
            for batch in (piece for whole in batches for piece in pieces(whole, prompt_col, held)):
                recs = zip(*[batch.column(c).to_pylist() for c in (*keys, prompt_col)])
                # map keeps the order; a piece's prompts are what is held at once
                done = pool.map(attempts, recs) if calls_per_task > 1 else map(attempts, recs)
                rows = [row for rows in done for row in rows]
                fields = [(k, batch.schema.field(k).type) for k in keys] + [
                    ("attempt_no", pa.int32()), ("response", pa.string()), ("error", pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(fields)],
                                                 schema=pa.schema(fields))

    schema = ATTEMPTS if keys == KEYS else ", ".join(
        [f"{k} {dict(src.dtypes)[k]}" for k in keys] + ["attempt_no int", "response string", "error string"])
    return src.mapInArrow(run, schema)


class StubModel:
    """Deterministic stand-in for a remote model, for tests and checks.

    Behaviour is a function of ``md5(prompt)`` and the attempt number:
    class ``int(md5[:8], 16) % 6`` - 0 answers at once, 1 answers empty then
    a list, 2 times out then is blocked, 3 fails every time, 4 is blocked at
    once, 5 answers a fenced list.
    """

    @staticmethod
    def digest(prompt: str) -> str:
        return hashlib.md5(prompt.encode("utf-8")).hexdigest()

    @staticmethod
    def answer(h: str) -> str:
        item = {"title": f"item {h[:8]}", "url": f"https://n.example/{h[8:16]}", "summary": h[16:24],
                "date": "", "sender": ""}
        return json.dumps([item])

    def __call__(self, prompt: str, attempt: int = 1) -> str:
        h = self.digest(prompt)
        cls = int(h[:8], 16) % 6
        if cls == 0:
            return self.answer(h)
        if cls == 1:
            return "  " if attempt == 1 else self.answer(h)
        if cls == 2:
            if attempt == 1:
                raise TimeoutError("timeout")
            raise RuntimeError("data_inspection_failed: input blocked")
        if cls == 3:
            raise RuntimeError(f"upstream error {attempt}")
        if cls == 4:
            raise RuntimeError("Inappropriate Content")
        return "```json\n" + self.answer(h) + "\n```"


# ---------------------------------------------------------------------------
# attempt fold (#21), results (#6), quarantine (#7), summary (#20)
# ---------------------------------------------------------------------------
def attempt_outcome(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS, keys: list[str] = KEYS) -> DataFrame:
    """Fold ordered attempts per key: the first non-empty response wins, a
    blocked error stops at once, otherwise the last error after the cap.

    ``min_by`` / ``max_by`` are ordinary aggregates: partial aggregation
    before the shuffle, one group per key.
    """
    a = attempts.where(F.col("attempt_no") <= max_attempts)
    ok = F.coalesce(F.length("response") > 0, F.lit(False))
    terminal = ok | blocked_col(F.col("error"))
    term = F.struct(F.col("attempt_no"), F.when(ok, F.lit("ok")).otherwise(F.lit("blocked")).alias("outcome"),
                    F.col("response"), F.col("error"))
    g = a.groupBy(*keys).agg(
        F.min_by(F.when(terminal, term), F.when(terminal, F.col("attempt_no"))).alias("_t"),
        F.max_by(F.struct("attempt_no", F.coalesce("error", F.lit(EMPTY_RESPONSE)).alias("error")),
                 F.col("attempt_no")).alias("_last"),
    )
    return g.select(
        *keys,
        F.coalesce(F.col("_t.outcome"), F.lit("failed")).alias("outcome"),
        F.coalesce(F.col("_t.attempt_no"), F.col("_last.attempt_no")).cast("int").alias("attempt_no"),
        F.when(F.col("_t.outcome") == "ok", F.col("_t.response")).alias("response"),
        F.when(F.col("_t.outcome") == "ok", F.lit(None).cast("string"))
        .when(F.col("_t.outcome") == "blocked", F.col("_t.error"))
        .otherwise(F.col("_last.error")).alias("error"),
    )


def _json_checks_py(resp: pd.Series, cand: pd.Series) -> pd.DataFrame:
    def ok(x):
        if x is None:
            return None
        try:
            json.loads(x)
            return True
        except (ValueError, RecursionError):  # too deep a nesting is not valid either
            return False
    return pd.DataFrame({"whole": resp.map(ok).astype("boolean"), "slice": cand.map(ok).astype("boolean")})


# Marked non-deterministic only so that Catalyst never inlines it into a
# pushed-down filter (``valid_json`` is filtered on downstream), which would
# run the Python check twice.
_json_checks = F.pandas_udf(_json_checks_py, T.StructType([
    T.StructField("whole", T.BooleanType()), T.StructField("slice", T.BooleanType())])).asNondeterministic()


def repair(outcomes: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """``results`` rows for the ``ok`` outcomes, with fenced JSON repaired.

    Valid JSON is kept as is; otherwise, when the left-stripped text starts
    with a fence and the slice from the first ``[`` to the last ``]`` is
    valid JSON, the slice replaces it; else it is kept and flagged invalid.
    Slicing is native; only validity runs in Python (``json.loads``
    semantics), in one Arrow-batched call.
    """
    ok = outcomes.where(F.col("outcome") == "ok")
    r = F.col("response")
    cand = F.when(text.is_fenced(r), text.fence_slice(r))
    chk = ok.select(*keys, "response", cand.alias("_cand"), _json_checks(r, cand).alias("_c"))
    fixed = ~F.col("_c.whole") & F.coalesce(F.col("_c.slice"), F.lit(False))
    return chk.select(
        *keys,
        F.when(fixed, F.col("_cand")).otherwise(F.col("response")).alias("response"),
        fixed.alias("repaired"),
        (F.col("_c.whole") | fixed).alias("valid_json"),
    )


def _list_elements(results: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, e): the elements of valid list responses as JSON texts, from
    position 1.  A lone object is no list (``from_json`` would wrap it)."""
    lst = results.where(F.col("valid_json") & F.col("response").rlike(r"^\s*\["))
    arr = F.from_json(F.col("response"), "array<string>")
    return (lst.select(*keys, F.posexplode(arr).alias("pos", "e"))
            .select(*keys, (F.col("pos") + 1).cast("int").alias("pos"), "e"))


_OBJECT = r"^\s*\{"


def news_items(results: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """JSON lists -> one row per item with the five string fields; elements
    that are no objects are left out (:func:`unusable_items` has them), the
    others keep their position."""
    return (_list_elements(results, keys).where(F.col("e").rlike(_OBJECT))
            .select(*keys, "pos", F.from_json("e", NEWS_ITEM).alias("it"))
            .select(*keys, "pos", *[F.col(f"it.{c}").alias(c) for c in ("title", "url", "summary", "date", "sender")]))


def unusable_items(results: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The list elements that are no objects, in ``failures`` shape."""
    return (_list_elements(results, keys).where(~F.coalesce(F.col("e").rlike(_OBJECT), F.lit(False)))
            .select(*keys, F.lit("extract").alias("stage"),
                    F.concat(F.lit("item "), F.col("pos").cast("string"), F.lit(" is no object")).alias("error")))


def new_results(results: DataFrame, existing: DataFrame | None, keys: list[str] = KEYS) -> DataFrame:
    """Rows to append to ``results``: non-empty responses whose key has no
    stored result (insert-if-absent against the matching key ranges)."""
    r = results.where(F.length("response") > 0)
    return r if existing is None else anti_join_recent(r, existing, keys)


def quarantine_rows(outcomes: DataFrame, existing: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Blocked keys leave the pending set; a newer entry replaces an older one."""
    q = outcomes.where(F.col("outcome") == "blocked").select(*keys, "error")
    if existing is None:
        return q
    return q.unionByName(anti_join(existing.select(*keys, "error"), q, keys))


def extract_summary(outcomes: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """ok / failed / blocked counts; a run fails iff failed > 0."""
    gc = group_cols if group_cols is not None else ["account", "mailbox"]
    agg = [F.count_if(F.col("outcome") == o).cast("bigint").alias(o) for o in ("ok", "failed", "blocked")]
    g = outcomes.groupBy(*gc).agg(*agg) if gc else outcomes.agg(*agg)
    return g.withColumn("run_failed", F.col("failed") > 0)
