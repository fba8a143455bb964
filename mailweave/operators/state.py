"""High-water state: load, advance, save, state files (#8, #9, #18).

State is one row per mailbox.  It is stored append-only (``state_log``) and
folded with ``max`` on read, so a replayed round can never move a mark down
and no job ever overwrites a path it is reading.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import hadoop_path, shared_dir

def fold(state_log: DataFrame) -> DataFrame:
    """Current state from an append-only log: the largest mark per mailbox."""
    return state_log.groupBy("account", "mailbox").agg(F.max("last_uid").cast("bigint").alias("last_uid"))


def advance(state: DataFrame | None, seen: DataFrame) -> DataFrame:
    """New mark = greatest(old, max uid seen); never goes down.

    ``seen`` may be the (skewed) message table itself: the ``max`` is
    combined map-side before the shuffle, so a hot mailbox costs one partial
    row per task.
    """
    s = seen.select("account", "mailbox", F.col("uid").cast("bigint").alias("last_uid"))
    if state is not None:
        s = state.select("account", "mailbox", F.col("last_uid").cast("bigint")).unionByName(s)
    return fold(s)


def state_key(account: Column, mailbox: Column) -> Column:
    """The JSON form's key: ``account:mailbox``."""
    return F.concat(account, F.lit(":"), mailbox)


def split_key(key: Column) -> tuple[Column, Column]:
    """``account:mailbox`` -> (account, mailbox), split at the first colon."""
    return F.substring_index(key, ":", 1), F.regexp_extract(key, r"^[^:]*:(.*)$", 1)


# ---------------------------------------------------------------------------
# JSON form
# ---------------------------------------------------------------------------
_INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def _as_int(v: Column) -> Column:
    """One JSON value coerced like ``int(value)``; NULL when that would fail.

    Numbers truncate toward zero, booleans are 1/0, strings must spell an
    integer; null, objects and arrays fail.
    """
    t = F.schema_of_variant(v)
    s = F.try_variant_get(v, "$", "string")
    return (F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.try_variant_get(v, "$", "bigint"))
            .when(t.startswith("DECIMAL"), F.try_variant_get(v, "$", "decimal(38,10)").try_cast("bigint"))
            .when(t.isin("DOUBLE", "FLOAT"), F.try_variant_get(v, "$", "double").try_cast("bigint"))
            .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))
            .when((t == "STRING") & s.rlike(_INT_TEXT),
                  F.regexp_replace(s, r"[_\s]", "").try_cast("bigint")))


def load_json(docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """State documents (one JSON object each) -> rows (id, key, account, mailbox, last_uid).

    A document that is not a JSON object, or holds any value that is not an
    integer, yields no rows at all (the whole file counts as empty state).
    The validity test is a window over one document's entries - bounded by
    the size of that document, never by the table.
    """
    parsed = docs.select(id_col, F.from_json(F.col(text_col), "map<string,variant>").alias("_m"))
    entries = parsed.select(id_col, F.explode("_m").alias("key", "_v"))
    vals = entries.select(id_col, "key", _as_int(F.col("_v")).alias("last_uid"))
    ok = F.bool_and(F.col("last_uid").isNotNull()).over(Window.partitionBy(id_col))
    vals = vals.withColumn("_ok", ok).where("_ok").drop("_ok")
    acc, mb = split_key(F.col("key"))
    return vals.select(id_col, "key", acc.alias("account"), mb.alias("mailbox"), "last_uid")


def to_json_by_account(state: DataFrame) -> DataFrame:
    """One JSON object per account (keys sorted), the state file form.

    Grouped by account, so one group holds that account's mailboxes only.
    """
    entry = F.struct(state_key(F.col("account"), F.col("mailbox")).alias("k"), F.col("last_uid").alias("v"))
    return (state.groupBy("account")
            .agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("state_json")))


# ---------------------------------------------------------------------------
# state files
# ---------------------------------------------------------------------------
STATE_ROWS = "key string, account string, mailbox string, last_uid bigint"


def read_state_files(spark: SparkSession, path: str) -> DataFrame:
    """The marks of a state file, or of a folder of them, read in the tasks:
    ``(key, account, mailbox, last_uid)``.

    A missing path, a file that is no JSON object and a file with a value that
    is no integer each count as empty state.  Of a mailbox in several files the
    largest mark counts."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], STATE_ROWS)
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True) if fs.getFileStatus(p).isDirectory() \
        else spark.read.text(path, wholetext=True)
    rows = load_json(files.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")), "file")
    return rows.groupBy("key", "account", "mailbox").agg(F.max("last_uid").alias("last_uid"))


def _write_state(base: str):
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs
        filesystem, root = pafs.FileSystem.from_uri(base)
        filesystem.create_dir(root, recursive=True)
        for b in batches:
            names = []
            for account, text in zip(b.column("account").to_pylist(), b.column("state_json").to_pylist()):
                name = f"{root.rstrip('/')}/{quote(account or '', safe='')}.json"
                part = f"{name}.{uuid.uuid4().hex}.part"
                with filesystem.open_output_stream(part, compression=None) as f:
                    f.write(text.encode())
                filesystem.move(part, name)      # readers see the old file or the new one
                names.append(name)
            yield pa.RecordBatch.from_arrays([b.column("account"), pa.array(names, pa.string())], names=["account", "path"])
    return run


def write_state_files(state: DataFrame, path: str) -> DataFrame:
    """One ``<account>.json`` per account, written by the tasks and put in
    place whole; (account, path) of the files.  A retried task writes the same."""
    spark = state.sparkSession
    shared_dir(spark)
    uri = hadoop_path(spark, path)[1].toUri()
    base = f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"
    return to_json_by_account(state).mapInArrow(_write_state(base), "account string, path string").checkpoint(eager=True)
