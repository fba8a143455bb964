"""Sources, and sinks over plain folders: landed raw messages, document files,
keyed inserts and replacements (#1, #3, #4, #5, #6, #9).

Plain tables are Parquet folders partitioned by ``(account, mailbox)`` so that
a per-mailbox filter prunes whole folders.  Writers never overwrite a path that
the same plan reads.  The tables of the rounds are snapshots (``snapshots``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import normalize_records
from ..operators.joins import anti_join
from ..schemas import KEYS, RAW_MESSAGES
from ..session import delete_path, hadoop_path, scratch_path

PARTITION_COLS = ["account", "mailbox"]


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------
def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Landed raw messages (``raw_messages`` schema), normalised."""
    return normalize_records(spark.read.schema(RAW_MESSAGES).parquet(path))


def eml_records(files: DataFrame, account: str, mailbox: str) -> DataFrame:
    """``binaryFile`` rows (path, modificationTime, length, content) -> raw
    messages of one mailbox; the uid is the file stem, a non-numeric stem
    gives uid 0 (rejected as invalid downstream)."""
    stem = F.regexp_extract(F.col("path"), r"([^/]+)\.[^./]+$", 1)
    return normalize_records(files.select(
        F.lit(account).alias("account"), F.lit(mailbox).alias("mailbox"),
        F.coalesce(F.when(stem.rlike(r"^[0-9]+$"), stem.try_cast("bigint")), F.lit(0)).alias("uid"),
        F.col("content").alias("raw"), F.col("length").alias("size"),
        F.lit(None).cast("array<string>").alias("labels"), F.lit(None).cast("string").alias("thread_id")))


def read_eml_files(spark: SparkSession, path: str, account: str, mailbox: str,
                   glob: str = "*.eml") -> DataFrame:
    """A folder of ``<uid>.eml`` files as raw messages of one mailbox."""
    return eml_records(spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path),
                       account, mailbox)


def doc_scan(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """Document files: id = file stem, whole text, modification time.

    A missing folder is an empty listing, as is a folder with no match.
    """
    schema = "id string, text string, mtime timestamp, path string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    name = F.col("_metadata.file_name")
    return df.select(
        F.regexp_extract(name, r"^(.*)\.md$", 1).alias("id"), F.col("value").alias("text"),
        F.col("_metadata.file_modification_time").alias("mtime"), F.col("_metadata.file_path").alias("path"))


def _read_files(base: str, glob: str):
    """mapInArrow body: the files below ``base`` in each folder of a batch, read
    a few at a time."""
    def run(batches):
        from fnmatch import fnmatchcase

        import pyarrow as pa
        from pyarrow import fs as pafs

        from mailweave.functions.batches import PIECE_BYTES, PIECE_ROWS
        filesystem, root = pafs.FileSystem.from_uri(base)
        fields = pa.schema([("id", pa.string()), ("text", pa.string()), ("mtime", pa.timestamp("us", tz="UTC")), ("path", pa.string())])

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(fields)], schema=fields)
        for folder in (f for batch in batches for f in batch.column("folder").to_pylist()):
            rows, held = [], 0
            for info in filesystem.get_file_info(pafs.FileSelector(f"{root.rstrip('/')}/{folder}")):
                name = info.base_name
                if info.type != pafs.FileType.File or name[0] in "._" or not fnmatchcase(name, glob):
                    continue
                with filesystem.open_input_stream(info.path) as f:
                    data = f.read()
                rows.append((name[:-3] if name.endswith(".md") else "", data.decode("utf-8", "replace"), info.mtime,
                             f"{base.rstrip('/')}/{folder}/{name}"))
                held += len(data)
                if len(rows) >= PIECE_ROWS or held >= PIECE_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)
    return run


def doc_scan_folders(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """:func:`doc_scan` of a folder that holds its files in subfolders: only
    these are listed by the driver, their files by the tasks that read them."""
    if not path_exists(spark, path):
        return doc_scan(spark, path, glob)
    fs, p = hadoop_path(spark, path)
    names = [(s.getPath().getName(),) for s in fs.listStatus(p) if s.isDirectory()]
    names = [n for n in names if n[0][0] not in "._"]
    if not names:
        return spark.createDataFrame([], "id string, text string, mtime timestamp, path string")
    found = spark.createDataFrame(names, "folder string").repartition(min(len(names), 4 * spark.sparkContext.defaultParallelism))
    return found.mapInArrow(_read_files(_uri(spark, path), glob), "id string, text string, mtime timestamp, path string")


def pick_doc_dir(spark: SparkSession, candidates: list[str], override: str | None = None) -> str:
    """The document folder: an override wins, else the first that exists."""
    if override:
        return override
    return next((c for c in candidates if path_exists(spark, c)), candidates[-1])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the cluster's Hadoop file system."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete table folders (with a success mark) below ``path``."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def write_version(df: DataFrame, path: str) -> None:
    """``df`` as the next version of a small table that is replaced as a whole;
    it may read the version before, which goes once the new one is complete."""
    spark = df.sparkSession
    done = folders(spark, path)
    number = int(done[-1][2:]) + 1 if done else 0
    df.write.mode("overwrite").parquet(f"{path}/v={number:012d}")
    for name in done:
        delete_path(spark, f"{path}/{name}")


def read_version(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The last complete version, None if there is none yet."""
    done = folders(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{done[-1]}") if done else None


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
def append_if_absent(new: DataFrame, existing: DataFrame, path: str, keys: list[str] = KEYS) -> None:
    """Insert-if-absent: rows whose key is stored already are skipped (and
    count as success)."""
    anti_join(new, existing, keys).write.mode("append").partitionBy(*PARTITION_COLS).parquet(path)


def overwrite_keys(new: DataFrame, existing: DataFrame, path: str, keys: list[str] = KEYS) -> None:
    """Replace stored rows by key: ``new`` ∪ (existing not in new), written
    with dynamic partition overwrite so only touched mailboxes are replaced.

    The merged rows are first written to a staging folder in the shared
    scratch area (cutting the lineage to ``path``), then moved over the
    touched partitions; the plan never reads the folder it overwrites.
    """
    spark = new.sparkSession
    touched = new.select(*PARTITION_COLS).distinct()
    ex = existing.join(touched, PARTITION_COLS, "left_semi")
    merged = new.unionByName(anti_join(ex, new, keys), allowMissingColumns=True)
    staging = scratch_path(spark, "overwrite-staging")
    merged.write.mode("overwrite").partitionBy(*PARTITION_COLS).parquet(staging)
    (spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITION_COLS).parquet(path))
    delete_path(spark, staging)


def append_state(state: DataFrame, path: str) -> None:
    """Append marks to the state log (folded with ``max`` on read)."""
    state.select("account", "mailbox", F.col("last_uid").cast("bigint")).write.mode("append").parquet(path)


def _uri(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, for ``pyarrow.fs`` in the tasks."""
    _, target = hadoop_path(spark, path)
    uri = target.toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def _write_files(base: str):
    """mapInArrow body: write each (name, text) row as ``base/name`` and
    report (name, path, bytes).  Rewriting the same name is harmless, so a
    retried task is idempotent."""
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        from mailweave.functions.batches import pieces
        filesystem, root = pafs.FileSystem.from_uri(base)
        filesystem.create_dir(root, recursive=True)
        made = set()
        for batch in (piece for whole in batches for piece in pieces(whole, "text")):
            out = []
            for name, txt in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                data = (txt or "").encode("utf-8")
                p = f"{root.rstrip('/')}/{name}"
                folder = p.rpartition("/")[0]
                if "/" in name and folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                with filesystem.open_output_stream(p) as f:
                    f.write(data)
                out.append((name, p, len(data)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()),
                                              pa.array([r[2] for r in out], pa.int64())], names=["name", "path", "bytes"])
    return run


def export_markdown(docs: DataFrame, path: str, uids_per_folder: int | None = None) -> DataFrame:
    """Write one ``<uid>.md`` file per document (front matter + body) into
    ``path`` - the one-file-per-message layout, for users moving between the
    two stores.  One folder holds one mailbox, since uids are unique only per
    mailbox; documents of several mailboxes are refused.  Runs in the tasks
    through ``pyarrow.fs`` (local, HDFS, S3); returns the written (name, path,
    bytes) rows, already materialised.

    ``uids_per_folder`` lays a large mailbox out in one subfolder per range of
    uids, which :func:`doc_scan_folders` lists in tasks.  The documents are
    parsed and rendered once, into a staging folder.
    """
    from ..functions.frontmatter import render_markdown
    spark = docs.sparkSession
    name = F.concat(F.col("uid").cast("string"), F.lit(".md"))
    if uids_per_folder:
        name = F.concat(F.floor(F.col("uid") / uids_per_folder).cast("string"), F.lit("/"), name)
    staging = scratch_path(spark, "md-staging")
    try:
        docs.select("account", "mailbox", name.alias("name"), render_markdown().alias("text")).write.parquet(staging)
        src = spark.read.parquet(staging)
        if src.select("account", "mailbox").distinct().limit(2).count() > 1:
            raise ValueError("documents of several mailboxes do not fit one folder; export each mailbox by itself")
        written = src.select("name", "text").mapInArrow(_write_files(_uri(spark, path)), "name string, path string, bytes bigint")
        return written.checkpoint(eager=True)
    finally:
        delete_path(spark, staging)
