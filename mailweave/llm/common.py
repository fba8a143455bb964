"""Shared pieces of the operators: scratch tables, Arrow helpers, hashing."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HELD_OUT_FOLDS = 5


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without the setting gets a folder of its own (tests);
    on a cluster a missing setting is an error, since a folder on the driver's
    disk would be invisible to the executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile
        root = "file://" + tempfile.mkdtemp(prefix="mailweave-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Scratch:
    """One job's folder below the shared folder; tables written there cut
    lineage, survive lost executors and can be deleted when done with."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.dir = f"{checkpoint_root(spark)}/mailweave-llm/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def table(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        """``df`` written as Parquet and read again."""
        df.write.mode("overwrite").option("compression", compression).parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(n))
            p.getFileSystem(conf).delete(p, True)

    def release(self) -> None:
        """Let go of the shuffle files of jobs that nothing refers to any more;
        Spark deletes them when the driver's JVM next collects its garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop_like(self, prefix: str) -> None:
        """Delete the tables whose names begin so; nothing may read them any more."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.dir)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        self.drop(*[n for n in names if n.startswith(prefix)])


def crc_fold(key: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``HELD_OUT_FOLDS``; 0 is held out.
    A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % HELD_OUT_FOLDS


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores in front until no column has it (case ignored)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8(array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null counts as empty."""
    return [b"" if v is None else v for v in array.cast(pa.binary()).to_pylist()]


def texts(array) -> list[str]:
    """The texts of an Arrow string column; null counts as empty."""
    return ["" if v is None else v for v in array.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``limit`` bytes of ``column``
    (a single longer text is a piece of its own)."""
    sizes = batch.column(column).cast(pa.large_binary())
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0), dtype=np.int64)
    part = np.concatenate([[0], np.cumsum(lengths)]) // limit
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(part[1:], part[start], side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of complete groups from batches sorted by an integer ``key``;
    holds about ``rows`` rows, or one group if that is larger."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held)
        keys = t[key].to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        if len(other):
            cut = int(other[-1]) + 1
            yield t.slice(0, cut)
            held, n = t.slice(cut).to_batches(), t.num_rows - cut
    if n:
        yield pa.Table.from_batches(held)


def min_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after the links a[i]-b[i] join those of ``label``
    (``np.arange(n)`` to begin with); a label is the smallest member."""
    open_ = label[a] != label[b]
    a, b = a[open_], b[open_]
    while len(a):
        low = np.minimum(label[a], label[b])
        label = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            deeper = label[label]
            if np.array_equal(deeper, label):
                break
            label = deeper
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def forest(label: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link from every member of a component to its smallest ``node``."""
    smallest = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(smallest, label, node)
    child = np.flatnonzero(smallest[label] != node)
    return node[child], smallest[label][child]
