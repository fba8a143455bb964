"""Snapshot tables: immutable data folders and numbered manifests.

A store is a folder with a ``_manifests`` folder and one folder per table::

    base/_manifests/000000000012.json
    base/documents/commit=<id>/account=.../mailbox=.../bucket=.../part-....parquet
    base/results/commit=<id>/part-....parquet

A writer first stages data folders, which nothing refers to, and then commits:
one new manifest names, for every table, the folders that make it up.  The
manifest is what makes a change visible, so all tables of a commit change
together or not at all.  Nothing that a manifest names is ever renamed,
rewritten or replaced; compaction and keyed replacement are commits like any
other, and superseded folders are deleted only once no kept manifest names
them.

A manifest starts with the SHA-256 of the rest: one that was cut off while
being written counts for nothing, and readers take the last whole one.  That
needs no rename and no atomic replacement from the file system, only that a
new file can be created.  One writer at a time is assumed (the rounds of one
stream); two writers meet when the second finds the number taken, and fails.

Every table may leave out partitions of a folder (``without``): a keyed
replacement (:meth:`Store.stage_merge`) rewrites the partitions that hold a
replaced key and hides their old copies.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path

MANIFESTS = "_manifests"
#: manifests kept by :meth:`Store.vacuum`: plans built on them may still run
KEPT = 8
#: runs whose round numbers a manifest remembers, for replays
RUNS = 32
#: partitions that a merge hides one by one; where more are hit, the whole table is written anew
HIDDEN = 1_000


@dataclass(frozen=True)
class Entry:
    """A data folder of a table; ``tag`` names the run that wrote it (a later
    commit with the same tag takes its place), ``without`` the partitions of
    the folder that do not count, as tuples of partition values."""
    folder: str
    tag: str | None = None
    without: tuple = ()


@dataclass
class Manifest:
    number: int = -1
    tables: dict[str, list[Entry]] = field(default_factory=dict)
    #: small facts that change together with the tables
    facts: dict = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {t: [[e.folder, e.tag, [list(w) for w in e.without]] for e in es] for t, es in self.tables.items()}
        return json.dumps({"number": self.number, "tables": tables, "facts": self.facts}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["number"], {t: [Entry(f, tag, tuple(tuple(w) for w in without)) for f, tag, without in es]
                                      for t, es in d["tables"].items()}, d["facts"])


class Files:
    """The file-system calls of a store; every change goes through here."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def names(self, path: str) -> list[str]:
        fs, p = hadoop_path(self.spark, path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> bytes:
        fs, p = hadoop_path(self.spark, path)
        stream = fs.open(p)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create(self, path: str, data: bytes) -> None:
        """A new file; an error if there is one already."""
        fs, p = hadoop_path(self.spark, path)
        out = fs.create(p, False)
        try:
            out.write(data)
        finally:
            out.close()

    def size(self, path: str) -> int:
        fs, p = hadoop_path(self.spark, path)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def delete(self, path: str) -> None:
        fs, p = hadoop_path(self.spark, path)
        fs.delete(p, True)

    def write(self, df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
        w = df.write.mode("errorifexists")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)

    def write_buckets(self, df: DataFrame, table: str, partition_by: str, buckets: int, keys: list[str]) -> None:
        """Add partitions to a bucketed catalog table."""
        (df.write.mode("append").format("parquet").partitionBy(partition_by).bucketBy(buckets, *keys).sortBy(*keys)
         .saveAsTable(table))


def _place(values) -> str:
    """One text for a tuple of partition values; different tuples have different texts."""
    texts = [str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    return "".join("-" if v is None else f"{len(t)}:{t}" for v, t in zip(values, texts))


def _among(columns, places) -> Column:
    """Whether a row lies in one of these partitions (tuples of texts, whole
    numbers or truth values): one set of texts, so that the plan stays flat
    however many there are, and a scan prunes by it."""
    texts = [F.col(c).cast("string") for c in columns]
    place = F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    return place.isin([_place(p) for p in places])


def _by_partition(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """``df`` laid out so that a partition is written by few tasks."""
    return df.hint("rebalance", *map(F.col, partition_by)) if partition_by else df


class Store:
    """The tables below one folder."""

    def __init__(self, spark: SparkSession, base: str, files: Files | None = None):
        self.spark, self.base, self.files = spark, base.rstrip("/"), files or Files(spark)

    # -- manifests ---------------------------------------------------------
    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.base}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> Manifest | None:
        """A manifest, None if it was cut off."""
        raw = self.files.read(f"{self.base}/{MANIFESTS}/{number:012d}.json")
        digest, _, body = raw.partition(b"\n")
        return Manifest.from_json(body.decode()) if digest == hashlib.sha256(body).hexdigest().encode() else None

    def manifest(self) -> Manifest:
        """The last whole manifest; an empty one where there is none."""
        for number in reversed(self._numbers()):
            found = self._load(number)
            if found is not None:
                return found
        return Manifest()

    # -- reading -----------------------------------------------------------
    def read(self, table: str, schema: str, partition_by: tuple[str, ...] = (), manifest: Manifest | None = None,
             folder: str | None = None, only: set[str] | None = None) -> DataFrame:
        """The table of the last whole manifest (or of ``manifest``), as one
        scan; ``partition_by`` are columns of ``schema``.  ``folder`` names a
        column for the data folder of each row, ``only`` the folders to read."""
        entries = [e for e in (manifest or self.manifest()).tables.get(table, []) if only is None or e.folder in only]
        # no rows and known to have none, so that joins with it fall away
        empty = self.spark.createDataFrame([], f"{schema}, {folder} string" if folder else schema).limit(0)
        names = [F.col("commit").alias(folder) if c == folder else F.col(c) for c in empty.columns]
        if not entries:
            return empty
        root = f"{self.base}/{table}"
        df = (self.spark.read.schema(f"{schema}, commit string").option("basePath", root)
              .parquet(*[f"{root}/commit={e.folder}" for e in entries]))
        hidden: dict[tuple, list[str]] = {}
        for e in entries:
            if e.without:
                hidden.setdefault(e.without, []).append(e.folder)
        for places, found in hidden.items():
            df = df.where(~(F.col("commit").isin(found) & _among(partition_by, places)))
        return df.select(*names)

    # -- staging -----------------------------------------------------------
    def stage(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), tag: str | None = None) -> Entry:
        """Write ``df`` as a data folder of ``table`` that no manifest names yet."""
        folder = f"c{uuid.uuid4().hex}"         # not to be taken for a number
        self.files.write(df, f"{self.base}/{table}/commit={folder}", partition_by)
        return Entry(folder, tag)

    def stage_merge(self, table: str, new: DataFrame, schema: str, keys: list[str], partition_by: tuple[str, ...]
                    ) -> list[Entry]:
        """The entries of ``table`` with the rows of ``new`` put in by key: a
        stored row of the same key goes, all others stay.

        Copy on write by partition: only partitions that hold a replaced key
        are written anew, the others stay the files they are.  A partition that
        ``new`` only adds to is not rewritten either.
        """
        manifest = self.manifest()
        entries = manifest.tables.get(table, [])
        staged = self.stage(table, new, partition_by)
        if not entries:
            return [staged]
        columns = list(partition_by)
        fresh = self.spark.read.schema(schema).parquet(f"{self.base}/{table}/commit={staged.folder}")
        old = self.read(table, schema, partition_by, manifest)
        # partitions of the new rows bound what is read of the stored ones; rows of `touched` are partitions, not messages
        touched = fresh.select(*columns).distinct()
        hit = (old.join(touched, columns, "left_semi").join(fresh.select(*keys).distinct(), keys, "left_semi")
               .select(*columns).distinct().limit(HIDDEN + 1).collect())
        if not hit:
            return [*entries, staged]
        chosen = [tuple(r) for r in hit]
        if len(chosen) + sum(len(e.without) for e in entries) > HIDDEN:
            rest = old.join(fresh.select(*keys), keys, "left_anti")
            return [self.stage(table, _by_partition(rest, partition_by), partition_by), staged]
        kept = old.where(_among(columns, chosen)).join(fresh.select(*keys), keys, "left_anti")
        rest = self.stage(table, _by_partition(kept, partition_by), partition_by)
        hidden = [Entry(e.folder, e.tag, tuple(sorted({*e.without, *chosen}, key=repr))) for e in entries]
        return [*hidden, rest, staged]

    def stage_compacted(self, table: str, schema: str, partition_by: tuple[str, ...] = (), spread: list[str | Column] = (),
                        small: int = 256 << 20) -> list[Entry] | None:
        """The entries of ``table`` with the small folders, and those with
        hidden partitions, written together into one; None if there is nothing
        to join.  Large folders stay as they are, so the work follows what was
        added since, not the table.  Rows are laid out by ``spread``."""
        manifest = self.manifest()
        entries = manifest.tables.get(table, [])
        joined = [e for e in entries if e.without or self.files.size(f"{self.base}/{table}/commit={e.folder}") < small]
        if len(joined) < 2 and not any(e.without for e in joined):
            return None
        df = self.read(table, schema, partition_by, Manifest(tables={table: joined}))
        df = df.repartition(*spread) if spread else df.coalesce(1)
        # tags end here: a run is replayed only while it is the last one
        return [*[e for e in entries if e not in joined], self.stage(table, df, partition_by)]

    # -- committing --------------------------------------------------------
    def commit(self, add: dict[str, list[Entry]] | None = None, replace: dict[str, list[Entry]] | None = None,
               facts: dict | None = None) -> Manifest:
        """The next manifest: ``add`` appends entries to tables (those with a
        tag take the place of entries with the same tag), ``replace`` sets the
        entries of a table, ``facts`` updates small facts."""
        numbers = self._numbers()
        last = self.manifest()
        tables = {t: list(es) for t, es in last.tables.items()}
        for t, es in (replace or {}).items():
            tables[t] = list(es)
        for t, es in (add or {}).items():
            tags = {e.tag for e in es if e.tag}
            tables[t] = [e for e in tables.get(t, []) if e.tag not in tags] + list(es)
        nxt = Manifest(max(numbers, default=-1) + 1, tables, {**last.facts, **(facts or {})})
        body = nxt.to_json().encode()
        self.files.create(f"{self.base}/{MANIFESTS}/{nxt.number:012d}.json", hashlib.sha256(body).hexdigest().encode() + b"\n" + body)
        return nxt

    def vacuum(self, keep: int = KEPT) -> None:
        """Delete manifests before the last ``keep`` whole ones, and data
        folders that none of those names (superseded, or staged by a run that
        was cut off).  Only the writer may call this, between its commits."""
        whole = [m for m in map(self._load, self._numbers()) if m is not None][-keep:]
        if not whole:
            return
        named = {(t, e.folder) for m in whole for t, es in m.tables.items() for e in es}
        for number in self._numbers():
            if number < whole[0].number:
                self.files.delete(f"{self.base}/{MANIFESTS}/{number:012d}.json")
        tables = {t for m in whole for t in m.tables}
        for t in sorted(tables):
            for name in self.files.names(f"{self.base}/{t}"):
                if name.startswith("commit=") and (t, name[7:]) not in named:
                    self.files.delete(f"{self.base}/{t}/{name}")

    # -- rounds ------------------------------------------------------------
    def round_of(self, run: str) -> int:
        """The number of a run: its own if it was begun before (a replay),
        else the next one.  Commit :meth:`begun` to remember it."""
        facts = self.manifest().facts
        return dict(facts.get("runs", [])).get(run, facts.get("rounds", 0))

    def begun(self, run: str) -> dict:
        """Facts that remember the number of ``run``."""
        facts = self.manifest().facts
        runs = [r for r in facts.get("runs", [])]
        if run in dict(runs):
            return {}
        number = facts.get("rounds", 0)
        return {"rounds": number + 1, "runs": [*runs, [run, number]][-RUNS:]}
