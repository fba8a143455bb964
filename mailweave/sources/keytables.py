"""Key tables in equal buckets: which keys a table of a store holds.

Beside a table of a :class:`~mailweave.sources.snapshots.Store`, ``<table>_keys``
holds its distinct keys, hashed into the same number of buckets for every table
and sorted within them.  An anti-join of two key tables then needs no exchange
on either side: bucket meets bucket in one task, however large the archive is.

:meth:`KeyTables.sync` brings them up to date.  It reads the keys of the data
folders that are not noted as covered, drops those the key table has (only the
new keys are exchanged, the key table is read bucket by bucket), and makes the
rest and the note visible with one commit.  Folders that repeat stored keys, as
compaction and keyed replacement write them, therefore add nothing.  Keys only
ever join a table, so nothing has to be taken back.

Spark writes and reads buckets through a catalog table.  It is a view of the
store's folder: an in-memory catalog gets it anew in every session, and what
counts is decided by the manifest alone.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import KEYS
from ..session import hadoop_path
from .snapshots import Entry, Store

#: buckets of new key tables; a store keeps the number it began with
BUCKETS, BUCKETS_CONF = 64, "spark.mailweave.keyBuckets"
#: data folders of a key table, beyond which they are written together
FOLDERS = 16
SCHEMA = "account string, mailbox string, uid bigint"


class KeyTables:
    """The key tables of one store."""

    def __init__(self, store: Store):
        self.store, self.spark = store, store.spark
        conf = self.spark.conf.get(BUCKETS_CONF, None)
        self.buckets = store.manifest().facts.get("key_buckets") or int(conf or BUCKETS)

    def _root(self, table: str) -> str:
        return hadoop_path(self.spark, f"{self.store.base}/{table}_keys")[1].toString()

    def _name(self, table: str) -> str:
        """The catalog table over a key table's folder, declared where the catalog lacks it."""
        root = self._root(table)
        name = f"mailweave_keys_{hashlib.md5(f'{root} {self.buckets}'.encode()).hexdigest()}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}, commit string) USING parquet PARTITIONED BY (commit) "
                       f"CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({', '.join(KEYS)}) INTO {self.buckets} BUCKETS LOCATION '{root}'")
        return name

    def _stage(self, table: str, keys: DataFrame) -> Entry:
        """Write keys as a data folder of buckets that no manifest names yet."""
        folder = f"c{uuid.uuid4().hex}"
        self.store.files.write_buckets(keys.select(*KEYS, F.lit(folder).alias("commit")), self._name(table), "commit",
                                       self.buckets, KEYS)
        return Entry(folder)

    def read(self, table: str) -> DataFrame:
        """The keys of ``table`` as of its last sync, bucket by bucket."""
        entries = self.store.manifest().tables.get(f"{table}_keys", [])
        if not entries:
            return self.spark.createDataFrame([], SCHEMA)
        name = self._name(table)
        self.spark.catalog.refreshTable(name)
        df = self.spark.table(name)
        return df.where(df["commit"].isin([e.folder for e in entries])).select(*KEYS)

    def sync(self, *tables: str) -> None:
        """Bring the key tables up to the last commit; work and exchange follow
        what was written since the last sync."""
        manifest = self.store.manifest()
        covered = dict(manifest.facts.get("keys_of", {}))
        replace: dict[str, list[Entry]] = {}
        for t in tables:
            folders = {e.folder for e in manifest.tables.get(t, [])}
            fresh = [e for e in manifest.tables.get(t, []) if e.folder not in covered.get(t, [])]
            covered[t] = sorted(folders)
            if not fresh:
                continue
            root = f"{self.store.base}/{t}"
            keys = (self.spark.read.schema(f"{SCHEMA}, commit string").option("basePath", root)
                    .parquet(*[f"{root}/commit={e.folder}" for e in fresh]).select(*KEYS)
                    .repartition(self.buckets, *KEYS).distinct())
            known = manifest.tables.get(f"{t}_keys", [])
            if known:
                # hints keep the buckets as they are; a broadcast of the archive's keys is never wanted
                keys = keys.join(self.read(t).hint("merge"), KEYS, "left_anti")
            staged = self._stage(t, keys)
            replace[f"{t}_keys"] = [*known, staged]
        if replace or covered != manifest.facts.get("keys_of", {}):
            self.store.commit(replace=replace, facts={"key_buckets": self.buckets, "keys_of": covered})
        self._join_folders([t for t in tables if len(replace.get(f"{t}_keys", [])) > FOLDERS])

    def _join_folders(self, tables: list[str]) -> None:
        """One data folder in place of many, written bucket by bucket without an exchange."""
        replace = {}
        for t in tables:
            keys = self.read(t)
            # the aggregation is what makes the scan keep its buckets; it exchanges nothing
            replace[f"{t}_keys"] = [self._stage(t, keys.groupBy(*KEYS).agg({"*": "count"}).select(*KEYS))]
        if replace:
            self.store.commit(replace=replace)

    def missing(self, table: str, *others: str) -> DataFrame:
        """Keys of ``table`` that none of the other tables holds: bucket by bucket, no exchange."""
        keys = self.read(table)
        for t in others:
            if self.store.manifest().tables.get(f"{t}_keys"):
                keys = keys.join(self.read(t).hint("merge"), KEYS, "left_anti")
        return keys
