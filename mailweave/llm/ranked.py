"""Ranked lexical search by bag deduplication: BM25 of items over all documents.

A document counts for an item only through how often it holds the item's terms
and through its length factor ``m``.  So documents are restricted to the terms
of the items, those with equal term counts and equal ``m`` form one class
(found by hash, verified by the counts themselves), every class is scored once,
and its members follow in ascending ``doc_id``.  No more than ``TOP`` members
of a class can be among the ``TOP`` documents of an item, and those are the
first: a class of any size leaves each task with that many rows.

All scores are sums of integers.  They are taken as matrix products in double
precision where every sum stays below 2^53 and is exact, else in 64-bit
integers.

Items are searched in blocks of at most ``BLOCK_TERMS`` (item, term) rows,
which is what the driver and every task hold of them; more items make more
passes over the documents.

Nulls and odd rows: a null text has no term; a document without a term counts
in nothing; a null ``doc_id`` comes after all others; repeated rows are
documents of their own, repeated items are each ranked for themselves; an item
without a term, or an empty table, gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, slices, utf8

TOP = 10
BLOCK_TERMS = 500_000
#: classes scored at once, and the cells of a matrix
CLASSES, CELLS = 2_000, 4_000_000
EXACT = 1 << 53
#: every byte that no term holds becomes a space, A-Z their lower-case letters
FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return raw.translate(FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``items(item_id, text)`` -> ``(no, item_id, term, q)``: ``no`` numbers
    the items' rows, ``q`` is how often the item holds the term."""
    def split(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                rows = [(no, ident, t, q) for no, ident, raw in zip(b.column("no").to_pylist(), b.column("item_id").to_pylist(),
                                                                    utf8(b.column("text")))
                        for t, q in Counter(terms(raw)).items()]
                cols = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()).cast(pa.string()),
                     pa.array(cols[3], pa.int64())], names=["no", "item_id", "term", "q"])
    numbered = items.select(F.monotonically_increasing_id().alias("no"), F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return numbered.mapInArrow(split, "no bigint, item_id bigint, term string, q bigint")


def blocks(found: DataFrame, limit: int) -> Iterator[list]:
    """The rows of :func:`item_terms` in blocks of whole items, each of about
    ``limit`` rows (an item of more is a block of its own)."""
    size, count = found.groupBy("no").agg(F.count(F.lit(1)).alias("n")), found.count()
    parts = max(1, -(-count // limit))
    if parts == 1:
        yield found.orderBy("no", "term").collect()
        return
    # items by size in ranges of the running sum, taken over hashed shares so that no task sees them all
    share = size.withColumn("share", F.pmod(F.xxhash64("no"), F.lit(4 * parts)))
    cut = share.withColumn("at", F.sum("n").over(Window.partitionBy("share").orderBy("no")))
    dealt = cut.select("no", "share", F.floor((F.col("at") - 1) / limit).alias("part"))
    placed = found.join(dealt, "no")
    for share_no, part in sorted(tuple(r) for r in dealt.select("share", "part").distinct().collect()):
        yield placed.where((F.col("share") == share_no) & (F.col("part") == part)).orderBy("no", "term").collect()


def lengths(docs: DataFrame) -> tuple[int, int]:
    """(N, L): the documents that hold a term, and all their terms with repeats."""
    def count(batches):
        n = total = 0
        for batch in batches:
            for b in slices(batch, "text"):
                sizes = [len(terms(raw)) for raw in utf8(b.column("text"))]
                n, total = n + sum(map(bool, sizes)), total + sum(sizes)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "l"])
    r = docs.select(F.col("text").cast("string")).mapInArrow(count, "n bigint, l bigint").agg(F.sum("n"), F.sum("l")).first()
    return r[0] or 0, r[1] or 0


BAG = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents restricted to the vocabulary: ``n`` counts all terms, ``terms``
    (ascending numbers) and ``tfs`` those of the vocabulary.  Documents without
    any term are left out."""
    def restrict(batches):
        known = vocabulary.get
        for batch in batches:
            for b in slices(batch, "text"):
                ids, sizes, offsets, flat_terms, flat_tfs = [], [], [0], [], []
                for ident, raw in zip(b.column("doc_id").to_pylist(), utf8(b.column("text"))):
                    held = terms(raw)
                    if not held:
                        continue
                    bag = sorted((k, tf) for t, tf in Counter(held).items() if (k := known(t)) is not None)
                    ids.append(ident)
                    sizes.append(len(held))
                    flat_terms += [k for k, _ in bag]
                    flat_tfs += [tf for _, tf in bag]
                    offsets.append(len(flat_terms))
                at = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(at, pa.array(flat_terms, pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(flat_tfs, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(restrict, BAG)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def classes(held: DataFrame, n: int, total: int, top: int) -> DataFrame:
    """Bags -> ``(m, terms, tfs, members)``: one row per class of equal counts
    and ``m``, with its first ``top`` members by ``doc_id``.

    The rows of a class are cut to ``top`` in every task before they meet, so
    a class of any size is a few rows per task.  The hash leads the sort; the
    counts after it verify it."""
    keys = ["h", "m", "terms", "tfs"]
    m = F.expr(f"25 + (75 * n * {n}L) div {max(total, 1)}L")
    some = held.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    hashed = some.select("*", F.xxhash64("m", "terms", "tfs").alias("h"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("doc_id").asc_nulls_last()))
    first = hashed.withColumn("at", place).where(F.col("at") <= top)
    return first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "doc_id"))).alias("members")).select(
        "m", "terms", "tfs", F.col("members.doc_id").alias("members"))


class Ranking:
    """The best documents seen so far, for each item of a block.

    ``asked`` lists (item, term, value), the value being weight times number of
    occurrences, by item; ``exact`` says that double precision loses nothing.
    No product has a side of more than ``CELLS`` cells."""

    def __init__(self, asked: np.ndarray, vocabulary: int, items: int, exact: bool, top: int):
        self.asked, self.items, self.top, self.kind = asked, items, top, np.float64 if exact else np.int64
        self.place = np.full(vocabulary, -1)
        self.best: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]

    def add(self, b: pa.RecordBatch) -> None:
        """Score a batch of classes, each once, and keep what can be among the best."""
        terms_ = b.column("terms")
        row = np.repeat(np.arange(b.num_rows), np.diff(terms_.offsets.to_numpy()))
        used, local = np.unique(terms_.flatten().to_numpy(), return_inverse=True)
        if b.num_rows > 1 and b.num_rows * len(used) > CELLS:
            half = b.num_rows // 2
            self.add(b.slice(0, half))
            self.add(b.slice(half))
            return
        tf = b.column("tfs").flatten().to_numpy().astype(np.int64)
        bag = np.zeros((b.num_rows, len(used)), dtype=self.kind)
        bag[row, local] = 1_000_000_000 * tf // (1000 * tf + 8 * b.column("m").to_numpy()[row])
        members = b.column("members")
        end = np.cumsum(np.diff(members.offsets.to_numpy()))
        first = np.concatenate([[0], end[:-1]])
        ids = members.flatten()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.place[used] = np.arange(len(used))
        wide = max(1, CELLS // max(b.num_rows, len(used), 1))
        for block in range(0, self.items, wide):
            lo, hi = np.searchsorted(self.asked[:, 0], [block, block + wide])
            part = self.asked[lo:hi]
            at = self.place[part[:, 1]]
            part, at = part[at >= 0], at[at >= 0]
            matrix = np.zeros((len(used), min(wide, self.items - block)), dtype=self.kind)
            matrix[at, part[:, 0] - block] = part[:, 2]
            scores = bag @ matrix
            for j in range(scores.shape[1]):
                self.keep(block + j, scores[:, j], first, end, ids, null)
        self.place[used] = -1

    def keep(self, item: int, score: np.ndarray, first, end, ids, null) -> None:
        """The ``top`` best classes by (score, first member) hold the ``top`` best documents."""
        best, top = self.best[item], self.top
        least = best[-1][0] * -1 if len(best) == top else 1
        open_ = np.flatnonzero(score >= least)
        if len(open_) > top:
            worst = np.partition(score[open_], len(open_) - top)[len(open_) - top]
            open_ = open_[score[open_] >= worst]
            order = np.lexsort((ids[first[open_]], null[first[open_]], -score[open_]))
            open_ = open_[order[:top]]
        if len(open_):
            best += [(-int(score[c]), bool(null[k]), int(ids[k])) for c in open_ for k in range(first[c], end[c])]
            best.sort()
            del best[top:]


def search_block(docs: DataFrame, rows: list, n: int, total: int, top: int, scratch: Scratch, name: str) -> DataFrame:
    """``(no, item_id, rank, doc_id, score)`` of the items of one block."""
    vocabulary = {t.encode(): k for k, t in enumerate(sorted({r.term for r in rows}))}
    held = scratch.table(bags(docs, vocabulary), name, "zstd")
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r.term] = r.df
    items = sorted({(r.no, r.item_id) for r in rows}, key=lambda i: i[0])
    column = {no: k for k, (no, _) in enumerate(items)}
    asked = np.array([(column[r.no], k, r.q * weight(n, int(df[k]))) for r in rows for k in [vocabulary[r.term.encode()]]],
                     dtype=np.int64)
    asked = asked[np.argsort(asked[:, 0], kind="stable")]
    # a term adds less than 10^6 times its value
    exact = int(np.bincount(asked[:, 0], weights=asked[:, 2]).max()) * 1_000_000 < EXACT
    size = len(vocabulary)

    def score(batches):
        ranking = Ranking(asked, size, len(items), exact, top)
        for batch in batches:
            for at in range(0, batch.num_rows, CLASSES):
                ranking.add(batch.slice(at, CLASSES))
        out = [(k, None if no_id else ident, -s) for k, best in enumerate(ranking.best) for s, no_id, ident in best]
        cols = list(zip(*out)) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["k", "doc_id", "score"])
    found = classes(held, n, total, top).mapInArrow(score, "k bigint, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("k").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame([(k, i[0], i[1]) for k, i in enumerate(items)], "k bigint, no bigint, item_id bigint")
    return ranked.join(F.broadcast(names), "k").select("no", "item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, scratch: Scratch, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents of every item, ``docs(doc_id, text)`` and
    ``items(item_id, text)`` -> ``(item_id, rank, doc_id, score)``, for scores
    above 0; equal scores by ascending ``doc_id``."""
    n, total = lengths(docs)
    found = scratch.table(item_terms(items), "items")
    done = [scratch.table(search_block(docs, rows, n, total, top, scratch, f"bags-{k}"), f"ranked-{k}")
            for k, rows in enumerate(blocks(found, block_terms)) if rows]
    scratch.drop("items", *[f"bags-{k}" for k in range(len(done))])
    empty = docs.sparkSession.createDataFrame([], "no bigint, item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, done, empty).select("item_id", "rank", "doc_id", "score")
