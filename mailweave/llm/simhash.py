"""SimHash near-duplicates: fingerprints, and a binary trie joined with itself.

Fingerprints are grouped first, so copies of a text (or any texts with one
fingerprint) are a single leaf.  The trie over the distinct fingerprints is
walked as pairs of nodes that carry the bits in which they differ so far; a
pair is dropped when that count exceeds the budget.

How the trie is dealt out: the 64 bits are cut into ``budget + 1`` blocks.
Two fingerprints within the budget agree in one block at least, so for each
block there is one trie with that block's bits on top, and only subtrees under
equal top blocks have to be joined with themselves.  Subtrees larger than
``SUBTREE`` are cut deeper: their nodes some levels down are joined pair by
pair, again only pairs within the budget.  What is still larger then (edited
copies of one text agree in most bits) is dealt by hash into shares of that
size, and pairs of shares are joined, so no group is walked by one task alone.
Linked leaves leave a task as a spanning forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, forest, min_labels, unused, utf8, whole_groups
from .components import components

SHINGLE = 4
BUDGET = 4
SEED = 42
#: leaves a task joins at once; larger subtrees are cut deeper
SUBTREE = 20_000
#: shares that a group is dealt into at most (two of 11 bits fit into a key)
SHARES = 2048
#: node pairs held at once, and the leaf product below which a pair is compared directly
FRONTIER, DIRECT = 400_000, 64


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z lower-cased, words between ASCII
    white space, ``shingle``-word shingles; no word gives 0, fewer words than
    a shingle give one shingle of all of them."""
    words = raw.lower().split()
    if not words:
        return 0
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    text = b" ".join(words)
    if len(words) > shingle:
        ends = ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(ends), 1 << 15):
        h = np.fromiter((digest(text[s:e - 1], SEED) for s, e in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)])),
                        dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = 2 * total > len(ends)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of every row of ``docs``; fp is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fp = np.array([simhash(t, shingle) for t in utf8(b.column("text"))], dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, fp bigint")


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of the ``budget + 1`` blocks; at most 16
    bits of a block name its subtrees."""
    cuts = [round(64 * i / (budget + 1)) for i in range(budget + 2)]
    return [(lo, min(16, hi - lo)) for lo, hi in zip(cuts, cuts[1:])]


def _expand(count_a: np.ndarray, count_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs of ranges: pair number, and offsets of every combination of their members."""
    size = count_a * count_b
    pair = np.repeat(np.arange(len(size)), size)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
    return pair, k // count_b[pair], k % count_b[pair]


def join_trie(values: np.ndarray, roots: list[np.ndarray], budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of ``values`` within ``budget`` bits.

    ``values`` are sorted within each root range; ``roots`` holds the starting
    node pairs as (first a, end a, first b, end b), equal ranges for a join of
    a subtree with itself.
    """
    ones: list[np.ndarray | None] = [None] * 64

    def below(depth: int) -> np.ndarray:
        if ones[depth] is None:
            bit = (values >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int32))])
        return ones[depth]

    lo_a, hi_a, lo_b, hi_b = roots
    todo = [(0, lo_a, hi_a, lo_b, hi_b, np.zeros(len(lo_a), dtype=np.int8))]
    while todo:
        depth, lo_a, hi_a, lo_b, hi_b, diff = todo.pop()
        if len(lo_a) > FRONTIER:
            todo += [(depth, *(x[at:at + FRONTIER] for x in (lo_a, hi_a, lo_b, hi_b, diff)))
                     for at in range(0, len(lo_a), FRONTIER)]
            continue
        leaf = ((hi_a - lo_a) * (hi_b - lo_b) <= DIRECT) | (depth == 64)
        if leaf.any():
            a0, a1, b0, b1 = lo_a[leaf], hi_a[leaf], lo_b[leaf], hi_b[leaf]
            pair, i, j = _expand(a1 - a0, b1 - b0)
            i, j = a0[pair] + i, b0[pair] + j
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            if near.any():
                yield i[near], j[near]
            keep = ~leaf
            lo_a, hi_a, lo_b, hi_b, diff = (x[keep] for x in (lo_a, hi_a, lo_b, hi_b, diff))
        if not len(lo_a):
            continue
        c = below(depth)
        mid_a, mid_b = hi_a - (c[hi_a] - c[lo_a]), hi_b - (c[hi_b] - c[lo_b])
        same = (lo_a == lo_b) & (hi_a == hi_b)
        children = [(lo_a, mid_a, lo_b, mid_b, diff), (mid_a, hi_a, mid_b, hi_b, diff),
                    (lo_a, mid_a, mid_b, hi_b, diff + 1), (mid_a, hi_a, lo_b, mid_b, diff + 1)]
        nxt = []
        for k, (a0, a1, b0, b1, d) in enumerate(children):
            live = (a1 > a0) & (b1 > b0) & (d <= budget)
            if k == 3:
                live &= ~same  # the mirror image of the third child
            nxt.append([x[live] for x in (a0, a1, b0, b1, d)])
        todo.append((depth + 1, *(np.concatenate(x) for x in zip(*nxt))))


def _links(budget: int):
    spans = _blocks(budget)

    def run(batches):
        for t in whole_groups(batches, "key"):
            key, fp, node = (t[c].to_numpy() for c in ("key", "fp", "node"))
            fp, block, cross = fp.astype(np.uint64), t["block"].to_numpy(), t["cross"].to_numpy()
            turn = np.array([lo for lo, _ in spans], dtype=np.uint64)[block]
            turned = np.where(turn == 0, fp, (fp << turn) | (fp >> ((np.uint64(64) - turn) % np.uint64(64))))
            order = np.lexsort((turned, cross, key))
            key, fp, node, block, cross, turned = (x[order] for x in (key, fp, node, block, cross, turned))
            edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1])]))
            lo, hi = edge, np.append(edge[1:], len(key))
            # in a cross join of two subtrees the rows of the first come first (cross 0, then 1)
            ones = np.concatenate([[0], np.cumsum(cross)])
            mid = hi - (ones[hi] - ones[lo])
            is_cross = (mid > lo) & (mid < hi)
            roots = [lo, np.where(is_cross, mid, hi), np.where(is_cross, mid, lo), hi]
            # a cross join with an empty side has nothing to do
            live = is_cross | (t["sides"].to_numpy()[order][lo] == 1)
            label = np.arange(len(node))
            for i, j in join_trie(turned, [r[live] for r in roots], budget):
                label = min_labels(label, i, j)
            child, root = forest(label, node)
            if len(child):
                yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], names=["a", "b"])
    return run


def _shared_out(dealt: DataFrame, subtree: int) -> DataFrame:
    """Rows of keys with more than twice ``subtree`` rows, dealt to pairs of
    shares: each share meets itself and every other one, under keys of their
    own.  In a cross join of two subtrees the shares of one meet those of the
    other."""
    large = (dealt.groupBy("key").count().where(F.col("count") > 2 * subtree)
             .select("key", F.least(F.lit(SHARES), F.ceil(F.col("count") / subtree)).cast("int").alias("shares")))
    # at most one such key per 2 * subtree rows; most often there is none, and nothing is joined
    if large.isEmpty():
        return dealt
    rows = dealt.join(large, "key", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    rows = rows.withColumn("h", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("o"))
    alone = F.col("sides") == 1
    x = F.when(alone, F.least("h", "o")).when(F.col("cross") == 0, F.col("h")).otherwise(F.col("o"))
    y = F.when(alone, F.greatest("h", "o")).when(F.col("cross") == 0, F.col("o")).otherwise(F.col("h"))
    return rows.select(
        "fp", "node", "block", F.when(alone, (F.col("h") > F.col("o")).cast("int")).otherwise(F.col("cross")).alias("cross"),
        F.when(alone & (x == y), F.lit(1)).otherwise(F.lit(2)).alias("sides"),
        F.col("key").bitwiseOR(F.shiftleft(x.cast("bigint"), 37)).bitwiseOR(F.shiftleft(y.cast("bigint"), 51)).alias("key"))


def near_links(leaves: DataFrame, budget: int = BUDGET, subtree: int = SUBTREE) -> DataFrame:
    """``leaves(fp, node)``, one row per distinct fingerprint -> ``(a, b)``
    links between nodes that span every component of fingerprints within
    ``budget`` bits."""
    spans = _blocks(budget)
    top = F.array(*[F.struct(F.lit(k).alias("block"),
                             F.shiftrightunsigned("fp", 64 - lo - w).bitwiseAND(F.lit((1 << w) - 1)).alias("top"))
                    for k, (lo, w) in enumerate(spans)])
    dealt = leaves.select("fp", "node", F.explode(top).alias("t")).select("fp", "node", "t.block", "t.top")
    # at most (budget + 1) * 2^16 subtrees exist, so this table is bounded whatever the input
    large = (dealt.groupBy("block", "top").count().where(F.col("count") > subtree)
             .select("block", "top", F.least(F.lit(10), F.ceil(F.log2(F.col("count") / subtree)) + 1)
                     .cast("int").alias("deeper")))
    dealt = dealt.join(F.broadcast(large), ["block", "top"], "left").withColumn("deeper", F.coalesce("deeper", F.lit(0)))
    # the next ``deeper`` bits after the top block, on the fingerprint turned so that the block comes first
    start = F.element_at(F.array(*[F.lit(lo + w) for lo, w in spans]), F.col("block") + 1) % 64
    dealt = (dealt.withColumn("start", start.cast("int"))
             .withColumn("own", F.when(F.col("deeper") == 0, F.lit(0).cast("bigint")).otherwise(
                 F.expr("shiftrightunsigned(CASE WHEN start = 0 THEN fp ELSE "
                        "shiftleft(fp, start) | shiftrightunsigned(fp, 64 - start) END, 64 - deeper)"))))
    other = F.expr(f"filter(sequence(0L, shiftleft(1L, deeper) - 1), t -> bit_count(t ^ own) <= {budget})")
    dealt = dealt.select("fp", "node", "block", "top", "own", F.explode(other).alias("with"))
    dealt = dealt.select(
        "fp", "node", "block",
        F.expr("cast(own > `with` AS int)").alias("cross"),
        F.expr("CASE WHEN own = `with` THEN 1 ELSE 2 END").alias("sides"),
        F.expr("shiftleft(cast(block AS bigint), 48) | shiftleft(top, 24) | shiftleft(least(own, `with`), 12)"
               " | greatest(own, `with`)").alias("key"))
    dealt = _shared_out(dealt, subtree)
    n = max(1, int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (dealt.repartition(n, "key").sortWithinPartitions("key")
            .mapInArrow(_links(budget), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fp, component_id)``, one row per row.

    component_id is the smallest doc_id reachable over links of at most
    ``budget`` differing bits.  Null and empty texts have fingerprint 0 and
    link like any other.  Rows without a doc_id get a fingerprint and a null
    component; repeated rows each return; other columns are ignored; an empty
    table gives an empty table.
    """
    fps = scratch.table(fingerprints(docs, shingle), "fingerprints")
    leaves = scratch.table(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "leaves")
    comp = components(near_links(leaves, budget), scratch)
    classes = scratch.table(
        leaves.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")), "classes")
    scratch.drop("leaves")
    scratch.drop_like("edges-")
    # both sides are tables, so AQE can split the fingerprint of a large group of copies
    return (fps.join(classes, "fp", "left")
            .select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def one_per_group(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest
    doc_id (one row of it if the row is repeated).  Rows without a doc_id
    stay, as nothing can stand for them."""
    kept_id = unused("kept_id", docs.columns)
    keep = (near_duplicates(docs, scratch, shingle, budget).where("doc_id = component_id")
            .select(F.col("doc_id").alias(kept_id)).distinct())
    kept = (docs.where("doc_id IS NOT NULL").join(keep, F.col("doc_id") == F.col(kept_id), "left_semi")
            .dropDuplicates(["doc_id"]))
    return kept.unionByName(docs.where("doc_id IS NULL"))
