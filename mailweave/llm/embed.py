"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Only vectors of one length can be compared; each length has cells of its own.
Equal vectors are grouped first, by a 128-bit digest of their values; one of
each group (the smallest vec_id) goes on with the number of its copies.
Spherical k-means gives every vector a home cell.  A vector is also a guest of
each cell whose border is so close that a partner may lie beyond it: with homes
a and b, two unit vectors at cosine ``threshold`` lie at most
``delta = sqrt(2 - 2 threshold)`` apart, so one of them lies within
``delta / 2`` of the plane between the centroids of a and b.  Hence no link is
lost.

Every vector is written once, into a file of the block it belongs to: some whole
cells, or a part of a large one.  Tasks read the files of two rows of blocks and
compare the vectors of each cell with its guests.  So the disk holds each vector
a fixed number of times, however many blocks it meets; a task returns sums of
links and a spanning forest, never pairs.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import Scratch, forest, min_labels, whole_groups
from .components import components

THRESHOLD = 0.9
#: vectors the centroids are fitted on, vectors per cell aimed at, most cells, rounds
SAMPLE, PER_CELL, MAX_CELLS, ROUNDS = 20_000, 300, 4_096, 10
#: vectors of a block, and bytes of a block in double precision; smaller tables are cut into so many blocks
BLOCK, BLOCK_BYTES, BLOCKS = 4_096, 8 << 20, 16
#: blocks of one side of a task at most, and such sides aimed at; tasks at most
SIDE, SIDES, TASKS = 16, 12, 20_000
#: pairs compared at once; how far a single-precision product may be off, at least
SLAB, MARGIN = 1 << 19, 1e-4
#: part of a slab's pairs that may pass the bound before whole products are taken
SPARSE = 0.002
#: vectors converted at once; links held until the components are joined
PIECE, HELD = 2_000, 1 << 20
#: cells of one coarse cell, which follow each other
COARSE = 16


def _packed(kind: str, values: bool):
    """``(vec_id, embedding)`` -> ``(vec_id, size, same[, v])``, row by row.

    ``same`` is a digest of the vector, which equal vectors share (-0 and 0 are
    equal, and so are any NaNs).  ``size`` is the number of components and v
    their bytes; both are null where the vector cannot link: without an id, null,
    zero, or with a null or non-finite component."""
    def piece(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, vectors = batch.column("vec_id"), batch.column("embedding")
        size = pa.compute.fill_null(pa.compute.list_value_length(vectors), 0).to_numpy().astype(np.int64)
        flat = vectors.flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        x = pa.compute.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)
        x[np.isnan(x)] = np.nan
        ends = np.cumsum(size)
        starts = ends - size

        def some(flags: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(flags)])
            return upto[ends] > upto[starts]
        there = vectors.is_valid().to_numpy(zero_copy_only=False)
        holes = some(~known)
        fine = ids.is_valid().to_numpy(zero_copy_only=False) & there & ~some(~known | ~np.isfinite(x)) & some(x != 0)
        data, width = x.tobytes(), np.dtype(kind).itemsize
        parts = [data[width * a:width * b] if t else None for a, b, t in zip(starts.tolist(), ends.tolist(), there.tolist())]
        same = [None if p is None else hashlib.blake2b(p + known[a:b].tobytes() if h else p, digest_size=16, person=b"null" * h).digest()
                for p, a, b, h in zip(parts, starts.tolist(), ends.tolist(), holes.tolist())]
        out = {"vec_id": ids, "size": pa.array(size.astype(np.int32), mask=~fine), "same": pa.array(same, pa.binary())}
        if values:
            out["v"] = pa.array([p if f else None for p, f in zip(parts, fine.tolist())], pa.binary())
        return pa.RecordBatch.from_pydict(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                yield piece(batch.slice(at, PIECE))
    return run


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component so that no square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(rounds):
        home = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        length = np.linalg.norm(sums, axis=1)
        centroids = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centroids)
    return np.unique(centroids, axis=0)


def matrix(values, size: int, kind: str) -> np.ndarray:
    """The vectors of an Arrow column of their bytes, of length 1."""
    return unit(np.frombuffer(b"".join(values.to_pylist()), dtype=kind).reshape(-1, size).astype(np.float64))


def fit_cells(reps: DataFrame, n: int, size: int, kind: str) -> np.ndarray:
    """Centroids fitted on at most about SAMPLE distinct vectors of one length, picked by a hash."""
    few = reps.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / n)))
    rows = few.select("node", "v").limit(2 * SAMPLE + 1).toArrow()
    if rows.num_rows > 2 * SAMPLE:
        raise ValueError(f"more than {2 * SAMPLE} vectors in a sample of {SAMPLE}")
    if not rows.num_rows:
        rows = reps.select("node", "v").limit(1).toArrow()
    x = matrix(rows["v"], size, kind)[np.argsort(rows["node"].to_numpy())]
    centroids = spherical_kmeans(x, max(1, min(MAX_CELLS, n // PER_CELL, len(x))))
    # near cells follow each other, so that a block is near few others
    coarse = spherical_kmeans(centroids, -(-len(centroids) // COARSE))
    return centroids[np.argsort((centroids @ coarse.T).argmax(axis=1), kind="stable")]


def fit_lengths(reps: DataFrame, kind: str) -> dict[int, tuple[int, np.ndarray]]:
    """Vector length -> its first cell and its centroids, one of zeros where one
    cell is enough.  Cells of different lengths have different numbers."""
    out, first = {}, 0
    for size, n in sorted(tuple(r) for r in reps.groupBy("size").count().collect()):
        centroids = fit_cells(reps.where(F.col("size") == size), n, size, kind) if n >= 2 * PER_CELL else np.zeros((1, size))
        out[size] = (first, centroids)
        first += len(centroids)
    return out


def reach(threshold: float) -> float:
    """How far from a border a vector may lie that has a partner beyond it."""
    return math.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-6


def guest_of(own: np.ndarray, sims: np.ndarray, apart: np.ndarray, threshold: float, slack: float = 1e-12) -> np.ndarray:
    """Whether the border to a cell is within reach: from the products with the
    centroids of the home and of the cell, and the distance of the two.  That the
    home is the nearest cell is not needed."""
    return own - sims <= reach(threshold) * apart + slack


def homes(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x.astype(np.float32) @ centroids.T.astype(np.float32)).argmax(axis=1)


def _in_cells(lengths: dict[int, tuple[int, np.ndarray]], kind: str, dealt: tuple[np.ndarray, np.ndarray] | None = None):
    """``(size, node, copies, v)`` -> ``(cell, n)``, the vectors of each cell
    seen; with ``dealt`` (the first block and the number of blocks of each cell)
    -> ``(block, cell, node, copies, v)``, the vectors of a cell dealt to its blocks."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                mixed = batch.slice(at, PIECE)
                sizes = mixed.column("size").to_numpy()
                cell = np.empty(len(sizes), dtype=np.int64)
                for size in np.unique(sizes).tolist():
                    first, centroids = lengths[size]
                    mine = np.flatnonzero(sizes == size)
                    cell[mine] = first
                    if len(centroids) > 1:
                        cell[mine] += homes(matrix(mixed.column("v").take(pa.array(mine)), size, kind), centroids)
                if dealt is None:
                    found, n = np.unique(cell, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"cell": pa.array(found, pa.int32()), "n": pa.array(n, pa.int64())})
                    continue
                mixed_up = (mixed.column("node").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                block = dealt[0][cell] + (mixed_up % dealt[1][cell].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(cell.astype(np.int32)),
                                                  *(mixed.column(c) for c in ("node", "copies", "v"))],
                                                 names=["block", "cell", "node", "copies", "v"])
    return run


def plan_blocks(count: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first block and the number of blocks of each cell, from the vectors
    and the vector length of each: cells that follow each other share a block,
    a large one has several of its own."""
    most = max(BLOCK // 8, min(BLOCK, int(count.sum()) // BLOCKS))
    first, number, block, held = np.zeros(len(count), dtype=np.int64), np.ones(len(count), dtype=np.int64), -1, 0
    for cell, (n, size) in enumerate(zip(count.tolist(), sizes.tolist())):
        room = max(1, min(most, BLOCK_BYTES // (8 * size)))
        if block < 0 or held + n > room or size != sizes[cell - 1]:
            block, held = block + 1, 0
        first[cell], number[cell] = block, max(1, -(-n // room))
        block, held = block + int(number[cell]) - 1, held + n
    return first, number


class Blocks:
    """Where the vectors of each block lie and which cells they are near."""

    def __init__(self, lengths: dict[int, tuple[int, np.ndarray]], kind: str, threshold: float):
        self.lengths, self.kind, self.threshold = lengths, kind, threshold
        self.size: list[int] = []
        self.path: list[str] = []
        self.rows: list[int] = []
        #: of each block its first and last cell, and a bit for each cell whether it has homes or guests there; cells as numbered in their length
        self.span: list[tuple[int, int]] = []
        self.near: list[bytes] = []

    def visits(self, a: int, b: int) -> bool:
        first, last = self.span[b]
        return bool(np.unpackbits(np.frombuffer(self.near[a], dtype=np.uint8))[first:last + 1].any())

    def meet(self, a: int, b: int) -> bool:
        return self.size[a] == self.size[b] and (self.visits(a, b) or self.visits(b, a))


class Block:
    """A block's vectors as a task holds them, in the order of their cells."""

    def __init__(self, blocks: Blocks, number: int):
        n, size = blocks.rows[number], blocks.size[number]
        with files.open_stream(blocks.path[number]) as f:
            data = f.read()
        self.node, self.copies, cell = np.frombuffer(data, "<i8", 3 * n).reshape(3, n)
        self.x = unit(np.frombuffer(data, blocks.kind, n * size, 24 * n).reshape(n, size).astype(np.float64))
        self.single = self.x.astype(np.float32)
        # the first components and the length of the rest: the product of two of these is not less than that of the vectors
        lead = size // 2 - 1 if size >= 32 else size
        rest = np.linalg.norm(self.x[:, lead:], axis=1, keepdims=True)
        self.short = np.hstack([self.x[:, :lead], rest]).astype(np.float32) if lead < size else self.single
        self.threshold = blocks.threshold
        #: the cells, the number of its cell for each vector, and where the vectors of each begin and end
        self.cells, self.part = np.unique(cell, return_inverse=True)
        self.ends = [0, *np.cumsum(np.bincount(self.part)).tolist()]
        self.centroids = blocks.lengths[size][1][self.cells]
        self.own = np.einsum("ij,ij->i", self.x, self.centroids[self.part])

    def guests(self, other: Block) -> np.ndarray:
        """Boolean (vector, cell of the other block): whether it lives there or is a guest."""
        apart = np.linalg.norm(self.centroids[:, None] - other.centroids, axis=2)
        near = guest_of(self.own[:, None], self.x @ other.centroids.T, apart[self.part], self.threshold)
        return near | (self.cells[self.part][:, None] == other.cells)


def _written(blocks: Blocks, sizes: np.ndarray, folder: str):
    """``(block, cell, node, copies, v)`` sorted by block and cell -> a row for each block, written as a file."""
    def write(number: int, t: pa.Table) -> dict:
        cell = t["cell"].to_numpy().astype(np.int64)
        size = int(sizes[cell[0]])
        first, centroids = blocks.lengths[size]
        cell = cell - first
        path = files.new_path(folder, ".block")
        with files.create(path) as out:
            for c in (t["node"].to_numpy(), t["copies"].to_numpy(), cell):
                out.write(np.ascontiguousarray(c, dtype="<i8").tobytes())
            out.write(b"".join(t["v"].to_pylist()))
        near = np.zeros(len(centroids), dtype=bool)
        near[cell] = True
        for c in np.unique(cell).tolist() if len(centroids) > 1 else ():
            mine = np.flatnonzero(cell == c)
            apart = np.linalg.norm(centroids - centroids[c], axis=1).astype(np.float32)
            for at in range(0, len(mine), PIECE):
                x = matrix(t["v"].take(pa.array(mine[at:at + PIECE])), size, blocks.kind).astype(np.float32)
                sims = x @ centroids.T.astype(np.float32)
                near |= guest_of(sims[:, [c]], sims, apart, blocks.threshold, MARGIN).any(axis=0)
        return {"block": number, "size": size, "rows": t.num_rows, "path": path, "first": int(cell[0]), "last": int(cell[-1]),
                "near": np.packbits(near).tobytes()}

    def run(batches):
        for t in whole_groups(batches, "block", rows=BLOCK):
            number = t["block"].to_numpy()
            cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
            for lo, hi in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_pylist([write(int(number[lo]), t.slice(lo, hi - lo))], schema=pa.schema(
                    [("block", pa.int32()), ("size", pa.int32()), ("rows", pa.int64()), ("path", pa.string()), ("first", pa.int32()),
                     ("last", pa.int32()), ("near", pa.binary())]))
    return run


def write_blocks(reps: DataFrame, kind: str, scratch: Scratch, threshold: float) -> Blocks:
    """The vectors of ``reps(size, node, copies, v)`` in a file for each block;
    the driver holds a row for each."""
    spark = reps.sparkSession
    lengths = fit_lengths(reps, kind)
    sizes = np.array([size for size in sorted(lengths) for _ in lengths[size][1]], dtype=np.int64)
    count = np.zeros(len(sizes), dtype=np.int64)
    seen = reps.select("size", "node", "copies", "v").mapInArrow(_in_cells(lengths, kind), "cell int, n bigint")
    for cell, n in seen.groupBy("cell").agg(F.sum("n")).collect():
        count[cell] = n
    first, number = plan_blocks(count, sizes)
    blocks = Blocks(lengths, kind, threshold)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(number.sum()) // SIDE)
    made = (reps.select("size", "node", "copies", "v")
            .mapInArrow(_in_cells(lengths, kind, (first, number)), "block int, cell int, node bigint, copies bigint, v binary")
            .repartition(parts, "block").sortWithinPartitions("block", "cell")
            .mapInArrow(_written(blocks, sizes, scratch.path("blocks")),
                        "block int, size int, rows bigint, path string, first int, last int, near binary"))
    for r in sorted(made.collect(), key=lambda r: r.block):
        blocks.size.append(r.size)
        blocks.path.append(r.path)
        blocks.rows.append(r.rows)
        blocks.span.append((r.first, r.last))
        blocks.near.append(bytes(r.near))
    return blocks


class Links:
    """Links found among the vectors of some blocks: how many each vector has,
    copies counted, and the components."""

    def __init__(self, sides: list[Block], threshold: float):
        self.at, self.threshold = {}, threshold
        self.node = np.concatenate([b.node for b in sides])
        for b, start in zip(sides, np.cumsum([0, *(len(b.node) for b in sides)]).tolist()):
            self.at[id(b)] = start
        self.links, self.label = np.zeros(len(self.node), dtype=np.int64), np.arange(len(self.node))
        self.met: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def join(self) -> None:
        """Put the links that are held into the components."""
        if self.met:
            i, j = (np.concatenate(x) for x in zip(*self.met))
            self.label, self.met, self.held = min_labels(self.label, i, j), [], 0

    def compare(self, a: Block, b: Block, rows: np.ndarray, first: int, end: int, met_before) -> None:
        """Vectors ``rows`` of one block with those from ``first`` to ``end`` of
        another or the same; ``met_before(i, j)``, if any, says which pairs are met elsewhere."""
        here, there, cols = self.at[id(a)], self.at[id(b)], np.arange(first, end)
        margin = max(MARGIN, 1.2e-7 * a.x.shape[1])
        low, bounded = np.float32(self.threshold - margin), a.short is not a.single
        step = max(1, SLAB // max(1, len(cols)))
        for at in range(0, len(rows), step):
            r = rows[at:at + step]
            if bounded:
                rough = a.short[r] @ b.short[first:end].T
                if rough.max() < low:
                    continue
                i, j = np.divmod(np.flatnonzero(rough >= low), len(cols))
                bounded = len(i) <= SPARSE * rough.size
            if not bounded:
                rough = a.single[r] @ b.single[first:end].T
                hit = rough >= self.threshold + margin
                i, j = np.nonzero((rough >= low) & ~hit)
            sure = np.concatenate([np.einsum("ij,ij->i", a.x[r[i[k:k + (1 << 14)]]], b.x[first + j[k:k + (1 << 14)]]) >= self.threshold
                                   for k in range(0, len(i), 1 << 14)] or [np.zeros(0, dtype=bool)])
            if bounded:
                i, j = r[i[sure]], first + j[sure]
                if met_before:
                    new = ~met_before(i, j)
                    i, j = i[new], j[new]
                np.add.at(self.links, here + i, b.copies[j])
                np.add.at(self.links, there + j, a.copies[i])
                self.met.append((here + i, there + j))
                self.held += len(i)
                if self.held > HELD:
                    self.join()
                continue
            hit[i[sure], j[sure]] = True
            if not hit.any():
                continue
            if met_before:
                hit &= ~met_before(r[:, None], cols[None, :])
            self.links[here + r] += hit @ b.copies[first:end]
            self.links[there + cols] += a.copies[r] @ hit
            i, j = np.nonzero(hit & (self.label[here + r][:, None] != self.label[there + cols][None, :]))
            self.label = min_labels(self.label, here + r[i], there + cols[j])

    def meet(self, a: Block, b: Block) -> None:
        """A block with another or itself: the vectors of each cell with those
        that live there or are guests.  Of two linked vectors of different cells
        one at least is a guest of the other's cell; if both are, the link counts once."""
        of_a, of_b = a.guests(b), b.guests(a)

        def met_in_block(i, j):
            return (i >= j) & of_a[j, a.part[i]]

        def met_there(i, j):
            return of_a[j, b.part[i]]
        for k in range(len(b.cells)):
            self.compare(a, b, np.flatnonzero(of_a[:, k]), b.ends[k], b.ends[k + 1], met_in_block if a is b else None)
        for k in range(len(a.cells)) if a is not b else ():
            guests = of_b[:, k] & (b.cells[b.part] != a.cells[k])
            self.compare(b, a, np.flatnonzero(guests), a.ends[k], a.ends[k + 1], met_there)

    def rows(self) -> pa.RecordBatch:
        """``(a, b, n)``: rows with b null add n links to node a, the others are
        links that span the components.  No list of all pairs is ever made."""
        self.join()
        counted = np.flatnonzero(self.links)
        child, root = forest(self.label, self.node)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([self.node[counted], child])),
             pa.array(np.concatenate([np.zeros(len(counted), dtype=np.int64), root]), mask=np.arange(len(counted) + len(child)) < len(counted)),
             pa.array(np.concatenate([self.links[counted], np.zeros(len(child), dtype=np.int64)]))], names=["a", "b", "n"])


def _compared(path: str, side: int):
    """Pairs of sides, by number -> their :class:`Links`.  A side is ``side``
    blocks in a row; a pair of sides has its earlier one first."""
    def pair(blocks: Blocks, number: int) -> pa.RecordBatch | None:
        later = (math.isqrt(8 * number + 1) - 1) // 2
        earlier = number - later * (later + 1) // 2
        left, right = (range(k * side, min((k + 1) * side, len(blocks.path))) for k in (earlier, later))
        wanted = [(i, j) for j in right for i in left if i <= j and blocks.meet(i, j)]
        if not wanted:
            return None
        held = {k: Block(blocks, k) for k in sorted({k for w in wanted for k in w})}
        links = Links(list(held.values()), blocks.threshold)
        for i, j in wanted:
            links.meet(held[i], held[j])
        return links.rows()

    def run(batches):
        blocks = None
        for batch in batches:
            for number in batch.column(0).to_pylist():
                if blocks is None:
                    with files.open_stream(path) as f:
                        blocks = pickle.load(f)
                found = pair(blocks, number)
                if found is not None and found.num_rows:
                    yield found
    return run


def compare_blocks(blocks: Blocks, scratch: Scratch) -> DataFrame:
    """``(a, b, n)`` of all pairs of blocks, see :meth:`Links.rows`."""
    n = len(blocks.path)
    side = max(1, min(SIDE, n // SIDES))
    path = files.new_path(scratch.path("blocks"), ".list")
    with files.create(path) as out:
        pickle.dump(blocks, out)
    sides = -(-n // side)
    pairs = sides * (sides + 1) // 2
    return (scratch.spark.range(0, pairs, 1, max(1, min(pairs, TASKS)))
            .mapInArrow(_compared(path, side), "a bigint, b bigint, n bigint"))


def near_duplicates(vectors: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> ``(vec_id, n_links, component_id,
    kept)``, one row per distinct (vec_id, embedding).

    n_links counts the other vectors with a cosine of ``threshold`` or more,
    copies included; vectors of different lengths have no cosine and no link,
    also where they share an id.  Vectors that cannot be compared (null, zero,
    a null or non-finite component) have no link.  A null vec_id has no link, a null component and is not kept.  Other
    columns are ignored; an empty table gives an empty table.
    """
    as_is = dict(vectors.dtypes)["embedding"] == "array<float>"
    kind = "<f4" if as_is else "<f8"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<float>" if as_is else "array<double>").alias("embedding"))
    ids = scratch.table(rows.mapInArrow(_packed(kind, False), "vec_id bigint, size int, same binary").distinct(), "ids")
    able = ids.where("size IS NOT NULL")
    groups = able.groupBy("same", "size").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    # an id may stand at several vectors, a node is one vector; nodes are in the order of the ids
    groups = scratch.table(groups.orderBy("id").withColumn("node", F.monotonically_increasing_id()), "groups")
    # the vector of each node; the rows that repeat an id and a vector go before the exchange
    values = (rows.mapInArrow(_packed(kind, True), "vec_id bigint, size int, same binary, v binary").where("v IS NOT NULL")
              .select("vec_id", "same", "v").dropDuplicates(["vec_id", "same"]))
    reps = values.join(groups.withColumnRenamed("id", "vec_id"), ["vec_id", "same"]).select("size", "node", "copies", "v")
    reps = scratch.table(reps, "reps")
    del values
    scratch.release()
    blocks = write_blocks(reps, kind, scratch, threshold)
    scratch.drop("reps")
    found = scratch.table(compare_blocks(blocks, scratch), "found")
    scratch.drop("blocks")
    comp = components(found.where("b IS NOT NULL").select("a", "b"), scratch)
    comp = comp.join(groups.select(F.col("node").alias("component"), F.col("id").alias("component_id")), "component").drop("component")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    classes = scratch.table(
        groups.join(links, "node", "left").join(comp, "node", "left")
        .select("same", F.col("copies"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component_id", "id").alias("component_id")),
        "classes")
    # both sides are tables, so AQE can split the copies of a common vector
    linked = able.join(classes, "same").select(
        "vec_id", (F.col("copies") - 1 + F.col("n")).alias("n_links"), "component_id")
    alone = ids.where("size IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    scratch.drop("groups", "found")
    scratch.drop_like("edges-")
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
