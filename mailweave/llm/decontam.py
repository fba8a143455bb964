"""Benchmark decontamination: BM25 inverted index of the test items, searched
with the words of every document.

Items lie in blocks; the index keeps the impact of each term on each item and
its maximum over each block.  A document passes a block when the block maxima
of its terms reach the block's need (block-max WAND, evaluated for a batch of
documents at once); very frequent terms are left out of that bound, their whole
weight is granted to every item.  Only the postings of blocks that pass are
scored, and items at or above their threshold are verified on the document's
words.  The threshold of an item is the least score that a text leaking it can
have, so no leak is missed, wherever in the text the words stand and whichever
index holds the item.

An item is a question and an answer: its last line, or the last sentence of a
one-line item.  A document leaks it in one of two ways, each counted over the
whole text:

* run on: it holds ``SIMILARITY`` or more of the item's five-word shingles, and
  ``PART`` of those inside the question and of those that end in the answer;
* apart: of the shingles wholly inside the question and those wholly inside the
  answer (all words of a part, if fewer than five) it holds ``SIMILARITY``
  together and ``PART`` of each, and somewhere a question shingle and an answer
  shingle have at most ``GAP`` times the item's words between them.  Answer
  words that the text has only within the question do not count.  Items of
  fewer than five words leak only when run on.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import Scratch, slices, texts

SHINGLE, SIMILARITY, PART = 5, 0.8, 0.5
#: words between question and answer, as a multiple of the item's words
GAP = 2
K1, B = 1.2, 0.75
#: items of an index block, and bytes of item texts held by one index; more items make more indexes
BLOCK, INDEX_BYTES = 8, 4 << 20
#: share of an item's threshold that frequent terms may be granted
GRANT = 0.5
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def split_item(text: str) -> tuple[list[str], int]:
    """Words of an item, and the number of them that belong to its question."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    if len(lines) < 2:
        lines = [x for x in SENTENCE.split(text) if WORD.search(x)]
    all_words = words(text)
    return all_words, len(all_words) - len(words(lines[-1])) if len(lines) > 1 else len(all_words)


def shingles(w: list) -> list[tuple]:
    """Five-word shingles; fewer words make one shingle."""
    return [tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))] if w else []


def mixed(terms: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each row of ``width`` term numbers."""
    h = np.full(len(terms), seed, dtype=np.uint64)
    for k in range(width):
        h = (h ^ (terms[:, k].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Shingles:
    """Distinct shingles of one width, found in a text by hash and compared by term."""

    def __init__(self, rows: list[tuple[int, ...]], number: list[int]):
        terms, numbers = np.array(rows, dtype=np.int32), np.array(number, dtype=np.int32)
        self.width, self.seed = terms.shape[1], 0
        while len(np.unique(hashes := mixed(terms, self.width, self.seed))) < len(terms):
            self.seed += 1
        order = np.argsort(hashes)
        self.hashes, self.terms, self.numbers = hashes[order], terms[order], numbers[order]

    def find(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the text and the shingle numbers that stand there."""
        if len(t) < self.width:
            return np.empty(0, np.int64), np.empty(0, np.int32)
        windows = np.lib.stride_tricks.sliding_window_view(t, self.width)
        at = np.flatnonzero((windows >= 0).all(axis=1))
        h = mixed(windows[at], self.width, self.seed)
        row = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        same = np.flatnonzero(self.hashes[row] == h)
        same = same[(self.terms[row[same]] == windows[at[same]]).all(axis=1)]
        return at[same], self.numbers[row[same]]


class Places:
    """The item shingles that one text holds, and where."""

    def __init__(self, index: Index, t: np.ndarray):
        self.index, self.t, self.found = index, t, {}

    def of(self, part: np.ndarray, width: int) -> tuple[np.ndarray, float]:
        """Places of the shingles of ``part``, and the share of them that is held
        (1 for no shingles)."""
        if not len(part):
            return part, 1.0
        if width not in self.found:
            self.found[width] = self.index.by_width[width].find(self.t)
        at, number = self.found[width]
        hit = np.isin(number, part)
        return at[hit], len(np.unique(number[hit])) / len(part)


def close(q: np.ndarray, q_width: int, a: np.ndarray, a_width: int, n: int, gap: int) -> bool:
    """Whether a question and an answer shingle (given by their sorted places in a text of
    ``n`` words) have at most ``gap`` words between them; answers inside the question's places are left out."""
    covered = np.zeros(n + 1, dtype=np.int64)
    np.add.at(covered, q, 1)
    np.add.at(covered, q + q_width, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:n]) > 0)])
    a = a[inside[a + a_width] - inside[a] < a_width]
    if not len(a) or not len(q):
        return False
    after = np.searchsorted(q, a, side="right")
    before = np.where(after > 0, a - q[np.maximum(after - 1, 0)] - q_width, n)
    behind = np.where(after < len(q), q[np.minimum(after, len(q) - 1)] - a - a_width, n)
    return bool((np.minimum(before, behind) <= gap).any())


class Index:
    """Inverted index of ``(item_id, text)`` rows; items without a word are left out."""

    def __init__(self, items: list[tuple[int | None, str]]):
        kept = sorted(((i, *split_item(t)) for i, t in items if WORD.search(t or "")),
                      key=lambda x: (len(x[1]), x[0] is None, x[0] or 0, x[1]))
        self.ids = [i for i, _, _ in kept]
        self.lengths = [(q, len(w) - q) for _, w, q in kept]
        n, df = len(kept), Counter(t for _, w, _ in kept for t in set(w))
        self.terms = {t: k for k, t in enumerate(sorted(df))}
        # shingles are numbered; an item has those of its whole, two subsets of them, and those inside its two parts
        number: dict[tuple[int, ...], int] = {}
        self.run_on: list[tuple[np.ndarray, ...]] = []
        self.apart: list[tuple[np.ndarray, ...] | None] = []
        for _, w, q in kept:
            t = [self.terms[x] for x in w]

            def numbered(of: list[tuple]) -> np.ndarray:
                return np.array(sorted({number.setdefault(x, len(number)) for x in of}), dtype=np.int32)
            s, end = shingles(t), min(SHINGLE, len(t))
            self.run_on.append((numbered(s), numbered([x for k, x in enumerate(s) if k + end <= q]),
                                numbered([x for k, x in enumerate(s) if k + end > q])))
            self.apart.append((numbered(shingles(t[:q])), numbered(shingles(t[q:]))) if 0 < q < len(t) and len(t) >= SHINGLE else None)
        by_width: dict[int, tuple[list, list]] = {}
        for x, k in number.items():
            rows, numbers = by_width.setdefault(len(x), ([], []))
            rows.append(x)
            numbers.append(k)
        self.by_width = {width: Shingles(*x) for width, x in by_width.items()}
        # BM25 impacts, and the least score of a text that leaks the item
        mean = sum(len(w) for _, w, _ in kept) / max(1, n)
        idf = {t: np.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
        impact: list[dict[int, float]] = []
        for _, w, _ in kept:
            impact.append({self.terms[t]: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean))
                           for t, f in Counter(w).items()})
        self.threshold = np.zeros(n)
        for k, weights in enumerate(impact):
            # at most so many shingles may be missing, and each can take one term with it; the only shingle
            # of a part or item under five words cannot be missing
            most = max(len(self.run_on[k][0]), sum(map(len, self.apart[k] or ())))
            ranked = sorted(weights.values(), reverse=True)
            self.threshold[k] = sum(ranked[int(np.floor((1 - SIMILARITY) * most + 1e-9)):]) * (1 - 1e-9)
        # frequent terms are granted to all items, as long as no item gets more than GRANT of its threshold
        holders: dict[int, list[int]] = {}
        for k, weights in enumerate(impact):
            for t in weights:
                holders.setdefault(t, []).append(k)
        granted = np.zeros(n)
        essential = dict(holders)
        for t in sorted(holders, key=lambda t: (-len(holders[t]), t)):
            if len(holders[t]) > 1 and all(granted[k] + impact[k][t] <= GRANT * self.threshold[k] for k in holders[t]):
                for k in holders[t]:
                    granted[k] += impact[k][t]
                del essential[t]
        need = np.maximum(self.threshold - granted, 1e-12)
        # block maxima, scaled so that a block passes at 1; in rows by term
        rows: list[dict[int, float]] = [{} for _ in self.terms]
        for t, items_of in essential.items():
            for k in items_of:
                rows[t][k // BLOCK] = max(rows[t].get(k // BLOCK, 0.0), impact[k][t] / need[k])
        self.row_start = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        self.block_of = np.array([b for r in rows for b in r], dtype=np.int64)
        self.bound = np.array([x for r in rows for x in r.values()])
        self.blocks = -(-n // BLOCK)
        # postings of all terms, block after block
        self.post_term = np.array([t for weights in impact for t in weights], dtype=np.int64)
        self.post_item = np.array([k for k, weights in enumerate(impact) for _ in weights], dtype=np.int64)
        self.post_impact = np.array([x for weights in impact for x in weights.values()])
        self.block_start = np.searchsorted(self.post_item, np.arange(self.blocks + 1) * BLOCK)

    def candidates(self, owner: np.ndarray, term: np.ndarray) -> np.ndarray:
        """(text, block) pairs that reach the block's need, from (text, term) hits."""
        pair = np.unique(owner * len(self.terms) + term)  # a text counts a term once
        owner, term = pair // len(self.terms), pair % len(self.terms)
        count = self.row_start[term + 1] - self.row_start[term]
        at = np.repeat(self.row_start[term], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        key, where = np.unique(np.repeat(owner, count) * self.blocks + self.block_of[at], return_inverse=True)
        reached = np.bincount(where, self.bound[at], len(key)) >= 1 - 1e-9
        return key[reached]

    def scores(self, present: np.ndarray, block: int) -> np.ndarray:
        """BM25 score of each item of a block for a text with the terms flagged in ``present``."""
        lo, hi = self.block_start[block], self.block_start[block + 1]
        hit = present[self.post_term[lo:hi]]
        return np.bincount(self.post_item[lo:hi][hit] - block * BLOCK, self.post_impact[lo:hi][hit], min(BLOCK, len(self.ids) - block * BLOCK))

    def verify(self, places: Places, k: int) -> tuple[float, float, float] | None:
        """Overlaps of item ``k`` (whole, question, answer) with a text, or None if it does not leak."""
        q, a = self.lengths[k]
        shares = [places.of(part, min(SHINGLE, q + a))[1] for part in self.run_on[k]]
        if shares[0] >= SIMILARITY and min(shares[1:]) >= PART:
            return tuple(shares)
        if not self.apart[k]:
            return None
        q_width, a_width = min(SHINGLE, q), min(SHINGLE, a)
        (q_at, question), (a_at, answer) = places.of(self.apart[k][0], q_width), places.of(self.apart[k][1], a_width)
        n_q, n_a = map(len, self.apart[k])
        whole = (round(question * n_q) + round(answer * n_a)) / (n_q + n_a)
        if whole >= SIMILARITY and min(question, answer) >= PART and close(q_at, q_width, a_at, a_width, len(places.t), GAP * (q + a)):
            return whole, question, answer
        return None

    def search(self, batch: list[str]) -> list[tuple[int, int, float, float, float, float]]:
        """(text number, item number, score, overlaps) of every leak."""
        if not self.ids:
            return []
        all_terms, owner, term, get = [], [], [], self.terms.get
        for doc, text in enumerate(batch):
            w = words(text)
            t = np.fromiter((get(x, -1) for x in w), dtype=np.int64, count=len(w))
            all_terms.append(t)
            distinct = np.unique(t[t >= 0])
            distinct = distinct[self.row_start[distinct + 1] > self.row_start[distinct]]
            owner.append(np.full(len(distinct), doc))
            term.append(distinct)
        blocks: dict[int, list[int]] = {}
        for key in self.candidates(np.concatenate(owner), np.concatenate(term)).tolist() if owner else []:
            blocks.setdefault(key // self.blocks, []).append(key % self.blocks)
        out, present = [], np.zeros(len(self.terms), dtype=bool)
        for doc, passed in sorted(blocks.items()):
            t = all_terms[doc]
            known = t[t >= 0]
            present[known] = True
            places = Places(self, t)
            for b in passed:
                score = self.scores(present, b)
                for j in np.flatnonzero(score >= self.threshold[b * BLOCK:b * BLOCK + len(score)]).tolist():
                    found = self.verify(places, b * BLOCK + j)
                    if found:
                        out.append((doc, b * BLOCK + j, float(score[j]), *found))
            present[known] = False
        return out


def indexes(benchmark: DataFrame) -> list[str]:
    """Paths of the indexes over ``benchmark(item_id, text)``, each of about INDEX_BYTES
    of item texts at most.  Tasks build and write them, one to a task; tasks that search
    load one at a time (about 13 bytes for each of a text), and only the paths pass the
    driver.  No item, no index."""
    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).where("text IS NOT NULL").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    folder = Scratch(benchmark.sparkSession, "items").dir

    def build(group: pa.Table) -> pa.Table:
        index = Index(list(zip(group["item_id"].to_pylist(), group["text"].to_pylist())))
        path = files.new_path(folder, ".index")
        with files.create(path) as out:
            pickle.dump(index, out, protocol=pickle.HIGHEST_PROTOCOL)
        return pa.table({"path": [path]})
    share = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-size // INDEX_BYTES))))
    built = items.groupBy(share.alias("share")).applyInArrow(build, "path string")
    return sorted(r.path for r in built.collect())


@lru_cache(maxsize=1)
def load(path: str) -> Index:
    """An index, kept by a Python worker until it needs another."""
    with files.open_stream(path) as f:
        return pickle.load(f)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, bm25, overlap, question_overlap, answer_overlap)``
    for every document row and item that it leaks, counted over the whole
    text.  Null and empty texts leak nothing, null and empty items
    are not leaked; null ids are carried; repeated rows each return; other
    columns are ignored; an empty table gives an empty table."""
    schema = "doc_id bigint, item_id bigint, bm25 double, overlap double, question_overlap double, answer_overlap double"
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    parts = []
    for path in indexes(benchmark):
        def run(batches, path=path):
            index = load(path)
            for batch in batches:
                for b in slices(batch, "text"):
                    found = index.search(texts(b.column("text")))
                    cols = list(zip(*found)) if found else [[]] * 6
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(pa.array(cols[0], pa.int64())),
                         pa.array([index.ids[k] for k in cols[1]], pa.int64()),
                         *[pa.array(c, pa.float64()) for c in cols[2:]]],
                        names=["doc_id", "item_id", "bm25", "overlap", "question_overlap", "answer_overlap"])
        parts.append(docs.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text leaks an item; all columns stay, as do
    rows with a null or empty text and repeated rows; an empty table stays empty."""
    for path in indexes(benchmark):
        def run(batches, path=path):
            index = load(path)
            for batch in batches:
                for b in slices(batch, "text"):
                    column = b.column(b.schema.get_field_index("text"))
                    bad = np.zeros(b.num_rows, dtype=bool)
                    bad[[doc for doc, *_ in index.search(texts(column))]] = True
                    yield b.filter(pa.array(~bad))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
