"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins by quantiles.  Cyclic boosting goes round
the features; each step fits a shallow tree to the gradients of one feature's
bins and adds it to that feature's lookup table.  The pairs with the strongest
interaction are then boosted in the same way over two-dimensional bins.  A
score is the logistic of a sum of table entries, so scoring is a vectorised
bin addition.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, slices, utf8

#: bound of the labelled sample the model is fitted on (documents, in expectation)
MAX_TRAIN = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 150, 60, 0.1, 1.0
THRESHOLD = 0.3

FEATURES = ("chars", "words", "word_length", "distinct_words", "longest_word", "upper", "digits", "punctuation",
            "symbols", "exclamations", "bars", "non_ascii", "space", "lines_per_word", "repeated_lines", "top_word",
            "short_words", "long_words", "sentence_ends", "symbol_endings", "mean_line")


def _classes() -> np.ndarray:
    """Membership of each byte in the character classes counted below."""
    c = np.zeros((256, 7), dtype=np.float64)
    for b in range(256):
        ch = chr(b)
        if b >= 128:
            c[b, 5] = 1
        elif ch.isupper():
            c[b, 0] = 1
        elif ch.islower():
            c[b, 1] = 1
        elif ch.isdigit():
            c[b, 2] = 1
        elif ch in ".,;:'\"?!-()":
            c[b, 3] = 1
        elif b <= 32:
            c[b, 6] = 1
        else:
            c[b, 4] = 1
    return c


CLASSES = _classes()
SYMBOLS = frozenset(np.flatnonzero(CLASSES[:, 4]).tolist())


def features(raw: bytes) -> np.ndarray:
    """The feature vector of a whole text; an empty text gives zeros."""
    out = np.zeros(len(FEATURES))
    words = raw.split()
    if not words:
        return out
    count = np.zeros(256)
    for at in range(0, len(raw), 1 << 20):
        count += np.bincount(np.frombuffer(raw, np.uint8, min(1 << 20, len(raw) - at), at), minlength=256)
    upper, lower, digit, punct, symbol, high, space = count @ CLASSES
    n, size = len(words), len(raw)
    length = np.fromiter(map(len, words), dtype=np.int64, count=n)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out[:] = (np.log1p(size), np.log1p(n), length.mean(), len(seen) / n, np.log1p(length.max()),
              upper / max(1.0, upper + lower + high), digit / size, punct / size, symbol / size,
              count[ord("!")] / n, count[ord("|")] / n, high / size, space / size, len(lines) / n,
              1 - len(set(lines)) / len(lines), max(seen.values()) / n, (length <= 3).mean(), (length >= 12).mean(),
              (count[ord(".")] + count[ord("!")] + count[ord("?")]) / n,
              sum(w[-1] in SYMBOLS for w in words) / n, np.log1p(n / len(lines)))
    return out


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int) -> np.ndarray:
    """Leaf value per bin of a shallow tree over ordered bins."""
    value = np.full(len(grad), grad.sum() / (hess.sum() + RIDGE))
    if depth == 0 or len(grad) < 2:
        return value
    g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    rest_g, rest_h = grad.sum() - g, hess.sum() - h
    gain = g * g / (h + RIDGE) + rest_g * rest_g / (rest_h + RIDGE)
    cut = int(gain.argmax()) + 1
    return np.concatenate([_tree(grad[:cut], hess[:cut], depth - 1), _tree(grad[cut:], hess[cut:], depth - 1)])


def _pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a depth-two tree that cuts one axis, then the other within each half; and its gain."""
    best, best_gain = np.zeros_like(grad), -1.0
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        for cut in range(1, len(g)):
            value, gain = np.empty_like(g), 0.0
            for half in (slice(0, cut), slice(cut, None)):
                gg, hh = g[half].sum(axis=0), h[half].sum(axis=0)
                cg, ch = np.cumsum(gg)[:-1], np.cumsum(hh)[:-1]
                tg, th = gg.sum(), hh.sum()
                gains = cg * cg / (ch + RIDGE) + (tg - cg) ** 2 / (th - ch + RIDGE)
                k = int(gains.argmax()) + 1
                value[half, :k] = cg[k - 1] / (ch[k - 1] + RIDGE)
                value[half, k:] = (tg - cg[k - 1]) / (th - ch[k - 1] + RIDGE)
                gain += gains[k - 1]
            if gain > best_gain:
                best, best_gain = (value.T if turned else value).copy(), gain
    return best, best_gain


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


@dataclass
class Gam:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Gam":
        if not len(y):
            return self
        rate = (y.sum() + 0.5) / (len(y) + 1)
        self.intercept = float(np.log(rate / (1 - rate)))
        k = x.shape[1]
        self.edges = [_edges(x[:, f], BINS) for f in range(k)]
        self.coarse = [_edges(x[:, f], PAIR_BINS) for f in range(k)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        fine = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]
        rough = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.coarse)]
        total = np.full(len(y), self.intercept)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for f, b in enumerate(fine):
                if len(self.tables[f]) < 2:
                    continue
                g, h = slopes()
                step = RATE * _tree(np.bincount(b, g, len(self.tables[f])), np.bincount(b, h, len(self.tables[f])), 2)
                self.tables[f] += step
                total += step[b]

        def grid(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
            shape = (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
            return rough[i] * shape[1] + rough[j], shape

        g, h = slopes()
        ranked = []
        for i in range(k):
            for j in range(i + 1, k):
                cell, shape = grid(i, j)
                if min(shape) < 2:
                    continue
                gg, hh = (np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (g, h))
                # interaction strength: the best two-way cut of what main effects leave
                ranked.append((_pair_tree(gg, hh)[1], -i, -j))
        self.pairs = [(-i, -j) for _, i, j in sorted(ranked, reverse=True)[:PAIRS]]
        self.pair_tables = [np.zeros(grid(i, j)[1]) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for t, (i, j) in zip(self.pair_tables, self.pairs):
                cell, shape = grid(i, j)
                g, h = slopes()
                gg, hh = (np.bincount(cell, w, t.size).reshape(shape) for w in (g, h))
                step = RATE * _pair_tree(gg, hh)[0]
                t += step
                total += step.ravel()[cell]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(e, x[:, f], side="right")]
        for t, (i, j) in zip(self.pair_tables, self.pairs):
            total += t[np.searchsorted(self.coarse[i], x[:, i], side="right"),
                       np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def matrix(column) -> np.ndarray:
    rows = [features(t) for t in utf8(column)]
    return np.stack(rows) if rows else np.zeros((0, len(FEATURES)))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of about ``max_train`` labelled documents outside the
    held-out fold, picked by a hash of the doc_id (all of them if there are
    fewer).  Null labels are ignored; of contradicting labels of a document the
    majority counts, a tie as 1."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(crc_fold() != 0)
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    n = known.count()
    if n > max_train:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_train / n))
    picked = known.limit(2 * max_train + 1).collect()
    if len(picked) > 2 * max_train:
        raise ValueError(f"more than {2 * max_train} documents in a sample of {max_train}")
    if not picked:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    spark = docs.sparkSession
    few = spark.createDataFrame([(r["doc_id"], r["y"]) for r in picked], "doc_id bigint, y int")

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                x = matrix(b.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("y"), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["doc_id", "y", "x"])
    rows = (docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
            .join(F.broadcast(few), "doc_id").select("doc_id", "text", "y")
            .mapInArrow(run, "doc_id bigint, y int, x binary").limit(4 * max_train + 1).collect())
    if len(rows) > 4 * max_train:
        raise ValueError("a labelled doc_id stands at too many documents to learn from")
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows)).reshape(-1, len(FEATURES))
    return x, np.array([r["y"] for r in rows], dtype=float)


def fit(docs: DataFrame, labels: DataFrame) -> Gam:
    return Gam().fit(*training_rows(docs, labels))


def score(docs: DataFrame, model: Gam, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, score, predicted)``, one row per row
    also for null or repeated ids.  A null text counts as empty; without labels
    every score is 0.5; other columns are ignored."""
    def run(batches):
        for b in batches:
            s = model.score(matrix(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                names=["doc_id", "score", "predicted"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, score double, predicted int")
