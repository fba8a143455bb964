"""Language identification by a small byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over
a window of fixed length and classified by a softmax.  The network is trained
in numpy on windows of labelled texts and applied to every window of every
text; a text's probabilities are the mean over its windows, weighted by their
bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_fold, slices, texts, utf8

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8           # of each width
EMBEDDING = 6
#: bounds of the training sample: documents of a language, of all languages together (but LEAST_DOCS
#: of each in any case), windows of a document.  Every language is learned.
MAX_DOCS, ALL_DOCS, LEAST_DOCS, MAX_WINDOWS = 800, 6400, 20, 5
EPOCHS, BATCH, RATE = 8, 128, 0.01
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: windows scored at once: small enough for a processor's cache
BLOCK = 32


@dataclass
class ByteConvNet:
    langs: list[str]
    seed: int = 7
    params: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        rng, n = np.random.default_rng(self.seed), len(WIDTHS) * FILTERS
        widest = max(WIDTHS)
        # one filter bank as wide as the widest filter; narrower ones are zero beyond their width
        self.mask = np.zeros((widest, EMBEDDING, n), dtype=np.float32)
        for k, w in enumerate(WIDTHS):
            self.mask[:w, :, k * FILTERS:(k + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(widest * EMBEDDING, n)
        if not self.params:
            self.params = {
                "emb": rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
                "conv": rng.normal(0, 0.3, self.mask.shape).astype(np.float32) * self.mask,
                "bias": np.zeros(n, dtype=np.float32),
                "out": rng.normal(0, 0.1, (n, len(self.langs))).astype(np.float32),
                "shift": np.zeros(len(self.langs), dtype=np.float32)}

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        """Embedded bytes of every filter position: (windows x positions, widest x embedding)."""
        widest = max(WIDTHS)
        x = self.params["emb"][windows]
        n, length, _ = x.shape
        s = x.strides
        view = np.lib.stride_tricks.as_strided(
            x, (n, length - widest + 1, widest * EMBEDDING), (s[0], s[1], s[2]), writeable=False)
        return view.reshape(-1, widest * EMBEDDING)

    def _pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self._patches(windows)
        return p, (p @ self.params["conv"]).reshape(len(windows), -1, self.mask.shape[1])

    def _softmax(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.params["out"] + self.params["shift"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = [self._softmax(np.maximum(self._pooled(windows[at:at + BLOCK])[1].max(axis=1) + self.params["bias"], 0))
               for at in range(0, len(windows), BLOCK)]
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)), dtype=np.float32)

    def gradients(self, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, conv = self._pooled(windows)
        n, positions, f = conv.shape
        best = conv.argmax(axis=1)
        act = np.take_along_axis(conv, best[:, None, :], axis=1)[:, 0, :] + self.params["bias"]
        hidden = np.maximum(act, 0)
        err = self._softmax(hidden)
        err[np.arange(n), target] -= 1
        err *= weight[:, None] / weight.sum()
        back = (err @ self.params["out"].T) * (act > 0)
        rows = (np.arange(n)[:, None] * positions + best)                       # (n, f) patch of each maximum
        chosen = p[rows.ravel()].reshape(n, f, -1)
        d_conv = np.einsum("nf,nfk->kf", back, chosen) * self.mask
        widest = max(WIDTHS)
        d_patch = (back[:, :, None] * self.params["conv"].T[None]).reshape(n * f, widest, EMBEDDING)
        at = (best.ravel()[:, None] + np.arange(widest))
        byte = windows[np.repeat(np.arange(n), f)[:, None], at]
        d_emb = np.zeros_like(self.params["emb"])
        np.add.at(d_emb, byte.ravel(), d_patch.reshape(-1, EMBEDDING))
        return {"emb": d_emb, "conv": d_conv, "bias": back.sum(axis=0), "out": hidden.T @ err, "shift": err.sum(axis=0)}

    def train(self, windows: np.ndarray, target: np.ndarray) -> "ByteConvNet":
        """Adam over shuffled batches; rare languages weigh as much as common ones."""
        rng = np.random.default_rng(self.seed)
        count = np.bincount(target, minlength=len(self.langs))
        weight = (len(target) / (len(self.langs) * np.maximum(count, 1)))[target].astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v = {k: np.zeros_like(x) for k, x in self.params.items()}
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                pick = order[at:at + BATCH]
                step += 1
                rate = RATE * (1 - epoch / EPOCHS)
                for k, g in self.gradients(windows[pick], target[pick], weight[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.params[k] = (self.params[k] - rate * (m[k] / (1 - 0.9 ** step))
                                      / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self


def windows_of(raw: bytes) -> np.ndarray:
    """All windows of a text, the last one filled up with zero bytes."""
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


def predict(model: ByteConvNet, batch: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and probability of each text, windows of all texts together."""
    parts = [windows_of(t) for t in batch]
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    total = counts.sum()
    if not len(model.langs) or not total:
        return [UNKNOWN] * len(batch), [0.0] * len(batch)
    owner = np.repeat(np.arange(len(batch)), counts)
    probs = model.probabilities(np.concatenate(parts)).astype(np.float64)
    last = np.cumsum(counts) - 1
    used = np.full(total, float(WINDOW))
    filled = counts > 0
    used[last[filled]] = [len(t) - (n - 1) * WINDOW for t, n in zip(batch, counts) if n]
    mean = np.stack([np.bincount(owner, probs[:, k] * used, len(batch)) for k in range(len(model.langs))], axis=1)
    mean /= np.maximum(np.bincount(owner, used, len(batch)), 1.0)[:, None]
    best = mean.argmax(axis=1)
    return [model.langs[k] for k in best], [min(1.0, float(x)) for x in mean[np.arange(len(batch)), best]]


def _training_windows(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """At most MAX_WINDOWS windows of at most about MAX_DOCS documents of each
    language (fewer where there are many languages), picked by a hash of the
    doc_id."""
    fit = docs.select("doc_id", "text", "lang").where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND text <> '' AND lang IS NOT NULL").where(crc_fold() != 0)
    counts = {r["lang"]: r["count"] for r in fit.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, int)
    wanted = min(MAX_DOCS, max(LEAST_DOCS, ALL_DOCS // len(langs)))
    share = F.element_at(F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, wanted / counts[lang]))]), F.col("lang"))
    picked = fit.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))

    def run(batches):
        for b in batches:
            out = []
            for t, lang in zip(utf8(b.column("text")), b.column("lang").to_pylist()):
                w = windows_of(t)
                at = np.unique(np.linspace(0, len(w) - 1, MAX_WINDOWS).astype(int))
                out += [(w[i].tobytes(), lang) for i in at]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()),
                                              pa.array([x for _, x in out], pa.string())], names=["window", "lang"])
    bound = 2 * len(langs) * (wanted + 100) * MAX_WINDOWS
    rows = (picked.select(F.col("text").cast("string"), "lang").mapInArrow(run, "window binary, lang string")
            .limit(bound + 1).collect())
    if len(rows) > bound:
        raise ValueError(f"more than {bound} training windows: one doc_id seems to repeat without end")
    rows.sort()  # the order of rows must not depend on the order of tasks
    place = {lang: k for k, lang in enumerate(langs)}
    windows = np.frombuffer(b"".join(bytes(r["window"]) for r in rows), np.uint8).reshape(-1, WINDOW)
    return langs, windows, np.array([place[r["lang"]] for r in rows], dtype=int)


def fit(docs: DataFrame) -> ByteConvNet:
    """A network for ``docs(doc_id, text, lang)``, from documents outside the held-out fold."""
    langs, windows, target = _training_windows(docs)
    model = ByteConvNet(langs)
    return model.train(windows, target) if len(windows) else model


def identify(docs: DataFrame, model: ByteConvNet, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two more columns, called ``names``: the language of the
    whole text and its probability; ``und`` and 0 where the text is null or has
    no letter (or nothing was learned).  One row per row; columns that already
    have these names are replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in names}])

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                column = b.column(b.schema.get_field_index("text"))
                langs, scores = predict(model, utf8(column))
                for k, t in enumerate(texts(column)):
                    if not LETTER.search(t):
                        langs[k], scores[k] = UNKNOWN, 0.0
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*b.schema.names, *names])
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(run, schema)
