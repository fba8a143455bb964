"""Spelling variants: words one edit apart, found by pivotal bigrams.

Bigrams are ranked by how rare they are among the words.  A word's prefix is
its three rarest bigrams (with every further occurrence of the third one's
rank); one edit touches at most two bigrams, so words one edit apart share a
prefix bigram.  Two bigrams of the prefix that do not overlap are its pivots,
chosen by dynamic programming for the least total frequency; one edit leaves
one of them whole.  Hence of two near words the one whose prefix ends at the
rarer rank has a pivot in the prefix of the other, and only such pairs meet.
They meet on (bigram, position, length, a hash of what is left or of what is
right of the bigram): the edit lies on one side of the pivot and leaves the
other as it is, and it moves the bigram by at most one place, and only together
with the length.  So a pivot asks six such keys, and a bigram that many words
share makes no large group.  The pairs that meet are verified inside the join
by their edit distance; a failing pair is never written anywhere.

Words are letters ``a-z`` and U+00C0 to U+00FF, so there are at most 90 x 90
bigrams: the only table that goes through the driver.

Nulls and odd rows: a null text has no word; a null id counts as empty text in
the hash; repeated rows count again; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, utf8

RUN = re.compile("[a-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT, RATIO, EVERY = 6, 5, 5, 199
LETTERS = 26 + 64
#: what one edit can do to a bigram it leaves whole: moved by, length by, and the side that stays as it is
LEFT, RIGHT = 0, 1
MOVES = [(0, 0, LEFT), (0, 0, RIGHT), (0, 1, LEFT), (0, -1, LEFT), (1, 1, RIGHT), (-1, -1, RIGHT)]
#: base of the polynomial hash of a word's sides (modulo 2^64; equal hashes are verified)
BASE = 0x9E3779B97F4A7C15
PREFIX = 3
#: counts a task holds before it hands them on; texts above LONG characters are not listed run by run
HELD, LONG = 200_000, 1 << 23


def runs(raw: bytes) -> Counter:
    """The letter runs of a UTF-8 text, A-Z lower-cased, with their numbers."""
    text = raw.lower().decode("utf-8")               # bytes.lower touches ASCII letters only
    return Counter(RUN.findall(text) if len(text) < LONG else (m[0] for m in RUN.finditer(text)))


def spelled(run: str, prefix: int) -> str:
    """A run as it counts in a document whose ``<doc_id>:`` has the crc32 ``prefix``."""
    h = crc32(run.encode(), prefix)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(word, n)``: words of at least ``MIN_LENGTH``
    code points that occur at least ``MIN_COUNT`` times."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            for b in slices(batch, "text"):
                for ident, raw in zip(b.column("doc_id").to_pylist(), utf8(b.column("text"))):
                    prefix = crc32(("" if ident is None else str(ident)).encode() + b":")
                    for run, n in runs(raw).items():
                        if len(run) >= MIN_LENGTH:
                            word = spelled(run, prefix)
                            if len(word) >= MIN_LENGTH:
                                held[word] += n
                    if len(held) >= HELD:
                        yield out()
                        held = Counter()
        yield out()
    counted = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def grams(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """All bigrams of a batch of words: (row, position, bigram number, hash of
    the letters before it, hash of those after it)."""
    spelt = batch.column("word").to_pylist()
    points = np.frombuffer("".join(spelt).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    letter = np.where(points < 128, points - ord("a"), points - 0xC0 + 26)
    size = np.fromiter(map(len, spelt), np.int64, len(spelt))
    end = np.cumsum(size)
    row = np.repeat(np.arange(len(spelt)), size)
    first = np.flatnonzero(row[:-1] == row[1:])
    row = row[first]
    start = (end - size)[row]
    # sums of (letter + 1) * BASE^place over the whole batch; a difference, moved to place 0, is a side's hash
    power, back = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(points), b, np.uint64)]))
                   for b in (BASE, pow(BASE, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((letter + 1).astype(np.uint64) * power[:-1])])
    left = (sums[first] - sums[start]) * back[start]
    right = (sums[end[row]] - sums[first + 2]) * back[first + 2]
    return row, first - start, letter[first] * LETTERS + letter[first + 1], left.view(np.int64), right.view(np.int64)


def frequencies(vocabulary: DataFrame) -> np.ndarray:
    """How often each bigram occurs in the words, as one array of 90 x 90 counts."""
    def count(batches):
        total = np.zeros(LETTERS * LETTERS, dtype=np.int64)
        for b in batches:
            for part in slices(b, "word", 1 << 20):
                total += np.bincount(grams(part)[2], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], names=["gram", "n"])
    rows = vocabulary.select("word").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(LETTERS * LETTERS, dtype=np.int64)
    for r in rows:
        total[r.gram] = r.n
    return total


def pivots(prefix: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of ``(position, gram, frequency)`` by position, the two that do not
    overlap and have the least total frequency.

    ``one[i]`` is the best single gram that ends before gram ``i`` begins,
    and the best pair is the least of ``one[i]`` with gram ``i``.
    """
    best = None                                      # the best gram that the current one cannot overlap
    waiting: list[tuple[int, int, int]] = []         # grams that it may overlap still
    pair = None
    for g in prefix:
        while waiting and waiting[0][0] <= g[0] - 2:
            w = waiting.pop(0)
            if best is None or w[2] < best[2]:
                best = w
        if best is not None and (pair is None or best[2] + g[2] < pair[0][2] + pair[1][2]):
            pair = (best, g)
        waiting.append(g)
    return list(pair)


_GRAMS = "array<struct<gram:int,pos:int,left:bigint,right:bigint>>"
SIGNATURE = f"word string, n bigint, len int, last int, prefix {_GRAMS}, pivots {_GRAMS}"


def signatures(vocabulary: DataFrame, frequency: np.ndarray) -> DataFrame:
    """Per word its length, the rank at which its prefix ends, the prefix and the pivots."""
    rank = np.empty(len(frequency), dtype=np.int64)
    rank[np.lexsort((np.arange(len(frequency)), frequency))] = np.arange(len(frequency))

    def lists(rows, gram, pos, left, right, count):
        """The bigrams as one list per word."""
        offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=count))])
        grams_ = pa.StructArray.from_arrays([pa.array(gram, pa.int32()), pa.array(pos, pa.int32()), pa.array(left), pa.array(right)],
                                            names=["gram", "pos", "left", "right"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), grams_)

    def sign(batches):
        for batch in batches:
            for b in slices(batch, "word", 1 << 20):
                row, pos, gram, left, right = grams(b)
                r = rank[gram]
                order = np.lexsort((r, row))
                last = r[order[np.searchsorted(row, np.arange(b.num_rows)) + PREFIX - 1]]
                inside = np.flatnonzero(r <= last[row])
                held: list[list] = [[] for _ in range(b.num_rows)]
                for i, p, at, f in zip(row[inside].tolist(), pos[inside].tolist(), inside.tolist(), frequency[gram[inside]].tolist()):
                    held[i].append((p, at, f))
                chosen = np.array([at for h in held for _, at, _ in pivots(h)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("word"), b.column("n"), pa.array(np.bincount(row, minlength=b.num_rows) + 1, pa.int32()), pa.array(last, pa.int32()),
                     *(lists(row[k], r[k], pos[k], left[k], right[k], b.num_rows) for k in (inside, chosen))],
                    names=["word", "n", "len", "last", "prefix", "pivots"])
    return vocabulary.mapInArrow(sign, SIGNATURE)


def near_words(signed: DataFrame) -> DataFrame:
    """``(a, na, b, nb)``: every two words that one inserted, deleted or
    replaced code point makes equal, once, ``a`` before ``b``."""
    def key(moved: int, longer: int, side: int):
        return F.xxhash64("gram", F.col("pos") + F.lit(moved), F.col("len") + F.lit(longer), F.lit(side), "left" if side == LEFT else "right")
    index = (signed.select(F.col("word").alias("r"), F.col("n").alias("rn"), F.col("last").alias("rlast"), "len", F.inline("prefix"))
             .select("r", "rn", "rlast", F.explode(F.array(key(0, 0, LEFT), key(0, 0, RIGHT))).alias("key")))
    probe = (signed.select(F.col("word").alias("p"), F.col("n").alias("pn"), F.col("last").alias("plast"), "len", F.inline("pivots"))
             .select("p", "pn", "plast", F.explode(F.array(*[key(*m) for m in MOVES])).alias("key")))
    met = (probe.join(index, "key").where((F.col("plast") <= F.col("rlast")) & (F.col("p") != F.col("r")))
           .where(F.levenshtein("p", "r", 1) == 1))
    first = F.col("p") < F.col("r")
    return met.select(F.when(first, F.col("p")).otherwise(F.col("r")).alias("a"), F.when(first, F.col("pn")).otherwise(F.col("rn")).alias("na"),
                      F.when(first, F.col("r")).otherwise(F.col("p")).alias("b"), F.when(first, F.col("rn")).otherwise(F.col("pn")).alias("nb")
                      ).distinct()


def chain_length(top: int) -> int:
    """The most forms in a row: each occurs ``RATIO`` times as often as the
    word before, from ``MIN_COUNT`` to ``top``."""
    length, n = 0, MIN_COUNT * RATIO
    while n <= top:
        length, n = length + 1, n * RATIO
    return length


def variants(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per word: ``(word, form, root, n,
    n_near, form_n)``.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code
    point order) if that is at least ``RATIO`` times the word's, else null;
    ``root`` follows the forms to the last.  Roots are found by doubling: every
    round joins each word's target with that word's target.
    """
    vocabulary = scratch.table(words(docs), "words")
    signed = signatures(vocabulary, frequencies(vocabulary))
    pairs = near_words(scratch.table(signed, "signatures"))
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("less"), F.col("other"))).alias("top"))
    near = scratch.table(best.select("word", "n_near", F.col("top.other").alias("other"), (-F.col("top.less")).alias("m")), "near")
    scratch.drop("signatures")
    joined = vocabulary.join(near, "word", "left")
    fits = F.col("m") >= RATIO * F.col("n")
    formed = scratch.table(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                         F.when(fits, F.col("other")).alias("form"), F.when(fits, F.col("m")).alias("form_n")), "forms")
    scratch.drop("words", "near")
    up = formed.where("form is not null").select("word", F.col("form").alias("root"))
    reach, longest, k = 1, chain_length(formed.agg(F.max("n")).first()[0] or 0), 0
    while reach < longest:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = scratch.table(up.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"roots-{k}")
        if k:
            scratch.drop(f"roots-{k - 1}")
        reach, k = 2 * reach, k + 1
    return formed.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
