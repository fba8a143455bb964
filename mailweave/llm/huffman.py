"""Token ids in Huffman-coded files.

The code is canonical and length-limited, built from the counts of the ids in
the whole corpus.  A file holds the code lengths, blocks of coded ids with the
bit offset of every ``STEP``-th id, an index of the blocks and the documents.
Blocks decode independently; within a block all stretches between checkpoints
are decoded side by side through one lookup table.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .bpe import byte_letters
from .common import Scratch, slices, texts

MAGIC = b"MWHUFF01"
LIMIT = 16                  # longest code in bits, more (24 at most) only if the ids need it
BLOCK, STEP = 1 << 17, 128  # ids of a block, ids between checkpoints
FILE_IDS = 1 << 26          # ids of a file, on average
#: words, and pieces, remembered before the memory is emptied
CACHE = 600_000


# --- tokens ---------------------------------------------------------------

class OddSpacing(Exception):
    """A text has other white space than single spaces between its pieces."""


class CachedTokenizer:
    """The tokenizers library, called once per distinct word.

    With a byte-level pre-tokenizer a boundary before a single space between
    two visible characters is always made, so the pieces between spaces encode
    independently, and so do the words the pre-tokenizer finds in a piece; the
    library's model gets each word once.  Texts with other spacing are cut at
    such boundaries only; texts with a special token's string, and vocabularies
    with another pre-tokenizer, go to the library whole.
    """

    TAILED = re.compile(r"([^\W\d_]+)([^\w\s]+)")
    # fixed pattern of the byte-level pre-tokenizer
    WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
    SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for one side of the two only

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        split = spec.get("pre_tokenizer") or {}
        self.by_piece = (split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
                         and not spec.get("normalizer"))
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.size = max([*self.tok.get_vocab(True).values(), 0]) + 1
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        packed = array("H" if self.kind.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _library(self, text: str) -> bytes:
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """Ids of one word of the pre-tokenizer."""
        found = self.words.get(word)
        if found is None:
            # visible ASCII stands for itself among the letters of the bytes
            letters = (word.replace(" ", self.letters[32]) if word.isascii() and word.isprintable() else
                       "".join([self.letters[b] for b in word.encode()]))
            found = self.words[word] = self._pack([t.id for t in self.tok.model.tokenize(letters)])
        return found

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece with the space before it."""
        m = self.TAILED.fullmatch(piece)
        if m and m[1].isalpha():
            return self._word(" " + m[1]) + self._word(m[2])
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise OddSpacing
        if self.SEPARATORS.search(piece):
            return self._library(" " + piece)
        return b"".join(map(self._word, self.WORDS.findall(" " + piece)))

    def _cut(self, text: str) -> bytes:
        """A text with other spacing, cut where the pre-tokenizer cuts for certain."""
        return b"".join(map(self._library, re.split(r"(?<=\S)(?= \S)", text)))

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text, packed as ``kind``."""
        plain = [k for k, t in enumerate(batch) if self.by_piece and t and not any(s in t for s in self.special)]
        out = dict(zip(plain, self._plain([batch[k] for k in plain]))) if plain else {}
        return [out[k] if k in out else self._library(t) for k, t in enumerate(batch)]

    def _plain(self, batch: list[str]) -> list[bytes]:
        """Every distinct piece of the batch is looked up once; the texts are
        then put together by the codes of their pieces."""
        cut = pc.split_pattern(pa.array(batch, pa.string()), " ")
        coded, edge = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
        codes, odd = coded.indices.to_numpy(), []
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        for memory in (self.words, self.pieces):
            if len(memory) > CACHE:
                memory.clear()
        ids = list(map(self.pieces.get, distinct))
        for k in [k for k, x in enumerate(ids) if x is None]:
            piece = distinct[k]
            try:
                ids[k] = self.pieces[piece] = self._word(" " + piece) if piece.isalpha() else self._piece(piece)
            except OddSpacing:
                ids[k] = b""
                odd.append(k)
        owner = np.searchsorted(edge, np.flatnonzero(np.isin(codes, odd)), side="right") - 1 if odd else ()
        # the first piece of a text has no space before it
        heads = cut.flatten().take(pa.array(edge[:-1])).to_pylist()
        again = set(owner) | {k for k, h in enumerate(heads) if not h or h[-1].isspace()}
        found = ids.__getitem__
        return [self._cut(t) if k in again else self._library(heads[k]) + b"".join(map(found, codes[a + 1:b].tolist()))
                for k, (t, a, b) in enumerate(zip(batch, edge[:-1].tolist(), edge[1:].tolist()))]


_LOADED: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    if path not in _LOADED:
        _LOADED[path] = CachedTokenizer(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``(doc_id, ids)`` with the packed ids of every text and ``end_id`` after them."""
    def run(batches):
        tok = tokenizer(path)
        end = np.array([end_id], dtype=tok.kind).tobytes()
        for batch in batches:
            for b in slices(batch, "text"):
                ids = [x + end for x in tok.encode(texts(b.column("text")))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, ids binary")


def count_ids(tokens: DataFrame, size: int, kind: np.dtype) -> np.ndarray:
    """How often each id occurs in ``tokens(ids)``; at most ``size`` rows reach the driver."""
    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            for x in b.column("ids").to_pylist():
                total += np.bincount(np.frombuffer(x, kind), minlength=size) if len(x) > size else 0
            small = b"".join(x for x in b.column("ids").to_pylist() if len(x) <= size)
            total += np.bincount(np.frombuffer(small, kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])
    out = np.zeros(size, dtype=np.int64)
    for r in tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


# --- code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.int64)
    levels, package = [], np.zeros(0, dtype=np.int64)
    for _ in range(limit):
        both = np.concatenate([weight, package])
        order = np.argsort(both, kind="stable")
        levels.append(order < n)  # which of the sorted items are single ids
        both = both[order]
        package = both[:len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, length = 2 * n - 2, np.zeros(n, dtype=np.int64)
    for leaf in reversed(levels):
        singles = int(leaf[:take].sum())
        length[:singles] += 1
        take = 2 * (take - singles)
    out[used] = length
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    code = last = 0
    for i in used[np.argsort(lengths[used], kind="stable")].tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of the ids, first bit highest, and the bit offset of every STEP-th id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    words = np.zeros(int(ends[-1] >> 5) + 2, dtype=np.uint32)
    value = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
    word = at >> 5
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    merged = np.bitwise_or.reduceat(value, first)
    words[word[first]] |= (merged >> np.uint64(32)).astype(np.uint32)
    words[word[first] + 1] |= (merged & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return words.astype(">u4").tobytes()[:int(ends[-1] + 7) >> 3], at[::STEP]


class Table:
    """Lookup of the next id and its code length by the next ``bits`` bits; an
    entry holds both, so that the whole table stays in a processor's cache."""

    def __init__(self, lengths: np.ndarray):
        self.bits = int(lengths.max()) if len(lengths) else 0
        if self.bits > 24:
            raise ValueError("codes of more than 24 bits")
        used = np.flatnonzero(lengths)
        used = used[np.argsort(lengths[used], kind="stable")]
        span = np.left_shift(1, self.bits - lengths[used].astype(np.int64))
        entry = np.repeat((used << 5 | lengths[used]).astype(np.uint32), span)
        # a code of one id leaves half of the table open
        self.entry = np.pad(entry, (0, (1 << self.bits) - len(entry)), constant_values=1)

    def unpack(self, data: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        raw = np.frombuffer(data + bytes(STEP * self.bits // 8 + 16), dtype=np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]  # 32 bits from each byte on
        at, mask, room = checkpoints.astype(np.uint32), np.uint32((1 << self.bits) - 1), np.uint32(32 - self.bits)
        out = np.empty((STEP, len(at)), dtype=np.uint32)
        for k in range(STEP):
            entry = self.entry[(window[at >> 3] >> (room - (at & 7))) & mask]
            np.right_shift(entry, 5, out=out[k])
            at += entry & 31
        return out.T.ravel()[:n] if len(checkpoints) else np.zeros(0, dtype=np.uint32)


# --- files ----------------------------------------------------------------

class Writer:
    """One file: header, blocks, then the index and its place."""

    def __init__(self, path: str, lengths: np.ndarray, codes: np.ndarray):
        self.path, self.out, self.lengths, self.codes = path, files.create(path), lengths, codes
        self.at, self.blocks, self.docs, self.held, self.count, self.total = 0, [], [], [], 0, 0
        self._write(MAGIC + struct.pack("<II", len(lengths), STEP) + lengths.tobytes())

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.count += len(ids)
        self.total += len(ids)
        if self.count >= BLOCK:
            flat = np.concatenate(self.held)
            while len(flat) >= BLOCK:
                self._block(flat[:BLOCK])
                flat = flat[BLOCK:]
            self.held, self.count = [flat], len(flat)

    def _block(self, ids: np.ndarray) -> None:
        data, checkpoints = pack(ids, self.codes, self.lengths)
        self.blocks.append((self.at, len(ids)))
        self._write(struct.pack("<III", len(ids), len(checkpoints), len(data)) + checkpoints.astype("<u4").tobytes() + data
                    + struct.pack("<I", zlib.crc32(ids.astype("<u4").tobytes())))

    def close(self) -> None:
        if self.count:
            self._block(np.concatenate(self.held))
        index = self.at
        ids = np.array([d if d is not None else 0 for d, _ in self.docs], dtype="<i8")
        known = np.array([d is not None for d, _ in self.docs], dtype=np.uint8)
        self._write(struct.pack("<QQ", len(self.blocks), len(self.docs))
                    + np.array(self.blocks, dtype="<u8").reshape(-1, 2).tobytes() + ids.tobytes() + known.tobytes()
                    + np.array([n for _, n in self.docs], dtype="<u8").tobytes())
        self._write(struct.pack("<Q", index) + MAGIC)
        self.out.close()


class Reader:
    def __init__(self, path: str):
        self.file = files.open_file(path)
        size = self.file.size()
        magic, symbols, self.step = struct.unpack("<8sII", self._read(0, 16))
        index, end = struct.unpack("<Q8s", self._read(size - 16, 16))
        if magic != MAGIC or end != MAGIC or self.step != STEP:
            raise ValueError(f"{path} is not a complete file of this format")
        self.table = Table(np.frombuffer(self._read(16, symbols), dtype=np.uint8))
        blocks, docs = struct.unpack("<QQ", self._read(index, 16))
        self.blocks = np.frombuffer(self._read(index + 16, 16 * blocks), dtype="<u8").reshape(-1, 2)
        at = index + 16 + 16 * blocks
        ids, known = np.frombuffer(self._read(at, 8 * docs), "<i8"), np.frombuffer(self._read(at + 8 * docs, docs), np.uint8)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.n_tokens = np.frombuffer(self._read(at + 9 * docs, 8 * docs), "<u8").astype(np.int64)

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at) if n else b""

    def block(self, k: int) -> np.ndarray:
        """The ids of block ``k``, whatever was read before."""
        at, n = (int(x) for x in self.blocks[k])
        count, points, size = struct.unpack("<III", self._read(at, 12))
        body = self._read(at + 12, 4 * points + size + 4)
        ids = self.table.unpack(body[4 * points:4 * points + size], np.frombuffer(body[:4 * points], "<u4"), count)
        if count != n or zlib.crc32(ids.astype("<u4", copy=False).tobytes()) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError("the check sum of a block does not fit")
        return ids

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """``(doc_id, n_tokens, crc32 of the ids as little-endian 32-bit)`` in file order, one block held at a time."""
        k, left = 0, np.zeros(0, dtype="<u4")
        for doc_id, n in zip(self.doc_ids, self.n_tokens.tolist()):
            crc, rest = 0, n
            while rest:
                if not len(left):
                    left = self.block(k).astype("<u4", copy=False)
                    k += 1
                crc = zlib.crc32(left[:rest], crc)
                used = min(rest, len(left))
                left, rest = left[used:], rest - used
            yield doc_id, n, crc


def write_files(tokens: DataFrame, counts: np.ndarray, kind: np.dtype, folder: str) -> DataFrame:
    """``tokens(doc_id, ids)`` in ascending doc_id order into files; returns
    ``(part, path, tokens)`` of each; files of a higher part follow."""
    limit = max(LIMIT, int(np.ceil(np.log2(max(2, np.count_nonzero(counts))))) + 2)
    lengths = code_lengths(counts, limit)
    codes = canonical(lengths)

    def run(batches):
        from pyspark import TaskContext
        part, out = TaskContext.get().partitionId(), None
        for b in batches:
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                out = out or Writer(files.new_path(folder, ".huff"), lengths, codes)
                out.add(doc_id, np.frombuffer(ids, kind))
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([out.path]), pa.array([out.total])],
                                             names=["part", "path", "tokens"])
    session = tokens.sparkSession
    n = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // FILE_IDS))
    return (tokens.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "ids")
            .mapInArrow(run, "part bigint, path string, tokens bigint"))


def read_files(manifest: DataFrame) -> DataFrame:
    """``manifest(path, start)`` -> ``(doc_id, start, n_tokens, ids_crc32)`` from the files."""
    def run(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                rows = []
                for doc_id, n, crc in Reader(path).documents():
                    rows.append((doc_id, start, n, crc))
                    start += n
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return manifest.select("path", "start").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, scratch: Scratch, path: str, end_id: int) -> DataFrame:
    """Encode ``docs(doc_id, text)``, write the ids to files in ascending
    doc_id order, read the files back.

    One row per row.  A null or empty text has ``end_id`` alone; a null doc_id
    comes first; rows with the same doc_id follow each other in the order of
    their ids; other columns are ignored; an empty table writes no file.
    """
    tok = tokenizer(path)
    tokens = scratch.table(encode_documents(docs, path, end_id), "tokens", compression="zstd")
    counts = count_ids(tokens, max(tok.size, end_id + 1), tok.kind)
    # one row per file
    rows = sorted(tuple(r) for r in write_files(tokens, counts, tok.kind, scratch.path("files")).collect())
    scratch.drop("tokens")
    starts = np.concatenate([[0], np.cumsum([n for _, _, n in rows], dtype=np.int64)]).tolist()
    manifest = docs.sparkSession.createDataFrame([(p, s) for (_, p, _), s in zip(rows, starts)], "path string, start bigint")
    return read_files(manifest.repartition(max(1, len(rows))))
