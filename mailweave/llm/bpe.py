"""BPE as a deterministic automaton over tokens.

The automaton is compiled from the merge list, one gadget per merge in rank
order.  A state is what may follow the token just read.  The gadget of a merge
(u, v) does two things:

* it adds an arc for the token uv wherever u could be read, leading to the
  state that v led to just then;
* it gives u a new state, equal to its old one but without the arc v, since
  "u then v" would have been merged.

A token sequence is accepted exactly when it is the tokenization of its text,
so a word has one accepted path.  Encoding walks the word once: at each
position it takes the token whose arc leaves the state reached where that
token starts.  Arcs of derived states are resolved through the gadgets when
first needed and kept in a table.  Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from functools import cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices, texts

START = -1
#: stands for the end mark of a word in the goto table
STOP = "\ue000"
#: resolved arcs kept
ARCS = 300_000
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: entries of the chunk cache per generation; two generations are held
CACHE = 250_000
#: separators to Python's split() which the vocabulary's rules treat as symbols
ODD_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 bytes
    stand for themselves, the rest follow from U+0100 on in byte order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b] = chr(0x100 + extra)
            extra += 1
    return out


class MergeAutomaton:
    """Automaton of a merge list over the tokens of ``vocab``.

    ``end`` is appended to the last letter of each word.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.vocab, self.end = vocab, end
        self.labels = [""] * (max(vocab.values(), default=-1) + 1)
        for t, i in vocab.items():
            self.labels[i] = t
        self.width = len(self.labels)
        # gadget k: the token it adds, and the arc v it takes from the state of u
        self.born = {i: -1 for i in vocab.values()}      # gadget that added the token; -1 for letters
        self.head: dict[int, int] = {}                   # token uv -> u: uv can be read where u can
        self.tail: dict[int, int] = {}                   # token uv -> v: uv leads where v led
        self.cut: dict[tuple[int, int], int] = {}        # (u, v) -> gadget that took the arc away
        unread: set[int] = set()                         # tokens without an arc
        made = {u + v: k for k, (u, v) in enumerate(merges)}
        for k, (u, v) in enumerate(merges):
            a, b, ab = vocab[u], vocab[v], vocab[u + v]
            if (a, b) in self.cut or ab in self.head:
                raise ValueError(f"merge {k} repeats an earlier one: {u!r} {v!r}")
            if max(made.get(u, -1), made.get(v, -1)) >= k:
                raise ValueError(f"merge {k} uses a token that no earlier merge makes: {u!r} {v!r}")
            self.head[ab], self.tail[ab], self.born[ab] = a, b, k
            # where "u then v" is no path, as after an earlier merge, there is nothing to put the gadget on
            if a in unread or b in unread or not self._resolve(a, b):
                unread.add(ab)
            else:
                self.cut[(a, b)] = k
        self.arcs: dict[int, bool] = {}
        # goto table over letters that names every token ending at a position, longest first
        self.goto = ahocorasick.Automaton()
        for t, i in vocab.items():
            if i in unread:
                continue
            closing = end and t.endswith(end)
            key = t[:-len(end)] + STOP if closing else t
            self.goto.add_word(key, (i, len(key)))
        self.goto.make_automaton()

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` can be read in the state that reading ``state`` leads to."""
        key = state * self.width + token
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._resolve(state, token)
        return known

    def _resolve(self, a: int, b: int) -> bool:
        """Undo gadgets, latest first: the state of uv is that of v before the
        gadget, the arc uv existed where u's did with the gadget applied."""
        until = 1 << 60  # only cuts before this moment count; gadget k acts at 2k
        while True:
            at = self.cut.get((a, b))
            if at is not None and 2 * at < until:
                return False
            made_a, made_b = self.born[a], self.born[b]
            if made_a < 0 and made_b < 0:
                return True
            if made_a >= made_b:
                until, a = min(until, 2 * made_a), self.tail[a]
            else:
                until, b = min(until, 2 * made_b + 1), self.head[b]

    def encode(self, word: str) -> tuple[int, ...]:
        """Token ids of one word (letters of ``byte_letters``)."""
        if not word:
            return ()
        if self.end:
            word += STOP
        n = len(word)
        inner = n - 2 if self.end else n  # a token that closes the word has to read its last letter
        state, came = [None] * (n + 1), [0] * (n + 1)
        state[0] = START
        arcs, width = self.arcs, self.width
        for j, (token, length) in self.goto.iter(word):
            j += 1
            i = j - length
            before = state[i]
            if before is None or state[j] is not None or inner < j < n:
                continue
            if before is START or (arcs.get(before * width + token) or self.has_arc(before, token)):
                state[j], came[j] = token, i
        if state[n] is None:
            raise ValueError(f"a letter of {word!r} is not in the vocabulary")
        out = []
        while n:
            out.append(state[n])
            n = came[n]
        return tuple(out[::-1])

    def decode(self, ids) -> str:
        """Labels of the arcs, as the library's decode joins them without a decoder."""
        return " ".join(map(self.labels.__getitem__, ids))


class WordTokenizer:
    """Tokenizer of a vocabulary file of the ``word_bpe`` kind: special strings
    cut out first, NFC, lower case letter by letter, pre-split words, automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.auto = MergeAutomaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.auto.labels += [""] * (i + 1 - len(self.auto.labels))
            self.auto.labels[i] = content
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(WORD)
        self.letters = byte_letters()
        self.path, self.library = path, None
        self.cache, self.word_cache = Chunks(self._chunk), Chunks(self._word)

    def _word(self, word: str) -> tuple[int, ...]:
        return self.auto.encode("".join([self.letters[b] for b in word.encode()]))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        if chunk.isalpha():
            return self.word_cache[chunk]
        return tuple(chain.from_iterable(map(self.word_cache.__getitem__, self.words.findall(chunk))))

    def _chunks(self, part: str) -> list[str]:
        """Pieces between white space; no word reaches over one."""
        if not any(c in part for c in ODD_SPACE):
            return part.split()
        return [c.translate(UNGUARD) for c in part.translate(GUARD).split()]

    def encode(self, text: str) -> array:
        """Ids of a text, without special tokens added."""
        parts = self.cut.split(text) if self.cut and "<|" in text else [text]
        ids, cached = array("I"), self.cache.__getitem__
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(self.special[part])
                continue
            if not part.isascii():
                if not part.replace("\n", " ").isprintable() and unassigned().search(part):
                    for word in self._library_words(part):
                        ids.extend(self.auto.encode(word))
                    continue
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            ids.extend(chain.from_iterable(map(cached, self._chunks(part.lower()))))
        return ids

    def _library_words(self, part: str) -> list[str]:
        """The words of a text as the library's own normaliser and splitter cut
        them: what a character is depends on the Unicode tables one has."""
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        clean = self.library.normalizer.normalize_str(part)
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]

    def decode(self, ids) -> str:
        return self.auto.decode(ids)


@cache
def unassigned() -> re.Pattern:
    """Any code point that this Python's Unicode tables do not assign; other
    tables may know it as a letter or a number."""
    spans, first = [], None
    for c in range(sys.maxunicode + 2):
        new = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if new and first is None:
            first = c
        elif not new and first is not None:
            spans.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return re.compile("[" + "".join(spans) + "]")


#: U+001C..1F moved to unassigned places while splitting at white space
GUARD = {c: c + 0x10FF00 for c in range(0x1C, 0x20)}
UNGUARD = {v: k for k, v in GUARD.items()}


class Chunks(dict):
    """Results by chunk in two generations: when the young one is full the old
    one is dropped.  Only speed depends on its size."""

    def __init__(self, make, size: int = CACHE):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, chunk):
        found = self.old.get(chunk)
        if found is None:
            found = self.make(chunk)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[chunk] = found
        return found


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The compiled tokenizer of a file, once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, ids array<int>)``, one row per row;
    null and empty texts have no ids, other columns are ignored."""
    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            for b in slices(batch, "text"):
                ids = [tok.encode(t) for t in texts(b.column("text"))]
                ends = [0]
                for x in ids:
                    ends.append(ends[-1] + len(x))
                flat = array("I")
                for x in ids:
                    flat.extend(x)
                values = pa.array(memoryview(flat).cast("B").cast("i") if len(flat) else [], type=pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                    names=["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, ids array<int>")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text: ``(doc_id, n_tokens, ids_sha256,
    decoded_sha256)``; the hashes are of the ids as little-endian unsigned
    32-bit integers and of the decoded text in UTF-8.  A null text counts as
    empty; one row per row, also for a null or repeated doc_id."""
    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            for b in slices(batch, "text"):
                counts, of_ids, of_text = [], [], []
                for t in texts(b.column("text")):
                    ids = tok.encode(t)
                    raw = array("I", ids)
                    if sys.byteorder == "big":
                        raw.byteswap()
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(raw).hexdigest())
                    of_text.append(hashlib.sha256(tok.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                     pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
