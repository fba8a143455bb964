"""Spelling variants, ranked search and chat formatting against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mailweave.llm import chat, ranked, variants
from mailweave.llm.queries import MARKED, REGISTRY

from .conftest import SF

LOWER = {c: c + 32 for c in range(65, 91)}


# ---------------------------------------------------------------------------
# spelling variants
# ---------------------------------------------------------------------------
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_variants(rows):
    count = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    near = defaultdict(list)
    for a in words:
        for b in words:
            if a < b and abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=repr)


def found_variants(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_variants_equal_brute_force(spark, documents, scratch):
    got = found_variants(variants.variants(documents, scratch()))
    want = brute_variants([tuple(r) for r in documents.select("doc_id", "text").collect()])
    assert got == want and any(n for *_, n, _ in want)


def edited(rng, word, letters):
    kind, at = rng.randrange(3), rng.randrange(len(word))
    if kind == 0:
        return word[:at] + word[at + 1:]
    put = rng.choice(letters)
    return word[:at] + put + word[at + (kind == 1):]


def test_variants_of_random_words_chains_and_long_runs(spark, scratch):
    """Small alphabets make repeated bigrams and ties; chains of forms are
    followed to the end; one word has 3,000 letters."""
    rng, rows, ident = random.Random(5), [], 0
    bag = Counter()
    for letters in ("ab", "abcé", "aÿ"):
        for _ in range(40):
            w = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 10)))
            for _ in range(4):
                bag[w] += rng.choice([1, 5, 6, 30, 151])
                w = edited(rng, w, letters)
    for k, n in enumerate((5, 25, 125, 625, 3125)):            # a chain of five, each the form of the one before
        bag["chain" + "z" * (k + 3)] += n
    bag["x" * 3000] += 6
    bag["x" * 2999 + "y"] += 40
    for w, n in bag.items():
        while n:
            take = min(n, rng.randrange(1, 80))
            rows.append((ident, " ".join([w] * take).upper() if ident % 3 == 0 and w.isascii() else " ".join([w] * take)))
            ident, n = ident + 1, n - take
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = found_variants(variants.variants(df, scratch()))
    assert got == brute_variants(rows)
    assert any(r[2] not in (r[0], r[1]) for r in got)


def test_pivots_are_the_best_disjoint_pair():
    rng = random.Random(3)
    for _ in range(500):
        n = rng.randrange(3, 12)
        prefix = [(p, rng.randrange(9), rng.randrange(1, 9)) for p in sorted(rng.sample(range(20), n))]
        best = min(a[2] + b[2] for a in prefix for b in prefix if b[0] - a[0] >= 2)
        (p, _, f), (q, _, g) = variants.pivots(prefix)
        assert q - p >= 2 and f + g == best


def test_variants_odd_rows(spark, odd_documents, scratch):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert found_variants(variants.variants(odd_documents, scratch())) == brute_variants(rows)
    assert found_variants(variants.variants(odd_documents.limit(0), scratch())) == []


# ---------------------------------------------------------------------------
# ranked search
# ---------------------------------------------------------------------------
def plain_terms(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_search(docs, items, top=10):
    bags = [(ident, Counter(plain_terms(t)), len(plain_terms(t))) for ident, t in docs if plain_terms(t)]
    n, total = len(bags), sum(s for *_, s in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        asked, scored = Counter(plain_terms(text)), []
        for ident, bag, size in bags:
            m = 25 + (75 * size * n) // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t, q in asked.items() if t in bag)
            if s > 0:
                scored.append((-s, ident is None, ident))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k, ident, -s) for k, (s, _, ident) in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("block", [ranked.BLOCK_TERMS, 60])
def test_search_equals_brute_force(spark, documents, scratch, block):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = found(ranked.search(documents, items, scratch(), block_terms=block))
    want = brute_search([tuple(r) for r in documents.select("doc_id", "text").collect()],
                        [tuple(r) for r in items.select("item_id", "text").collect()])
    assert got == want and len(got) > 100


def test_search_ties_copies_and_repeated_rows(spark, scratch, monkeypatch):
    """A third of all rows are one bag in several spellings; ids repeat, one is null; items repeat."""
    rng, words = random.Random(1), ["alpha", "beta", "gamma", "delta", "été", "x9"]
    rows = [(k, rng.choice(["Alpha beta", "beta, ALPHA!", "beta-alpha"])) for k in range(200, 0, -1)]
    rows += [(rng.randrange(50), " ".join(rng.choice(words + ["zz"]) for _ in range(rng.randrange(0, 9)))) for _ in range(400)]
    rows += [(None, "alpha beta"), (None, "Été x9 x9"), (7, None), (1, "alpha beta"), (1, "alpha beta")]
    items = [(1, "alpha alpha BETA"), (1, "alpha alpha BETA"), (2, None), (3, ""), (4, "nowhere"), (None, "été x9 zz"), (5, "gamma " * 50)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(5).withColumn("h", F.lit("clash")).withColumn("n", F.lit(1))
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("term", F.lit("clash"))
    monkeypatch.setattr(ranked, "CELLS", 40)
    want = brute_search(rows, items)
    assert found(ranked.search(docs, asked, scratch())) == want
    assert max(Counter((r[0], r[3]) for r in want).values()) > 5          # ties there are
    assert found(ranked.search(docs.limit(0), asked, scratch())) == found(ranked.search(docs, asked.limit(0), scratch())) == []


def test_classes_are_scored_once_and_bounded(spark, scratch):
    """Copies of a text become one class of at most ``TOP`` members."""
    docs = spark.createDataFrame([(k, "a b b") for k in range(1000)] + [(k, "b a b c") for k in range(1000, 1005)], "doc_id bigint, text string")
    held = ranked.bags(docs, {b"a": 0, b"b": 1})
    n, total = ranked.lengths(docs)
    got = sorted(map(tuple, ranked.classes(held, n, total, 10).collect()))
    assert (n, total) == (1005, 3020)
    assert [r[3] for r in got] == [list(range(10)), list(range(1000, 1005))]
    plan = ranked.classes(held, n, total, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2                 # rows of a class are cut before the exchange too


def test_scores_beyond_double_precision(spark):
    import numpy as np
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array([100, 100]), pa.array([[0, 1], [0]], pa.list_(pa.int32())), pa.array([[3, 1], [4]], pa.list_(pa.int32())),
         pa.array([[5], [6]], pa.list_(pa.int64()))], names=["m", "terms", "tfs", "members"])
    big = 10 ** 12 + 1
    r = ranked.Ranking(np.array([[0, 0, big], [0, 1, 1]]), 2, 1, False, 10)
    r.add(batch)
    impact = lambda tf: 10 ** 9 * tf // (1000 * tf + 800)
    want = sorted([(-(big * impact(3) + impact(1)), False, 5), (-(big * impact(4)), False, 6)])
    assert r.best[0] == want


def test_search_odd_rows(spark, odd_documents, scratch):
    items = [(k, t) for k, t in enumerate(["a word", "x" * 100_000, "é中 İΣ"])]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert found(ranked.search(odd_documents, asked, scratch())) == brute_search(rows, items)


# ---------------------------------------------------------------------------
# chat formatting
# ---------------------------------------------------------------------------
def brute_chat(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        before, valid = None, True
        for *_, r, _ in turns:
            valid &= (before, r) in {(None, "system"), (None, "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
            before = r
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), valid))
    return sorted(out, key=repr)


CHAT_COLS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "valid"]
TURNS = "conv_id bigint, turn bigint, role string, text string"


def formatted(df, scratch, **kw):
    pieces = chat.format_conversations(df, scratch(), **kw)
    return pieces, sorted(map(tuple, chat.digests(pieces).select(*CHAT_COLS).collect()), key=repr)


def test_chat_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, REGISTRY["op13_chat_format"](spark, SF).select(*CHAT_COLS).collect()), key=repr)
    assert got == brute_chat(rows + [(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)])


HOSTILE = ["", " ", "\\", "\\\\", "#", "####", "###", "#\\##", "</turn>", "<\\/turn>", " </turn>\n", "</turn></turn>", "<</turn>",
           "### Assistant: x </turn>\n", MARKED, "text \\### User: ", "\\</turn>", "é\U0001f600\x00\r\n", "=a:b"]


def test_marks_in_texts_round_trip():
    t = chat.Template()
    escape, rng = t.escaper(), random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(HOSTILE + list("#<\\/t>n ")) for _ in range(rng.randrange(6)))
        body = escape(text)
        assert not any(m in body for m in t.marks) and chat.unescape(body) == text
        piece = t.header("user") + body + t.close + t.header("a: b</turn>") + body + t.close
        assert [(r, x) for r, x, _, _ in chat.read_back(piece, t)] == [("user", text), ("a: b</turn>", text)]


@pytest.mark.parametrize("piece", [chat.PIECE, 50])
def test_long_conversation_over_many_tasks(spark, scratch, piece):
    """Most turns belong to one conversation: many tasks and pieces share it,
    its order is judged across them, and one wrong turn in its middle is seen."""
    rng, rows = random.Random(4), []
    for c in range(30):
        for k in range(rng.randrange(1, 6)):
            rows.append((c, k, rng.choice(["user", "assistant"]) if c % 2 else ("user", "assistant")[k % 2], rng.choice(HOSTILE)))
    rows += [(100, k, ("user", "assistant")[k % 2], f"turn {k} {rng.choice(HOSTILE)}") for k in range(4000)]
    rows += [(101, k, ("user", "assistant")[(k + (k > 1500)) % 2], "x") for k in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces, got = formatted(df, scratch, piece=piece)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_chat(rows)
    assert dict((r[0], r[5]) for r in got)[100] and not dict((r[0], r[5]) for r in got)[101]
    assert pieces.where("conv_id = 100").select("part").distinct().count() > 1
    # the loss flags of the pieces cut out the learned texts
    text = "".join(chat.unescape(p.text[s.start:s.end]) for p in pieces.where("conv_id = 100").orderBy("part", "piece").collect() for s in p.loss)
    assert text == "".join(t for c, k, r, t in sorted(rows) if c == 100 and r == "assistant")


def test_chat_odd_rows(spark, scratch):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (None, 0, "user", "no id"), (None, None, None, None), (2, 0, "tool: x\n", "t"),
            (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "tie"), (4, 0, "assistant", "begins"),
            (5, 0, "user", "word " * 300_000), (5, 1, "assistant", "\\" * 100_000), (6, None, "user", "a"), (6, -5, "assistant", "b")]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("part", "piece", "loss", "shared", "valid", "n_turns", "_conv"):
        df = df.withColumn(name, F.lit("clash"))
    assert formatted(df, scratch)[1] == brute_chat(rows)
    assert formatted(df.limit(0), scratch)[1] == []


def test_templates_that_cannot_be_read_back_are_refused():
    for kw in ({"close": "</t></t>"}, {"open": "#"}, {"close": " \\x"}, {"roles": {"a": chat.Role("x: y", True, (None,))}}):
        with pytest.raises(ValueError):
            chat.Template(**kw)


def test_sides_hash_alike_wherever_a_word_stands():
    import pyarrow as pa
    rng = random.Random(8)
    spelt = ["".join(rng.choice("abéÿ") for _ in range(rng.randrange(6, 90))) for _ in range(400)]
    row, pos, _, left, right = variants.grams(pa.record_batch({"word": pa.array(spelt)}))
    sides = {}
    for r, p, a, b in zip(row.tolist(), pos.tolist(), left.tolist(), right.tolist()):
        for side, h in ((spelt[r][:p], a), (spelt[r][p + 2:], b)):
            assert sides.setdefault(side, h) == h
    assert len(set(sides.values())) == len(sides)
