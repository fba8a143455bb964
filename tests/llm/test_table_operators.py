"""WARC, URL templates, token files, quality and embeddings."""

import base64
import gzip
import hashlib
import io
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from mailweave.llm import embed, huffman, quality, urls, warc
from mailweave.llm.common import crc_fold

from .conftest import SF

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- WARC -------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_records_round_trip():
    cases = [(1, "http://a/é\r\nX: y", b"hello" * 100_000, None), (2, None, b"", None), (None, "u", b"hi", None),
             (3, "http://x", b"hi", 9), (4, "x", os.urandom(300_000), None), (5, "x", b"\r\n\r\n" * 9, None)]
    raw = b"".join(warc.member(warc.render(i, u, p, sha(p), r)) for i, u, p, r in cases)
    got = list(warc.read_records(io.BytesIO(raw), keep_payload=True))
    for r, (i, u, p, refers) in zip(got, cases, strict=True):
        assert (r.payload_bytes, r.payload_digest) == (len(p), sha(p))
        assert r.headers["x-page-id"] == ("" if i is None else str(i)) and "x" not in r.headers
        assert r.payload == (b"" if refers else p)
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(cases)  # any reader of gzip members takes it


@pytest.mark.parametrize("spoil", ["cut", "digest", "length", "longer"])
def test_broken_records_are_found(spoil):
    rec = warc.render(1, "http://a/", b"payload", sha(b"payload"), None)
    rec = {"cut": rec, "digest": rec.replace(b"payload", b"paYload"), "length": rec.replace(b"payload", b"pay"),
           "longer": rec.replace(b"payload", b"payload and more")}[spoil]
    data = warc.member(rec)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data[:-9] if spoil == "cut" else data)))


def expected_pages(pages):
    last = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    out = []
    for i, _, h in pages:
        p = (h or "").encode()
        of = last.get(h or "")
        revisit = of is not None and of != i
        out.append((i, len(p), sha(p), "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=repr)


def test_pages_round_trip(spark, scratch):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    odd = [(1, "http://a/", "same"), (2, None, "same"), (9, "http://b/", "same"), (9, "http://b/", "same"), (None, "x", "same"),
           (3, "y", None), (4, "y", ""), (None, None, "alone"), (5, "z", "é" * 200_000), (5, "z", "other")]
    for pages in (real, odd):
        df = spark.createDataFrame(pages, PAGES).selectExpr("*", "'clash' AS digest", "'clash' AS refers_to", "'clash' AS k")
        got = warc.round_trip(df, scratch()).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_pages(pages)
    assert warc.round_trip(spark.createDataFrame([], PAGES), scratch()).count() == 0


def test_small_payloads_may_stay_whole(spark, scratch):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "long enough"), (4, "a", "long enough")], PAGES)
    got = {r.page_id: r.record_type for r in warc.round_trip(df, scratch(), min_revisit_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archives_roll(spark, scratch):
    df = spark.createDataFrame([(k, "a", os.urandom(500).hex(), None) for k in range(50)],
                               "page_id bigint, url string, html string, refers_to bigint").coalesce(1)
    made = warc.write_archives(df, scratch().path("rolled"), roll=5_000).cache()
    assert made.count() > 3 and made.agg({"records": "sum"}).first()[0] == 50
    assert warc.read_archives(made).select("page_id").distinct().count() == 50


# --- URL templates ----------------------------------------------------------

def url_rows(spark, scratch, values, **more):
    df = spark.createDataFrame(list(enumerate(values)), "page_id bigint, url string").selectExpr("*", "'clash' AS host", "'c' AS head")
    return {r.page_id: r for r in urls.judge(df, scratch(), **more).collect()}


def test_hosts_paths_and_rules(spark, scratch):
    cases = [("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
             ("https://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
             ("https://example.com/deep", "example.com", "/deep", None, None), ("http://x.net", "x.net", "", None, None),
             ("http://x.net/", "x.net", "/", "net/", "block"), ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
             ("http://notexample.com/de/", "notexample.com", "/de/", None, None), ("no scheme", "", "", None, None),
             (None, "", "", None, None), ("", "", "", None, None), ("a://É.org?x", "É.org", "", None, None),
             ("http://h#f", "h", "", None, None), ("http://a://b/c", "a:", "//b/c", None, None)]
    got = url_rows(spark, scratch, [c[0] for c in cases])
    for k, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == verdict or verdict is None


def test_templates_reject_by_purity(spark, scratch):
    """A branch whose pages a rule mostly blocks takes its other pages with it; a clean branch stays."""
    values = [f"http://shop.test/item/buy{k}.html" for k in range(60)] + [f"http://shop.test/news/a{k}" for k in range(80)]
    values += ["http://shop.test/item/x"] * 2
    got = url_rows(spark, scratch, values, rules=(("block", "shop.test/item/buy"),))
    assert {got[k].verdict for k in range(60, 140)} == {"allow"}
    assert {got[k].verdict for k in range(60)} == {"block"}
    spam = [f"http://s.test/go/{w}{k}" for w in ("ad", "ab") for k in range(40)]
    got = url_rows(spark, scratch, spam + ["http://s.test/go/ad"], rules=(("block", "s.test/go/ad1"), ("block", "s.test/go/ad2"),
                                                                       ("block", "s.test/go/ad3")))
    assert got[0].rule is None and got[0].verdict == "block"  # /go/ad* is blocked for 30 of its 41 pages


def test_crowded_branches_become_wildcards(spark, scratch):
    import string
    words = [a + b for a in string.ascii_lowercase for b in "xyz"]
    df = spark.createDataFrame([("h", w, "", 1, 0) for w in words] + [("h", "big", "", 100, 0)],
                               "host string, head string, tail string, n bigint, blocked bigint")
    got = {r["head"]: r["head_g"] for r in urls._generalise(df, ["host"], "head", scratch()).collect()}
    assert got["big"] == "big" and {got[w] for w in words} == {"*"}


def test_segments_are_generalised_one_by_one(spark, scratch):
    """Unlike pages below a variable segment are judged apart, at any depth; a
    branch without a labelled page stays, whatever the rest of its host is."""
    values = [f"http://s.test/shop/{chr(97 + k % 26)}{chr(97 + k // 26)}/{leaf}" for k in range(60) for leaf in ("checkout", "info/more")]
    values += [f"http://s.test/other/{k}" for k in range(30)]
    rules = tuple(("block", f"s.test/shop/{chr(97 + k % 26)}{chr(97 + k // 26)}/checkout") for k in range(0, 60, 2))
    rules += tuple(("allow", f"s.test/shop/{chr(97 + k % 26)}{chr(97 + k // 26)}/info") for k in range(0, 60, 3))
    got = url_rows(spark, scratch, values, rules=rules)
    verdicts = {leaf: {got[k].verdict for k, v in enumerate(values) if leaf in v} for leaf in ("checkout", "info", "other")}
    assert verdicts == {"checkout": {"block"}, "info": {"allow"}, "other": {"allow"}}


def test_very_long_and_odd_paths(spark, scratch):
    long = "http://l.test/" + "a/" * 20_000 + "x" * 100_000
    got = url_rows(spark, scratch, [long, "http://l.test", "http://l.test/", "http://l.test//", "http://l.test/a//b/"] * 3)
    assert len(got) == 15 and {r.verdict for r in got.values()} == {"allow"} and got[0].path == long[13:]


def test_url_frames(spark, scratch):
    df = spark.createDataFrame([(None, "http://a.net/"), (1, "http://a.net/"), (1, "http://a.net/")], "page_id bigint, url string")
    assert sorted(repr(r.page_id) for r in urls.judge(df, scratch()).collect()) == ["1", "1", "None"]
    assert urls.judge(df.limit(0), scratch()).count() == 0


# --- token files ------------------------------------------------------------

def test_code_lengths_are_optimal_and_bounded():
    import heapq
    rng = np.random.default_rng(1)
    for counts in (rng.integers(0, 50, 300), 2 ** np.arange(40), np.array([5]), np.array([0, 0]), np.array([0, 3, 9]), np.ones(300, int)):
        length = huffman.code_lengths(counts)
        used = counts > 0
        assert (length[~used] == 0).all() and length.max(initial=0) <= huffman.LIMIT
        assert sum(2.0 ** -int(x) for x in length[used]) <= 1
        heap, best = [int(c) for c in counts[used]], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            best += both
            heapq.heappush(heap, both)
        cost = int((length.astype(int) * counts).sum())
        assert cost >= best
        if len(counts) != 40 and used.sum() > 1:
            assert cost == best  # nothing is limited here
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(20, int), 4)


def test_pack_and_unpack():
    rng = np.random.default_rng(2)
    for size in (1, 2, 300, 40_000):
        counts = rng.integers(1, 1000, size)
        length = huffman.code_lengths(counts)
        for n in (1, 255, 256, 257, 5000):
            ids = rng.integers(0, size, n)
            data, points = huffman.pack(ids, huffman.canonical(length), length)
            assert (huffman.Table(length).unpack(data, points, n) == ids).all()


def test_blocks_are_independent_and_checked(tmp_path, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK", 1000)
    rng = np.random.default_rng(3)
    docs = [(None if k == 3 else k, rng.integers(0, 500, rng.integers(0, 900))) for k in range(40)] + [(99, rng.integers(0, 500, 5000))]
    counts = np.bincount(np.concatenate([x for _, x in docs]), minlength=500)
    length = huffman.code_lengths(counts)
    path = str(tmp_path / "x.huff")
    w = huffman.Writer(path, length, huffman.canonical(length))
    for d, x in docs:
        w.add(d, x)
    w.close()
    r = huffman.Reader(path)
    flat = np.concatenate([x for _, x in docs])
    assert len(r.blocks) > 10 and (r.block(7) == flat[7000:8000]).all()
    assert list(r.documents()) == [(d, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, x in docs]
    raw = bytearray(open(path, "rb").read())
    raw[int(r.blocks[2][0]) + 60] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises(ValueError):
        huffman.Reader(path).block(2)
    open(path, "wb").write(raw[:-4])
    with pytest.raises(ValueError):
        huffman.Reader(path)


def library_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    t.no_truncation()
    t.no_padding()
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_cached_tokenizer_equals_the_library(documents):
    rng = random.Random(4)
    texts = [r.text for r in documents.select("text").collect()] + ["", " ", "  a", " a ", "a <|endoftext|> b", "a\u00a0 b", "a \u2003b"]
    texts += ["".join(rng.choice("ab  \n\t.'s \x1c中é\u0085") for _ in range(50)) for _ in range(1000)]
    tok = huffman.CachedTokenizer(BYTE_BPE)
    got = [np.frombuffer(x, tok.kind).tolist() for x in tok.encode(texts)]
    assert got == library_ids(texts)


def test_token_files_round_trip(spark, scratch, documents, odd_documents):
    for docs in (documents, odd_documents):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        packed = [(d is not None, d, np.array([*x, 2], "<u2").tobytes()) for (d, _), x in zip(rows, library_ids([t or "" for _, t in rows]))]
        packed.sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        want, start = [], 0
        for _, d, ids in packed:
            n = len(ids) // 2
            want.append((d, start, n, zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())))
            start += n
        got = huffman.round_trip(docs, scratch(), BYTE_BPE, 2)
        assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == want
    assert huffman.round_trip(documents.limit(0), scratch(), BYTE_BPE, 2).count() == 0


# --- quality ----------------------------------------------------------------

def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality.fit(docs, labels)
    got = (quality.score(docs, model).where(crc_fold() == 0).join(labels.where("quality IS NOT NULL"), "doc_id").collect())
    good, bad = [r.score for r in got if r.quality], [r.score for r in got if not r.quality]
    order = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert len(bad) >= 5 and order > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in got)


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(5)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)  # no main effect at all
    m = quality.Gam().fit(x[:3000], y[:3000])
    assert (0, 2) in m.pairs
    assert ((m.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9


def test_quality_ignores_held_out_and_contradicting_labels(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, q, None) for k in range(40) for q in (1, 1, 0)] + [(None, 1, 0), (1, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    x, y = quality.training_rows(docs, labels)
    assert len(y) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(40)) and (y == 1).all()


def test_quality_frames(spark, odd_documents):
    model = quality.fit(odd_documents.limit(0), spark.createDataFrame([], "doc_id bigint, quality int"))
    got = quality.score(odd_documents, model).collect()
    assert len(got) == odd_documents.count() and {r.score for r in got} == {0.5}
    assert (quality.features(b"") == 0).all() and np.isfinite(quality.features(b"\xff" * 10)).all()


# --- embeddings -------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_vectors(rows, threshold=0.9):
    rows = list({(i, None if v is None else tuple(v)): (i, v) for i, v in rows}.values())
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for size in {len(v) for _, v in ok}:                       # vectors of one length are compared with each other
        same = [(i, v) for i, v in ok if len(v) == size]
        x = np.array([v for _, v in same], dtype=np.float32).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link = x @ x.T >= threshold
        np.fill_diagonal(link, False)
        ids = [i for i, _ in same]
        parent = list(range(len(ids)))
        for a, b in zip(*np.nonzero(link)):
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[a] = parent[b] = a if ids[a] <= ids[b] else b
        for k, i in enumerate(ids):
            r = k
            while parent[r] != r:
                r = parent[r]
            out[i] = (int(link[k].sum()), ids[r])
    return sorted(((i, *out.get(i, (0, i))) for i, _ in rows), key=repr)


def check_vectors(spark, scratch, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).selectExpr("*", "'clash' AS v", "'c' AS node", "'c' AS cell")
    got = embed.near_duplicates(df, scratch()).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def dense(n, seed, dim=16, groups=12, noise=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * noise
    return [(k, [float(np.float32(a)) for a in v]) for k, v in enumerate(x)]


@pytest.mark.parametrize("per_cell,block", [(1500, 2048), (20, 2048), (40, 16)])
def test_vectors_against_all_pairs(spark, scratch, monkeypatch, per_cell, block):
    monkeypatch.setattr(embed, "PER_CELL", per_cell)
    monkeypatch.setattr(embed, "BLOCK", block)
    rows = dense(500, 3)
    rows += [(1000 + k, rows[7][1]) for k in range(30)] + [(2000, [2 * a for a in rows[9][1]])]
    check_vectors(spark, scratch, rows)


@pytest.mark.parametrize("per_cell", [1500, 20])
def test_vectors_of_several_lengths(spark, scratch, monkeypatch, per_cell):
    """Every length is compared within itself; an id may stand at vectors of two lengths."""
    monkeypatch.setattr(embed, "PER_CELL", per_cell)
    by_length = [dense(300, 3), [(k + 150, v) for k, v in dense(280, 4, dim=9)], [(5, [1.0]), (6, [2.0]), (7, [-3.0])]]
    by_length[1] += [(1000 + k, by_length[1][7][1]) for k in range(10)]
    df = spark.createDataFrame([(i, v, 0) for rows in by_length for i, v in rows], VECTORS)
    want = sorted((r for rows in by_length for r in brute_vectors(rows)), key=repr)
    got = embed.near_duplicates(df, scratch()).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_vectors(spark, scratch):
    one = [1.0] + [0.0] * 15
    rows = [(1, one), (2, one), (2, one), (None, one), (3, None), (4, []), (5, [0.0] * 16), (6, [float("nan")] + one[1:]), (7, [None] + one[1:]),
            (8, [float("inf")] + one[1:]), (9, [1.0, 0.0]), (10, [1e30] + [0.0] * 15), (11, [1e-40] + [0.0] * 15), (12, [-1.0] + [0.0] * 15)]
    check_vectors(spark, scratch, rows)
    assert embed.near_duplicates(spark.createDataFrame([], VECTORS), scratch()).count() == 0
    assert embed.near_duplicates(spark.createDataFrame([(1, None, 0)], VECTORS), scratch()).count() == 1


def test_test_table_vectors(spark, scratch):
    check_vectors(spark, scratch, [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()])


def shuffle_files(spark):
    """Sizes of the shuffle files there are now, by name."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(k).getName(): found.apply(k).length() for k in range(found.length())}


def test_vectors_without_clusters_are_dealt_once(spark, scratch, monkeypatch):
    """Vectors that are near every border are not copied to every cell they meet."""
    monkeypatch.setattr(embed, "PER_CELL", 20)
    monkeypatch.setattr(embed, "BLOCK", 16)
    x = np.random.default_rng(1).normal(size=(1500, 64)).astype(np.float32)
    x[1000:1010] = x[:10] + np.float32(0.01)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    before = shuffle_files(spark)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in embed.near_duplicates(df, scratch()).collect()), key=repr)
    written = sum(n for name, n in shuffle_files(spark).items() if name not in before)
    assert got == brute_vectors(rows) and sum(n for _, n, _ in got) == 20
    assert written < 6 * x.nbytes


# --- models against loops -----------------------------------------------------

def loop_tree(g, h, depth):
    """Greedy tree over ordered bins, every cut tried one by one."""
    total = sum(g) / (sum(h) + quality.RIDGE)
    if depth == 0 or len(g) < 2:
        return [total] * len(g)
    best = None
    for cut in range(1, len(g)):
        gain = sum(g[:cut]) ** 2 / (sum(h[:cut]) + quality.RIDGE) + sum(g[cut:]) ** 2 / (sum(h[cut:]) + quality.RIDGE)
        if best is None or gain > best[0] + 1e-12:
            best = (gain, cut)
    cut = best[1]
    return loop_tree(g[:cut], h[:cut], depth - 1) + loop_tree(g[cut:], h[cut:], depth - 1)


def loop_bin(edges, value):
    return sum(1 for e in edges if e <= value)


def test_gam_tables_against_loops(monkeypatch):
    """Cyclic boosting of the tables, and scores by table look-up, row by row."""
    import math
    monkeypatch.setattr(quality, "ROUNDS", 6)
    monkeypatch.setattr(quality, "PAIRS", 0)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 3)).round(1)
    y = (x[:, 0] + 0.5 * rng.normal(size=80) > 0).astype(float)
    model = quality.Gam().fit(x, y)
    rate = (y.sum() + 0.5) / 81
    total, tables = [math.log(rate / (1 - rate))] * 80, [[0.0] * (len(e) + 1) for e in model.edges]
    bins = [[loop_bin(e, x[r, f]) for r in range(80)] for f, e in enumerate(model.edges)]
    for _ in range(6):
        for f in range(3):
            g, h = [0.0] * len(tables[f]), [0.0] * len(tables[f])
            for r in range(80):
                p = 1 / (1 + math.exp(-total[r]))
                g[bins[f][r]] += y[r] - p
                h[bins[f][r]] += p * (1 - p)
            step = [quality.RATE * v for v in loop_tree(g, h, 2)]
            tables[f] = [t + v for t, v in zip(tables[f], step)]
            total = [t + step[bins[f][r]] for r, t in enumerate(total)]
    for f in range(3):
        assert np.allclose(model.tables[f], tables[f])
    assert np.allclose(model.score(x), [1 / (1 + math.exp(-t)) for t in total])


def test_gam_scores_with_pairs_against_loops():
    import math
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.Gam().fit(x, y)
    assert model.pairs
    for row, score in zip(x[:50], model.score(x[:50])):
        total = model.intercept + sum(t[loop_bin(e, v)] for t, e, v in zip(model.tables, model.edges, row))
        total += sum(t[loop_bin(model.coarse[i], row[i])][loop_bin(model.coarse[j], row[j])] for t, (i, j) in zip(model.pair_tables, model.pairs))
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def test_network_against_loops():
    """Embedding, filters of each width, pooling and softmax, number by number."""
    import math

    from mailweave.llm import langid
    rng = np.random.default_rng(6)
    model = langid.ByteConvNet(["a", "b", "c"])
    p = model.params
    p["bias"] = rng.normal(0, 0.2, p["bias"].shape).astype(np.float32)
    p["shift"] = rng.normal(0, 0.2, p["shift"].shape).astype(np.float32)
    windows = rng.integers(0, 256, (4, langid.WINDOW)).astype(np.uint8)
    for window, got in zip(windows, model.probabilities(windows)):
        hidden = []
        for f in range(len(langid.WIDTHS) * langid.FILTERS):
            width, best = langid.WIDTHS[f // langid.FILTERS], -math.inf
            for at in range(langid.WINDOW - max(langid.WIDTHS) + 1):
                total = 0.0
                for k in range(width):
                    for e in range(langid.EMBEDDING):
                        total += float(p["emb"][window[at + k], e]) * float(p["conv"][k * langid.EMBEDDING + e, f])
                best = max(best, total)
            hidden.append(max(best + float(p["bias"][f]), 0.0))
        z = [sum(h * float(p["out"][f, c]) for f, h in enumerate(hidden)) + float(p["shift"][c]) for c in range(3)]
        want = [math.exp(v - max(z)) for v in z]
        assert np.allclose(got, np.array(want) / sum(want), atol=1e-4)


@pytest.mark.parametrize("name", ["op1_warc", "op9_embedding_cells"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from mailweave.llm import queries
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.REGISTRY[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    order = sorted(c[0] for c in want.description)
    assert sorted(got.columns) == order
    at = [[c[0] for c in want.description].index(c) for c in order]
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr) == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=repr)
