"""The registered queries and the corpus pipeline."""

import public_tokenizers

import corpus_pipeline
from mailweave.llm import decontam, langid, pii, queries

from .conftest import SF
from .test_text_operators import brute_apart_leaks, brute_components, brute_fingerprint, brute_leaks


def test_every_operator_has_one_query():
    import __spark_entry__
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(queries.ORACLE) <= set(names)


def test_url_query_equals_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    for d in (SF, "/root/testdata/sf0.01"):
        con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet')")
        got = queries.REGISTRY["op6_url_templates"](spark, d)
        want = con.execute(queries.ORACLE["op6_url_templates"])
        assert sorted(got.columns) == sorted(c[0] for c in want.description)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_pipeline_stages(spark, tmp_path):
    """Each stage against a plain version, on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert 4 <= len(names) <= 5
    frames = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], SF)
        if k < len(names) - 1:
            assert out.schema == docs.schema or [f.name for f in out.schema] == docs.columns
        out.write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    kept = [{r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for f in frames[:-1]]
    # language: exactly the documents without a letter are gone
    assert set(kept[1]) == {d for d, t in plain.items() if t and langid.LETTER.search(t)}
    # SimHash: the smallest doc_id of every component
    fp = {d: brute_fingerprint(t) for d, t in kept[1].items()}
    comp = brute_components(sorted(fp), [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    assert set(kept[2]) == set(comp.values())
    # decontamination: the documents with a leak
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(kept[3]) == set(kept[2]) - {d for d, _ in brute_leaks(kept[2].items(), items) | brute_apart_leaks(kept[2].items(), items)}
    # personal data: every text redacted, none dropped
    assert kept[4] == {d: pii.redact(t, pii.find(t)) for d, t in kept[3].items()}
    assert all(len(r.text) == r.n_chars for r in frames[4].collect())
    # tokens
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.no_truncation()
    got = {r.doc_id: list(r.ids) for r in frames[5].collect()}
    assert got == {d: tok.encode(t, add_special_tokens=False).ids for d, t in kept[4].items()}
    whole = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == got


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_pipeline_on_odd_documents(spark, odd_documents, tmp_path):
    """Nulls, repeated rows, long texts and clashing columns pass every stage;
    only what a stage is meant to drop goes."""
    docs = odd_documents
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k == len(corpus_pipeline.STAGES) - 1:
            assert out.count() == docs.count() > 0
            break
        assert out.columns == docs.columns
        assert out.where("lang_pred <> 'clash' OR score <> 'clash' OR kept_id <> 'clash'").count() == 0
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in odd_documents.collect()}


def test_no_label_drops_no_document(spark):
    """Without any ``lang`` nothing can be learned; texts with a letter stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    odd = spark.createDataFrame([(-1, None, None, "s", 0), (-2, "12 !", None, "s", 4), (-3, "", None, "s", 0), (-4, "中", None, "s", 1)], docs.schema)
    out = corpus_pipeline.language(spark, docs.unionByName(odd), SF)
    assert out.columns == docs.columns
    assert out.count() == docs.count() + 1 and out.where("doc_id = -4").count() == 1


def test_every_language_is_learned(spark):
    """250 languages of a few documents each: none is left out, and each can be told."""
    import random
    rng = random.Random(9)
    rows = []
    for k in range(250):
        alphabet = [chr(0x100 + 8 * k + j) for j in range(8)]
        for d in range(8):
            rows.append((len(rows), "".join(rng.choice(alphabet) for _ in range(300)), f"l{k:03d}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    langs, windows, target = langid._training_windows(docs)
    assert len(langs) == 250 and set(target) == set(range(250))
    assert corpus_pipeline.language(spark, docs.where("doc_id < 80"), SF).count() == 80
