"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, embed, huffman, langid, pii, quality, ranked, simhash, urls, variants, warc
from .common import Scratch, crc_fold

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE, END_ID = "byte_bpe_50k.json", 2


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query
def op3_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op3"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op4_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


@query
def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), Scratch(spark, "op6"))


def _fits(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


_BY_LENGTH = sorted(urls.RULES, key=lambda r: (-len(r[1]), r[1]))
_SEGMENTS = "str_split(regexp_replace(regexp_replace(path, '[0-9a-fA-F]{16,}', '*', 'g'), '[0-9]+', '*', 'g'), '/')[2:]"


def _children() -> str:
    """The pieces of a path, as :func:`urls.children` cuts it."""
    last = urls.DEPTH
    one = [f"CASE WHEN len(segments) >= {k} THEN '/' || segments[{k}] ELSE '' END AS c{k}" for k in range(1, last)]
    return ", ".join([*one, f"CASE WHEN len(segments) >= {last} THEN '/' || array_to_string(segments[{last}:], '/') ELSE '' END AS c{last}"])


def _level(k: int) -> str:
    """The common tables that generalise level ``k`` of the tree."""
    return f"""
kinds{k} AS (
  SELECT host, up, c{k}, CASE WHEN count(*) OVER w > {urls.MAX_CHILDREN} AND n < sum(n) OVER w * CAST({urls.MIN_SHARE} AS DOUBLE)
                              THEN '/*' ELSE c{k} END AS g
  FROM (SELECT host, up, c{k}, sum(n) AS n FROM nodes{k - 1} GROUP BY ALL) WINDOW w AS (PARTITION BY host, up)),
nodes{k} AS (
  SELECT * EXCLUDE (g) REPLACE (up || g AS up, CASE WHEN g = '' THEN parent ELSE up END AS parent)
  FROM nodes{k - 1} JOIN kinds{k} USING (host, up, c{k})),"""


_KEYS = ", ".join(["host", *urls.LEVELS])
ORACLE["op6_url_templates"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
cutup AS (
  SELECT *, CASE {" ".join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in _BY_LENGTH)} END AS rule,
         CASE {" ".join(f"WHEN {_fits(r)} THEN '{v}'" for v, r in _BY_LENGTH)} END AS label, {_SEGMENTS} AS segments
  FROM parsed),
base AS (SELECT *, {_children()} FROM cutup),
nodes0 AS (
  SELECT {_KEYS}, '' AS up, '' AS parent, count(*) AS n, count(*) FILTER (label = 'block') AS blocked, count(label) AS labelled
  FROM base GROUP BY ALL),{"".join(_level(k) for k in range(1, urls.DEPTH + 1))}
leaves AS (
  SELECT host, parent, up, CAST(sum(blocked) AS DOUBLE) AS blocked, CAST(sum(labelled) AS DOUBLE) AS labelled
  FROM nodes{urls.DEPTH} WHERE labelled > 0 GROUP BY ALL),
pooled AS (SELECT *, sum(blocked) OVER s / sum(labelled) OVER s AS p FROM leaves WINDOW s AS (PARTITION BY host, parent)),
alike AS (
  SELECT *, CASE WHEN abs(blocked / labelled - p) > {urls.Z} * sqrt(p * (1 - p) / labelled) + 1 / labelled THEN up END AS branch
  FROM pooled),
merged AS (
  SELECT *, sum(blocked) OVER m AS mb, sum(labelled) OVER m AS ml, sum(blocked) OVER (PARTITION BY host) AS hb,
         sum(labelled) OVER (PARTITION BY host) AS hl
  FROM alike WINDOW m AS (PARTITION BY host, parent, branch)),
bad AS (
  SELECT host, up FROM merged
  WHERE (mb + {urls.SMOOTHING} * ((hb + {urls.SMOOTHING} * {urls.PRIOR}) / (hl + {urls.SMOOTHING}))) / (ml + {urls.SMOOTHING}) >= {urls.REJECT}),
branches AS (SELECT DISTINCT {_KEYS}, true AS hit FROM nodes{urls.DEPTH} JOIN bad USING (host, up))
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN hit THEN 'block' ELSE 'allow' END) AS verdict
FROM base LEFT JOIN branches USING ({_KEYS})
"""


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", (crc_fold() == 0).alias("held_out"), "lang_pred", "score")


@query
def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_fold() == 0).alias("held_out"), "score", "predicted")


@query
def op9_embedding_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark, "op9"))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: components by the smallest reachable id, over the pairs that reach the threshold
ORACLE["op9_embedding_cells"] = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, len(v) AS size, list_transform(v, lambda x: x / top) AS v
  FROM (SELECT vec_id, v, list_max(list_transform(v, lambda x: abs(x))) AS top
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
        WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
  WHERE top > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.size = b.size AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {embed.THRESHOLD}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
smallest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN smallest ON vec_id = smallest.a LEFT JOIN counted ON vec_id = counted.a
"""


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"), Scratch(spark, "op1"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * k + 1}, 5) AS INTEGER) >> {bits}) & 31), 1)"
    for k in range(8) for bits in (15, 10, 5, 0))
ORACLE["op1_warc"] = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS newest FROM payloads)
SELECT page_id, strlen(payload) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM last
"""


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(table(spark, sf_dir, "documents"), Scratch(spark, "op7"),
                              public_tokenizers.path(BYTE_BPE), END_ID)


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op12"))


_TERMS = (f"regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE["op12_ranked_search"] = f"""
WITH docs AS (
  SELECT *, CAST(len(ws) AS BIGINT) AS n
  FROM (SELECT doc_id, row_number() OVER () AS row_no, {_TERMS} AS ws FROM documents) WHERE len(ws) > 0),
whole AS (SELECT count(*) AS all_n, CAST(sum(n) AS BIGINT) AS all_l FROM docs),
asked AS (
  SELECT item_no, item_id, term, count(*) AS q
  FROM (SELECT item_no, item_id, unnest(ws) AS term
        FROM (SELECT item_id, row_number() OVER () AS item_no, {_TERMS} AS ws FROM benchmark)) GROUP BY ALL),
held AS (SELECT row_no, doc_id, n, term, count(*) AS tf FROM (SELECT row_no, doc_id, n, unnest(ws) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held CROSS JOIN whole WHERE term IN (SELECT term FROM asked) GROUP BY term, all_n),
scored AS (
  SELECT item_no, item_id, row_no, doc_id,
         CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_n) // all_l)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) CROSS JOIN whole GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= {ranked.TOP}
"""

#: a conversation whose texts spell the template's own marks
MARKED = r"\### Assistant: </turn> ok"


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], turns.schema)
    return chat.digests(chat.format_conversations(turns.unionByName(marked), Scratch(spark, "op13")))


def _header_chars() -> str:
    t = chat.Template()
    known = " ".join(f"WHEN '{r}' THEN {len(t.header(r))}" for r in t.roles)
    return f"CASE role {known} ELSE {len(t.header(''))} + length(url_encode(role)) END + {len(t.close)}"


ORACLE["op13_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, * FROM (VALUES (0, 'user', '{MARKED}'), (1, 'assistant', '{MARKED}'))),
steps AS (
  SELECT *, lag(role) OVER w AS before,
         {_header_chars()} + length(text) + length(text) - length(replace(text, '\\', ''))
         + coalesce(list_sum(list_transform(regexp_extract_all(text, '###+'), lambda x: length(x) - 2)), 0)
         + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       bool_and(CASE role WHEN 'system' THEN before IS NULL WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
                          WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END) AS valid
FROM steps GROUP BY conv_id
"""
