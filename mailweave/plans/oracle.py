"""DuckDB oracle SQL, one statement per registered query.

Each statement computes the expected result directly from the source
tables (``pages``, ``conversations``, ``documents``, ``events``), so no mail
parser, JSON repair or model is involved on the oracle side.  Queries with
no exact SQL form (Markdown rendering, YAML text) are
absent and get the driver's rows-only check.
"""

from __future__ import annotations

from ..functions.prompt import PROMPT_TEXT

NL = "chr(10)"
CRLF = "(chr(13) || chr(10))"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- shared CTEs --------------------------------------------------------------
KEYS = f"""keys AS (
  SELECT 'desk' AS account, 'INBOX' AS mailbox, page_id::BIGINT AS uid FROM pages
  UNION ALL SELECT 'desk', '[All]', (conv_id * 1000 + turn + 1)::BIGINT FROM conversations
  UNION ALL SELECT 'desk', 'docs', (doc_id + 1)::BIGINT FROM documents)"""

STATE = """state AS (
  SELECT account, mailbox, (max(uid) * 3 / 5)::BIGINT AS last_uid FROM keys
  WHERE mailbox <> 'docs' GROUP BY account, mailbox)"""

HOST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)"


def _b64_chunked_len(n: str) -> str:
    """Byte length of base64 in 76-character CRLF lines for ``n`` input bytes."""
    l4 = f"(4 * (({n} + 2) // 3))"
    return f"(CASE WHEN {n} = 0 THEN 0 ELSE {l4} + 2 * (({l4} - 1) // 76) END)"


FB_ZONE = "CASE conv_id % 4 WHEN 0 THEN ' +0000' WHEN 1 THEN ' +0800' WHEN 2 THEN ' -0500' ELSE '' END"
FB_RAW_LEN = f"""(strlen(
    'From: ' || role || ' <' || role || '@chat.x.org>' || {CRLF} ||
    'To: desk@x.org' || {CRLF} ||
    'Date: ' || repeat('x', 25) || {FB_ZONE} || {CRLF} ||
    'Subject: conv ' || conv_id || ' turn ' || turn || {CRLF} ||
    CASE WHEN turn = 2 THEN '' ELSE 'Message-ID: <c' || conv_id || '.' || turn || '@x.org>' || {CRLF} END ||
    'MIME-Version: 1.0' || {CRLF} ||
    'Content-Type: text/plain; charset=utf-8' || {CRLF} ||
    'Content-Transfer-Encoding: base64' || {CRLF} || {CRLF}) + {_b64_chunked_len('strlen(text)')} + 2)"""

FC_RAW_LEN = f"""(strlen(
    'From: Docs <docs@x.org>' || {CRLF} ||
    'To: desk@x.org, Desk <desk@x.org>, desk@x.org' || {CRLF} ||
    CASE WHEN doc_id % 3 = 0 THEN 'Cc: "Doe, Jane" <jane@x.org>, lonely@x.org' || {CRLF} ELSE '' END ||
    'Date: Mon, 30 Nov 2026 08:00:00 +0000' || {CRLF} ||
    'Subject: =?utf-8?b?' || base64(encode('doc ' || doc_id || ' ' || lang)) || '?=' || {CRLF} ||
    'Message-ID: <d' || doc_id || '@x.org>' || {CRLF} ||
    'MIME-Version: 1.0' || {CRLF} ||
    'Content-Type: multipart/mixed; boundary="b' || doc_id || '"' || {CRLF} || {CRLF} ||
    '--b' || doc_id || {CRLF} ||
    'Content-Type: text/plain; charset=utf-8' || {CRLF} ||
    'Content-Transfer-Encoding: base64' || {CRLF} || {CRLF} ||
    {CRLF} ||
    '--b' || doc_id || {CRLF} ||
    'Content-Type: text/html; charset=utf-8' || {CRLF} || {CRLF} ||
    '<p>alt</p>' || {CRLF} ||
    '--b' || doc_id || {CRLF} ||
    'Content-Type: text/csv; name="f' || doc_id || '.csv"' || {CRLF} ||
    'Content-Disposition: attachment; filename="f' || doc_id || '.csv"' || {CRLF} || {CRLF} ||
    'doc_id,lang' || {CRLF} || doc_id || ',' || lang || {CRLF} ||
    '--b' || doc_id || '--' || {CRLF})
  + CASE WHEN doc_id % 7 = 0 THEN 0 ELSE {_b64_chunked_len('strlen(text)')} END)"""

FB_DATE = f"""'2026-12-' || lpad((conv_id % 28 + 1)::VARCHAR, 2, '0') || 'T' ||
    lpad((conv_id % 24)::VARCHAR, 2, '0') || ':' || lpad(turn::VARCHAR, 2, '0') || ':00' ||
    CASE conv_id % 4 WHEN 1 THEN '+08:00' WHEN 2 THEN '-05:00' ELSE '+00:00' END"""

def _decoded(x: str) -> str:
    for entity, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&apos;", "chr(39)"),
                         ("&nbsp;", "chr(160)"), ("&middot;", "chr(183)"), ("&copy;", "chr(169)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{entity}', {char})"
    return x


def _stripped(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _without_scripts(x: str) -> str:
    return (f"regexp_replace(regexp_replace({x}, '<script.*?>.*?</script>', '', 'gis'), "
            f"'<style.*?>.*?</style>', '', 'gis')")


def _tags_to_text(x: str) -> str:
    x = f"regexp_replace({x}, '<br\\s*/?>', {NL}, 'gis')"
    x = f"regexp_replace({x}, '</p\\s*>', {NL} || {NL}, 'gis')"
    return f"regexp_replace({x}, '<.*?>', '', 'gis')"


HTML_TEXT = _stripped(_decoded(_tags_to_text(_without_scripts("html"))))
# the stored body keeps links as [text](target); every anchor of the test pages has a double-quoted target
_ANCHOR = """'<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'"""
HTML_BODY = _stripped(_decoded(_tags_to_text(
    f"regexp_replace({_without_scripts('html')}, {_ANCHOR}, '[\\2](\\1)', 'gis')")))

# Expected documents of F-A..F-C (valid messages only).
DOCS = f"""docs AS (
  SELECT 'desk' AS account, 'INBOX' AS mailbox, page_id::BIGINT AS uid,
    '<page-' || page_id || '@x.org>' AS message_id,
    regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS subject,
    '2026-12-01T17:02:00+08:00' AS date_iso,
    '新闻 Desk <news@' || {HOST} || '>' AS from_addr,
    'a@x.org|B <b@x.org>' AS "to", '' AS cc,
    length(html)::BIGINT AS size, NULL::VARCHAR AS labels, NULL::VARCHAR AS thread_id,
    {HTML_BODY} AS body, '' AS attachments
  FROM pages WHERE page_id <> 0
  UNION ALL
  SELECT 'desk', '[All]', (conv_id * 1000 + turn + 1)::BIGINT,
    CASE WHEN turn = 2 THEN '' ELSE '<c' || conv_id || '.' || turn || '@x.org>' END,
    'conv ' || conv_id || ' turn ' || turn,
    {FB_DATE},
    upper(substr(role, 1, 1)) || substr(role, 2) || ' <' || role || '@chat.x.org>',
    'desk@x.org', '',
    {FB_RAW_LEN}::BIGINT, role, conv_id::VARCHAR,
    text, ''
  FROM conversations
  UNION ALL
  SELECT 'desk', 'docs', (doc_id + 1)::BIGINT,
    '<d' || doc_id || '@x.org>',
    'doc ' || doc_id || ' ' || lang,
    '2026-11-30T08:00:00+00:00',
    'Docs <docs@x.org>',
    'desk@x.org|Desk <desk@x.org>',
    CASE WHEN doc_id % 3 = 0 THEN 'Doe, Jane <jane@x.org>|lonely@x.org' ELSE '' END,
    {FC_RAW_LEN}::BIGINT,
    CASE WHEN doc_id % 3 = 1 THEN source || '|' || lang END,
    CASE WHEN doc_id % 4 <> 0 THEN (doc_id * 7)::VARCHAR END,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END,
    'f' || doc_id || '.csv'
  FROM documents)"""

FF_ITEM = """('{"title": "' || lang || ' story ' || doc_id || '", "url": "https://n.example/' || doc_id ||
    '", "summary": "' || source || '"' ||
    CASE WHEN doc_id % 2 = 1 THEN '' ELSE ', "date": "2026-11-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') || ' 09:30"' END ||
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE ', "sender": "news@src.example"' END || '}')"""

FF_RESP = f"""resp AS (
  SELECT 'desk' AS account, 'docs' AS mailbox, (doc_id + 1)::BIGINT AS uid, doc_id,
    CASE doc_id % 5
      WHEN 0 THEN '[' || {FF_ITEM} || ', ' || {FF_ITEM} || ']'
      WHEN 1 THEN '```json' || {NL} || '[' || {FF_ITEM} || ', ' || {FF_ITEM} || ']' || {NL} || '```'
      WHEN 2 THEN '  ```json' || {NL} || '[' || {FF_ITEM} || ',, ]' || {NL} || '```'
      WHEN 3 THEN 'Here are the news: ' || lang
      ELSE '```' || {NL} || '] nothing [' || doc_id || {NL} || '```' END AS response
  FROM documents)"""

# Repair: valid as is; else fenced and a valid [ .. ] slice; else unchanged.
FF_REPAIRED = """rep AS (
  SELECT account, mailbox, uid, doc_id, response, json_valid(response) AS v0,
    regexp_replace(response, '^\\s+', '') LIKE '```%' AS fenced,
    instr(response, '[') AS fi,
    length(response) - instr(reverse(response), ']') + 1 AS la,
    instr(reverse(response), ']') AS lr
  FROM resp),
rep2 AS (
  SELECT *, CASE WHEN NOT v0 AND fenced AND fi > 0 AND lr > 0 AND fi < la
                 THEN substr(response, fi, la - fi + 1) END AS cand FROM rep),
results AS (
  SELECT account, mailbox, uid, doc_id,
    CASE WHEN NOT v0 AND coalesce(json_valid(cand), false) THEN cand ELSE response END AS response,
    (NOT v0 AND coalesce(json_valid(cand), false)) AS repaired,
    (v0 OR coalesce(json_valid(cand), false)) AS valid_json
  FROM rep2)"""

ITEM_TYPE = """'[{"title":"VARCHAR","url":"VARCHAR","summary":"VARCHAR","date":"VARCHAR","sender":"VARCHAR"}]'"""

FF_ITEMS = f"""arr AS (
  SELECT account, mailbox, uid, doc_id, from_json(response, {ITEM_TYPE}) AS a FROM results
  WHERE valid_json AND regexp_matches(response, '^\\s*\\[')),
items AS (
  SELECT account, mailbox, uid, doc_id, i::BIGINT AS pos, a[i].title AS title, a[i].url AS url,
         a[i].summary AS summary, a[i].date AS date, a[i].sender AS sender
  FROM (SELECT *, generate_subscripts(a, 1) AS i FROM arr))"""

# Attempt patterns of F-F by doc_id % 6 (kind: ok = the F-F response, '' = empty, NULL = error).
FF_ATTEMPTS = f"""pat(m6, attempt_no, kind, error) AS (VALUES
  (0, 1, 'ok', NULL),
  (1, 1, '', NULL), (1, 2, 'ok', NULL),
  (2, 1, NULL, 'timeout'), (2, 2, NULL, 'data_inspection_failed: blocked'), (2, 3, 'ok', NULL),
  (3, 1, NULL, 'error 1'), (3, 2, NULL, 'error 2'), (3, 3, NULL, 'error 3'), (3, 4, 'ok', NULL),
  (4, 1, NULL, 'Inappropriate Content detected'), (4, 2, 'ok', NULL),
  (5, 1, '', NULL), (5, 2, 'ok', NULL), (5, 3, NULL, 'late error')),
att AS (
  SELECT r.account, r.mailbox, r.uid, p.attempt_no,
    CASE WHEN p.kind = 'ok' THEN r.response ELSE p.kind END AS response, p.error
  FROM resp r JOIN pat p ON r.doc_id % 6 = p.m6),
fold AS (
  SELECT account, mailbox, uid,
    min(attempt_no) FILTER (WHERE coalesce(length(response) > 0, false)
       OR coalesce(contains(error, 'data_inspection_failed') OR contains(lower(error), 'inappropriate content'), false)) AS t_no,
    max(attempt_no) AS last_no
  FROM att WHERE attempt_no <= 3 GROUP BY account, mailbox, uid),
outcomes AS (
  SELECT f.account, f.mailbox, f.uid,
    CASE WHEN t.attempt_no IS NULL THEN 'failed'
         WHEN coalesce(length(t.response) > 0, false) THEN 'ok' ELSE 'blocked' END AS outcome,
    coalesce(f.t_no, f.last_no)::BIGINT AS attempt_no,
    CASE WHEN coalesce(length(t.response) > 0, false) THEN t.response END AS response,
    CASE WHEN t.attempt_no IS NULL THEN coalesce(l.error, 'empty response')
         WHEN coalesce(length(t.response) > 0, false) THEN NULL ELSE t.error END AS error
  FROM fold f
  LEFT JOIN att t ON t.uid = f.uid AND t.attempt_no = f.t_no
  LEFT JOIN att l ON l.uid = f.uid AND l.attempt_no = f.last_no)"""

STUB = f"""prompts AS (
  SELECT 'desk' AS account, 'docs' AS mailbox, (doc_id + 1)::BIGINT AS uid,
         md5({_sql_str(PROMPT_TEXT)} || {NL} || {NL} || text) AS h FROM documents),
cls AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % 6 AS c,
  '[{{"title": "item ' || substr(h, 1, 8) || '", "url": "https://n.example/' || substr(h, 9, 8) ||
  '", "summary": "' || substr(h, 17, 8) || '", "date": "", "sender": ""}}]' AS answer FROM prompts),
spat(c, attempt_no, kind, error) AS (VALUES
  (0, 1, 'answer', NULL),
  (1, 1, '', 'empty response'), (1, 2, 'answer', NULL),
  (2, 1, NULL, 'timeout'), (2, 2, NULL, 'data_inspection_failed: input blocked'),
  (3, 1, NULL, 'upstream error 1'), (3, 2, NULL, 'upstream error 2'), (3, 3, NULL, 'upstream error 3'),
  (4, 1, NULL, 'Inappropriate Content'),
  (5, 1, 'fenced', NULL))"""

ORACLE: dict[str, str] = {}

ORACLE["raw_scan"] = f"""
SELECT 'desk' AS account, 'INBOX' AS mailbox, page_id::BIGINT AS uid, length(html)::BIGINT AS size,
       NULL::VARCHAR AS labels, NULL::VARCHAR AS thread_id FROM pages
UNION ALL
SELECT 'desk', '[All]', (conv_id * 1000 + turn + 1)::BIGINT, {FB_RAW_LEN}::BIGINT, role, conv_id::VARCHAR
FROM conversations
UNION ALL
SELECT 'desk', 'docs', (doc_id + 1)::BIGINT, {FC_RAW_LEN}::BIGINT,
       CASE WHEN doc_id % 3 = 1 THEN source || '|' || lang END,
       CASE WHEN doc_id % 4 <> 0 THEN (doc_id * 7)::VARCHAR END
FROM documents"""

ORACLE["provider_meta"] = """
SELECT doc_id, n_chars::BIGINT AS size,
  CASE WHEN doc_id % 4 <> 0 THEN (doc_id * 7)::VARCHAR END AS thread_id,
  CASE WHEN doc_id % 3 <> 2 THEN NULL
       WHEN doc_id % 9 = 2 THEN source || ' x|' || lang || '|\\Inbox'
       WHEN doc_id % 9 = 5 THEN 'it''s|' || lang
       ELSE source || ' x|' || lang || '|Inbox|ab cd' END AS labels
FROM documents"""

ORACLE["doc_scan"] = """
SELECT (doc_id + 1)::VARCHAR AS id, md5(CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END) AS body_md5
FROM documents"""

ORACLE["doc_sink_append"] = f"""
WITH {KEYS}, {DOCS}
SELECT account, mailbox, uid, 'existing' AS origin, NULL::VARCHAR AS subject FROM keys WHERE uid % 3 = 0
UNION ALL
SELECT account, mailbox, uid, 'new', subject FROM docs WHERE uid % 3 <> 0"""

ORACLE["doc_sink_overwrite"] = f"""
WITH {KEYS}, {DOCS}
SELECT account, mailbox, uid, 'new' AS origin, subject FROM docs
UNION ALL
SELECT k.account, k.mailbox, k.uid, 'existing', NULL::VARCHAR FROM keys k
WHERE k.uid % 3 = 0 AND NOT EXISTS (SELECT 1 FROM docs d WHERE d.account = k.account
  AND d.mailbox = k.mailbox AND d.uid = k.uid)"""

ORACLE["result_sink"] = f"""
WITH {FF_RESP}, {FF_ATTEMPTS},
rep AS (
  SELECT account, mailbox, uid, response, json_valid(response) AS v0,
    regexp_replace(response, '^\\s+', '') LIKE '```%' AS fenced,
    instr(response, '[') AS fi, length(response) - instr(reverse(response), ']') + 1 AS la,
    instr(reverse(response), ']') AS lr
  FROM outcomes WHERE outcome = 'ok'),
rep2 AS (SELECT *, CASE WHEN NOT v0 AND fenced AND fi > 0 AND lr > 0 AND fi < la
                        THEN substr(response, fi, la - fi + 1) END AS cand FROM rep)
SELECT account, mailbox, uid,
  CASE WHEN NOT v0 AND coalesce(json_valid(cand), false) THEN cand ELSE response END AS response,
  (NOT v0 AND coalesce(json_valid(cand), false)) AS repaired,
  (v0 OR coalesce(json_valid(cand), false)) AS valid_json
FROM rep2 WHERE length(response) > 0 AND uid % 2 <> 0"""

ORACLE["quarantine_split"] = f"""
WITH {FF_RESP}, {FF_ATTEMPTS}
SELECT account, mailbox, uid, error FROM outcomes WHERE outcome = 'blocked'
UNION ALL
SELECT 'desk', 'docs', (doc_id + 1)::BIGINT, 'older block' FROM documents d
WHERE (doc_id + 1) % 5 = 0 AND (doc_id + 1)::BIGINT NOT IN (SELECT uid FROM outcomes WHERE outcome = 'blocked')"""

ORACLE["state_load"] = """
WITH g AS (SELECT conv_id, max(turn) AS mt, count(*) AS n FROM conversations GROUP BY conv_id),
ok AS (SELECT * FROM g WHERE conv_id % 11 <> 0)
SELECT conv_id, 'desk:conv' || conv_id AS key, 'desk' AS account, 'conv' || conv_id AS mailbox,
  (CASE WHEN conv_id % 7 = 0 OR conv_id % 5 = 0 THEN mt * 10 WHEN conv_id % 13 = 0 THEN 1 ELSE mt * 10 END)::BIGINT
    AS last_uid
FROM ok
UNION ALL
SELECT conv_id, 'desk:all', 'desk', 'all', n::BIGINT FROM ok"""

_ADVANCED = f"""{KEYS}, {STATE},
seen AS (SELECT k.account, k.mailbox, k.uid FROM keys k LEFT JOIN state s
         ON k.account = s.account AND k.mailbox = s.mailbox
         WHERE k.uid <> 0 AND k.uid > coalesce(s.last_uid, 0)),
adv AS (SELECT account, mailbox, max(last_uid)::BIGINT AS last_uid FROM (
  SELECT account, mailbox, last_uid FROM state UNION ALL SELECT account, mailbox, uid FROM seen)
  GROUP BY account, mailbox)"""

ORACLE["state_advance"] = f"WITH {_ADVANCED} SELECT account, mailbox, last_uid FROM adv"

ORACLE["state_save"] = f"""WITH {_ADVANCED}
SELECT account, to_json(map_from_entries(list({{'k': account || ':' || mailbox, 'v': last_uid}}
       ORDER BY account || ':' || mailbox))) AS state_json
FROM adv GROUP BY account"""

ORACLE["high_water_filter"] = f"""WITH {KEYS}, {STATE}
SELECT k.account, k.mailbox, k.uid FROM keys k LEFT JOIN state s ON k.account = s.account AND k.mailbox = s.mailbox
WHERE k.uid <> 0 AND k.uid > coalesce(s.last_uid, 0)"""

ORACLE["full_rescan"] = f"WITH {KEYS} SELECT account, mailbox, uid FROM keys WHERE uid > 0 AND uid % 3 <> 0"

ORACLE["valid_records"] = f"WITH {KEYS} SELECT account, mailbox, uid, uid <> 0 AS valid FROM keys"

ORACLE["attachment_filter"] = """
SELECT 'desk' AS account, 'docs' AS mailbox, (doc_id + 1)::BIGINT AS uid, 3::BIGINT AS part_no,
       'f' || doc_id || '.csv' AS filename FROM documents"""

ORACLE["pending_docs"] = f"WITH {KEYS} SELECT account, mailbox, uid FROM keys WHERE uid % 2 <> 0 AND uid % 5 <> 0"
ORACLE["pending_key_tables"] = ORACLE["pending_docs"]

_RECON = f"""{KEYS}, {STATE},
listed AS (SELECT k.account, k.mailbox, k.uid FROM keys k LEFT JOIN state s
           ON k.account = s.account AND k.mailbox = s.mailbox WHERE k.uid > coalesce(s.last_uid, 0)),
rec AS (SELECT account, mailbox, uid,
  CASE WHEN uid % 3 = 0 THEN 'skipped' WHEN uid <> 0 THEN 'new' ELSE 'missing' END AS status FROM listed)"""

ORACLE["run_reconcile"] = f"WITH {_RECON} SELECT account, mailbox, uid, status FROM rec"

# a record without a uid is a failure of the run, whatever the mark of its mailbox
ORACLE["ingest_summary"] = f"""WITH {_RECON},
lost AS (SELECT account, mailbox, count(*) AS failed FROM keys WHERE coalesce(uid, 0) = 0 GROUP BY account, mailbox),
counts AS (SELECT account, mailbox,
  count(*) FILTER (WHERE status = 'new') AS new,
  count(*) FILTER (WHERE status = 'skipped') AS skipped,
  count(*) AS processed
FROM rec GROUP BY account, mailbox)
SELECT account, mailbox, coalesce(new, 0)::BIGINT AS new, coalesce(skipped, 0)::BIGINT AS skipped,
  coalesce(failed, 0)::BIGINT AS failed, coalesce(processed, 0)::BIGINT AS processed
FROM counts FULL JOIN lost USING (account, mailbox)"""

_FRONT_MATTER = """'{"uid":' || uid || ',"message_id":' || to_json(message_id) || ',"subject":' || to_json(subject) ||
  ',"date":' || to_json(date_iso) || ',"from":' || to_json(from_addr) || ',"size":' || size ||
  ',"to":' || to_json(string_split("to", '|')) ||
  CASE WHEN cc <> '' THEN ',"cc":' || to_json(string_split(cc, '|')) ELSE '' END ||
  CASE WHEN labels IS NOT NULL THEN ',"labels":' || to_json(string_split(labels, '|')) ELSE '' END ||
  CASE WHEN thread_id IS NOT NULL THEN ',"thread_id":' || to_json(thread_id) ELSE '' END ||
  CASE WHEN attachments <> '' THEN ',"attachments":' || to_json(string_split(attachments, '|')) ELSE '' END ||
  '}'"""

# F-C texts alone, F-A newsletters with front matter and links.
ORACLE["prompt_assemble"] = f"""WITH {DOCS},
texts AS (
  SELECT 'desk' AS account, 'docs' AS mailbox, (doc_id + 1)::BIGINT AS uid, text FROM documents
  UNION ALL
  SELECT account, mailbox, uid, '---' || {NL} || {_FRONT_MATTER} || {NL} || '---' || {NL} || body
  FROM docs WHERE mailbox = 'INBOX')
SELECT account, mailbox, uid, length({_sql_str(PROMPT_TEXT)} || {NL} || {NL} || text)::BIGINT AS prompt_chars,
  md5({_sql_str(PROMPT_TEXT)} || {NL} || {NL} || text) AS prompt_md5
FROM texts WHERE uid % 2 <> 0 AND uid % 5 <> 0"""

ORACLE["item_defaults"] = f"""WITH {FF_RESP}, {FF_REPAIRED}, {FF_ITEMS}
SELECT account, mailbox, uid, pos, title, url, summary,
  coalesce(strftime(coalesce(try_strptime(date, '%Y-%m-%d %H:%M'), try_strptime(date, '%Y-%m-%d')),
                    '%Y-%m-%d %H:%M'), '2026-11-30 08:00') AS date,
  CASE WHEN coalesce(sender, '') <> '' THEN sender ELSE 'docs@x.org' END AS sender
FROM items"""

ORACLE["extract_summary"] = f"""WITH {FF_RESP}, {FF_ATTEMPTS}
SELECT account, mailbox,
  count(*) FILTER (WHERE outcome = 'ok')::BIGINT AS ok,
  count(*) FILTER (WHERE outcome = 'failed')::BIGINT AS failed,
  count(*) FILTER (WHERE outcome = 'blocked')::BIGINT AS blocked,
  count(*) FILTER (WHERE outcome = 'failed') > 0 AS run_failed
FROM outcomes GROUP BY account, mailbox"""

ORACLE["attempt_outcome"] = f"""WITH {FF_RESP}, {FF_ATTEMPTS}
SELECT account, mailbox, uid, outcome, attempt_no, response, error FROM outcomes"""

ORACLE["newest_n"] = f"""WITH {KEYS}
SELECT account, mailbox, uid FROM (
  SELECT *, row_number() OVER (PARTITION BY account, mailbox ORDER BY uid DESC) AS rn FROM keys)
WHERE rn <= 50"""

_FG = """fg AS (
  SELECT CASE WHEN event_id % 5 = 0 THEN 'n' || event_id ELSE ((event_id * 37) % 10007)::VARCHAR END AS id,
         ts AS mtime FROM events),
ordered AS (
  SELECT id, row_number() OVER (ORDER BY
    CASE WHEN regexp_full_match(id, '[0-9]+') THEN 0 ELSE 1 END,
    CASE WHEN regexp_full_match(id, '[0-9]+') THEN length(ltrim(id, '0')) END NULLS FIRST,
    CASE WHEN regexp_full_match(id, '[0-9]+') THEN ltrim(id, '0') END NULLS FIRST,
    CASE WHEN NOT regexp_full_match(id, '[0-9]+') THEN mtime IS NULL END NULLS FIRST,
    CASE WHEN NOT regexp_full_match(id, '[0-9]+') THEN mtime END NULLS FIRST,
    id)::BIGINT AS pos FROM fg)"""

ORACLE["pending_order"] = f"WITH {_FG} SELECT id, pos FROM ordered"

ORACLE["dry_run"] = f"""WITH {_FG}
SELECT id, pos, 'read/' || id || '.json' AS target FROM ordered
WHERE pos > (SELECT count(*) FROM ordered) - 100"""

ORACLE["batch_assign"] = f"""WITH {KEYS}
SELECT account, mailbox, uid,
  ((row_number() OVER (PARTITION BY account, mailbox ORDER BY uid) - 1) // 200)::BIGINT AS batch_no FROM keys"""

ORACLE["parse_messages"] = f"""WITH {DOCS}
SELECT account, mailbox, uid, message_id, subject, date_iso, from_addr, "to", cc, size, labels, thread_id FROM docs"""

ORACLE["body_select"] = f"WITH {DOCS} SELECT account, mailbox, uid, body FROM docs"

ORACLE["attachment_names"] = f"WITH {DOCS} SELECT account, mailbox, uid, attachments FROM docs"

ORACLE["address_format"] = f'WITH {DOCS} SELECT account, mailbox, uid, from_addr, "to", cc FROM docs'

ORACLE["date_iso"] = f"WITH {DOCS} SELECT account, mailbox, uid, date_iso FROM docs"

ORACLE["html_to_text"] = f"SELECT page_id, {HTML_TEXT} AS text FROM pages"

ORACLE["front_matter"] = f"WITH {DOCS} SELECT account, mailbox, uid, {_FRONT_MATTER} AS front_matter FROM docs"

ORACLE["json_fence_repair"] = f"""WITH {FF_RESP}, {FF_REPAIRED}
SELECT account, mailbox, uid, response, repaired, valid_json FROM results"""

ORACLE["news_items"] = f"""WITH {FF_RESP}, {FF_REPAIRED}, {FF_ITEMS}
SELECT account, mailbox, uid, pos, title, url, summary, date, sender FROM items"""

ORACLE["batch_extract"] = f"""WITH {STUB}
SELECT account, mailbox, uid, s.attempt_no::BIGINT AS attempt_no,
  CASE s.kind WHEN 'answer' THEN answer WHEN 'fenced' THEN '```json' || {NL} || answer || {NL} || '```'
       ELSE s.kind END AS response,
  s.error
FROM cls JOIN spat s ON cls.c = s.c"""

_RULE = f"""lk AS (
  SELECT 'desk' AS account, 'INBOX' AS mailbox, page_id::BIGINT AS uid,
    regexp_extract_all(html, {_ANCHOR}, 1, 'is') AS urls,
    regexp_extract_all(html, {_ANCHOR}, 2, 'is') AS titles,
    'news@' || {HOST} AS sender
  FROM pages WHERE page_id <> 0),
rule AS (
  SELECT account, mailbox, uid, i::BIGINT AS pos, {_stripped(_decoded(_tags_to_text('titles[i]')))} AS title,
    {_decoded('urls[i]')} AS url, '' AS summary,
    '2026-12-01 17:02' AS date, sender
  FROM (SELECT *, generate_subscripts(urls, 1) AS i FROM lk))"""

ORACLE["rule_extract"] = f"WITH {_RULE} SELECT account, mailbox, uid, pos, title, url, summary, date, sender FROM rule"

ORACLE["ingest_stream"] = f"WITH {DOCS} SELECT account, mailbox, uid, subject FROM docs"

ORACLE["two_stage_stream"] = ORACLE["rule_extract"]

ORACLE["run_once"] = f"""WITH {DOCS}
SELECT account, mailbox, count(*)::BIGINT AS n_docs, max(uid)::BIGINT AS max_uid FROM docs GROUP BY account, mailbox"""

# The fixture stream lands uid % 3 = 0, 1, 2 and then arrival 0 again: each
# round logs the documents it parsed and extracted (valid messages only; the
# re-landing adds none); the rule extractor fails on none of them.
ORACLE["bad_file_isolation"] = f"""WITH {DOCS}
SELECT 'document' AS kind, account, mailbox, uid, subject FROM docs
UNION ALL SELECT 'failure', NULL, NULL, NULL, 'part-unreadable.parquet'"""
ORACLE["round_log"] = f"""WITH {KEYS},
c AS (SELECT uid % 3 AS r, count(*) AS n FROM keys WHERE uid <> 0 GROUP BY uid % 3)
SELECT r::BIGINT AS round, stage, 0::INTEGER AS exit_code, n::BIGINT AS rows
FROM (SELECT * FROM c UNION ALL SELECT 3, 0) c, (VALUES ('ingest'), ('extract')) s(stage)"""

# The stub answers prompt classes 0, 1 and 5; the prompt holds the whole document.
ORACLE["model_stream"] = f"""WITH {DOCS},
prompts AS (
  SELECT account, mailbox, uid, md5({_sql_str(PROMPT_TEXT)} || {NL} || {NL} || '---' || {NL} || {_FRONT_MATTER} || {NL} ||
    '---' || {NL} || body) AS h FROM docs),
cls AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % 6 AS c FROM prompts)
SELECT account, mailbox, uid, '[{{"title": "item ' || substr(h, 1, 8) || '", "url": "https://n.example/' || substr(h, 9, 8) ||
  '", "summary": "' || substr(h, 17, 8) || '", "date": "", "sender": ""}}]' AS response
FROM cls WHERE c IN (0, 1, 5)"""
