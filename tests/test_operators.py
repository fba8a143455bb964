"""Operators against brute force on small fixtures (skew, ordering, state,
attempt folds, JSON repair)."""

import json
import random

from pyspark.sql import functions as F

from mailweave.functions import text
from mailweave.operators import extract as ex
from mailweave.operators import ingest as ig
from mailweave.operators import numbering as nb
from mailweave.operators import state as st


def test_rank_in_group_skewed_matches_row_number(spark):
    rnd = random.Random(7)
    hot = rnd.sample(range(1, 200_000), 3000)          # one mailbox with most rows, sparse uids
    rows = [("a", "hot", u) for u in hot] + [("a", f"m{i}", u) for i in range(30) for u in rnd.sample(range(1, 500), 5)]
    df = spark.createDataFrame(rows, "account string, mailbox string, uid bigint")
    got = {(r.mailbox, r.uid): r["rank"] for r in nb.rank_in_group(df, ["account", "mailbox"], "uid", bits=6).collect()}
    want = {}
    for mb in {r[1] for r in rows}:
        for i, u in enumerate(sorted(r[2] for r in rows if r[1] == mb), start=1):
            want[(mb, u)] = i
    assert got == want
    newest = nb.newest_n(df, 10, ["account", "mailbox"]).where("mailbox = 'hot'").collect()
    assert sorted(r.uid for r in newest) == sorted(hot)[-10:]
    b = {r.uid: r.batch_no for r in nb.batch_assign(df.where("mailbox = 'hot'"), 200, ["account", "mailbox"],
                                                    ).collect()}
    assert all(b[u] == i // 200 for i, u in enumerate(sorted(hot)))


def test_pending_order_brute_force(spark):
    import datetime as dt
    ids = ["10", "9", "007", "7", "abc", "n1", "x", "0", "123456789012345678901234567890123456789012"]
    mt = [dt.datetime(2026, 1, 1, 0, 0, i) for i in range(len(ids))]
    mt[4] = None
    rows = list(zip(ids, mt))
    df = spark.createDataFrame(rows, "id string, mtime timestamp")
    got = [r.id for r in ex.pending_order(df, num_partitions=3).orderBy("pos").collect()]

    def key(item):
        i, m = item
        if i.isascii() and i.isdigit():
            return (0, int(i), "", i)
        return (1, float("inf") if m is None else m.timestamp(), "", i)
    want = [i for i, _ in sorted(rows, key=key)]
    assert got == want


def test_state_load_edge_values(spark):
    docs = spark.createDataFrame([
        (1, '{"u:INBOX": 5, "u:a:b": "7", "u:c": 2.9, "u:d": true}'),
        (2, '{"u:INBOX": 5, "u:x": null}'),
        (3, '[1, 2]'),
        (4, 'not json'),
        (5, '{"u:INBOX": "1_000", "u:y": -3.7}'),
        (6, '{"u:z": {"a": 1}}'),
    ], "id int, text string")
    got = sorted((r.id, r.account, r.mailbox, r.last_uid) for r in st.load_json(docs, "id").collect())
    assert got == [(1, "u", "INBOX", 5), (1, "u", "a:b", 7), (1, "u", "c", 2), (1, "u", "d", 1),
                   (5, "u", "INBOX", 1000), (5, "u", "y", -3)]


def test_state_advance_never_goes_down(spark):
    state = spark.createDataFrame([("a", "m", 100), ("a", "n", 5)], "account string, mailbox string, last_uid bigint")
    seen = spark.createDataFrame([("a", "m", 7), ("a", "n", 9), ("b", "m", 1)], "account string, mailbox string, uid bigint")
    got = sorted(tuple(r) for r in st.advance(state, seen).collect())
    assert got == [("a", "m", 100), ("a", "n", 9), ("b", "m", 1)]
    js = st.to_json_by_account(st.advance(state, seen)).where("account = 'a'").first().state_json
    assert json.loads(js) == {"a:m": 100, "a:n": 9}


def _fold_py(seq, cap=3):
    """Brute-force attempt fold."""
    last = None
    for n, resp, err in seq:
        if n > cap:
            break
        if resp:
            return "ok", n, resp, None
        if err and ("data_inspection_failed" in err or "inappropriate content" in err.lower()):
            return "blocked", n, None, err
        last = (n, err or "empty response")
    return "failed", last[0], None, last[1]


def test_attempt_fold_brute_force(spark):
    rnd = random.Random(3)
    choices = [("ok", None), ("", None), (None, "boom"), (None, "data_inspection_failed x"),
               (None, "INAPPROPRIATE CONTENT"), (None, "Data_Inspection_Failed")]
    rows, want = [], {}
    for uid in range(1, 300):
        seq = [(n, *rnd.choice(choices)) for n in range(1, rnd.randint(1, 5) + 1)]
        seq = [(n, (f"r{uid}" if r == "ok" else r), e) for n, r, e in seq]
        rows += [("a", "m", uid, n, r, e) for n, r, e in seq]
        want[uid] = _fold_py(seq)
    df = spark.createDataFrame(rows, "account string, mailbox string, uid bigint, attempt_no int, "
                                     "response string, error string")
    got = {r.uid: (r.outcome, r.attempt_no, r.response, r.error) for r in ex.attempt_outcome(df).collect()}
    assert got == want


def test_fence_repair_brute_force(spark):
    samples = ['[{"a": 1}]', '```json\n[{"a": 1}]\n```', '  ```\n[1, 2]```', '```\n] x [\n```',
               '```json\n{"a": [1]}\n```', 'prose [1]', '[1] trailing', 'NaN', '```[1,]```',
               '\t```json\n[{"t": "é"}]\n```\n', '{"a": 1}', '```\n[[1], [2]]\n``` and [3]']
    df = spark.createDataFrame([("a", "m", i, s, "ok") for i, s in enumerate(samples)],
                               "account string, mailbox string, uid bigint, response string, outcome string")
    got = {r.uid: (r.response, r.repaired, r.valid_json) for r in ex.repair(df).collect()}
    slices = {1: '[{"a": 1}]', 2: "[1, 2]", 4: "[1]", 9: '[{"t": "é"}]', 11: "[[1], [2]]\n``` and [3]"}
    valid = {0, 1, 2, 4, 7, 9, 10}
    slices.pop(11)                                   # from the first to the last bracket: no JSON
    assert got == {i: (slices.get(i, s), i in slices, i in valid) for i, s in enumerate(samples)}
    items = ex.news_items(ex.repair(df)).collect()
    assert {r.uid for r in items} == {0, 1, 9}       # lists only; the lone object yields nothing


def test_stub_model_blocked_and_retry(spark):
    prompts = spark.createDataFrame([("a", "m", i, f"prompt {i}") for i in range(60)],
                                    "account string, mailbox string, uid bigint, prompt string")
    att = ex.batch_extract(prompts, ex.StubModel(), wait_s=0.0)
    out = {r.uid: r for r in ex.attempt_outcome(att).collect()}
    model = ex.StubModel()
    for i in range(60):
        cls = int(model.digest(f"prompt {i}")[:8], 16) % 6
        expect = {0: "ok", 1: "ok", 2: "blocked", 3: "failed", 4: "blocked", 5: "ok"}[cls]
        assert out[i].outcome == expect
        if cls == 3:
            assert out[i].attempt_no == 3 and out[i].error == "upstream error 3"


def test_html_to_text_matches_python_chain(spark):
    pages = ["<p>a &amp;amp; b</p><script>x</script>", "<STYLE>s</STYLE>t<br/>u", "&eacute;&#233;&#xe9;&hellip",
             "  <b>x</b>  ", "<p>1</p  ><p>2</p>"]

    want = ["a &amp; b", "t\nu", "ééé&hellip", "x", "1\n\n2"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, html string")
    got = {r.id: r.t for r in df.select("id", text.html_to_text(F.col("html")).alias("t")).collect()}
    assert got == dict(enumerate(want))


def test_dedupe_by_key_keeps_one_row_per_key(spark):
    from mailweave.operators.joins import dedupe_by_key
    rows = [("a", "m", u, f"body{u}") for u in range(50)] + [("a", "m", 7, "body7"), ("a", "m", 7, "body7"),
                                                            ("b", "x", 1, "once")]
    df = spark.createDataFrame(rows, "account string, mailbox string, uid bigint, raw string")
    got = sorted(tuple(r) for r in dedupe_by_key(df, ["account", "mailbox", "uid"]).collect())
    assert got == sorted(set(rows))


def test_bounded_broadcast_falls_back_beyond_bound(spark):
    from mailweave.operators.joins import BROADCAST_MAX_ROWS_CONF, anti_join_recent
    big = spark.range(0, 50).selectExpr("'a' as account", "'m' as mailbox", "id as uid")
    probe = spark.range(40, 60).selectExpr("'a' as account", "'m' as mailbox", "id as uid")
    want = sorted(range(50, 60))
    spark.conf.set(BROADCAST_MAX_ROWS_CONF, "0")          # nothing may be broadcast
    try:
        got = sorted(r.uid for r in anti_join_recent(probe, big, ["account", "mailbox", "uid"]).collect())
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_CONF)
    assert got == want
    assert sorted(r.uid for r in anti_join_recent(probe, big, ["account", "mailbox", "uid"]).collect()) == want


KEYED = "account string, mailbox string, uid bigint"


def _keyed(spark, values, col):
    return spark.createDataFrame([("a", "m", i, v) for i, v in enumerate(values)], f"{KEYED}, {col} string")


def test_deeply_nested_response_is_not_valid(spark):
    df = _keyed(spark, ["[" * 200_000, "[1]"], "response").withColumn("outcome", F.lit("ok"))
    assert {r.uid: r.valid_json for r in ex.repair(df).collect()} == {0: False, 1: True}


def test_items_of_mixed_lists(spark):
    df = _keyed(spark, ['[{"title":"t1"},"note",{"title":"t2","url":"u"},null,7]', "[]", '{"title":"lone"}'], "response")
    df = df.withColumn("valid_json", F.lit(True))
    assert sorted((r.uid, r.pos, r.title, r.url) for r in ex.news_items(df).collect()) == [(0, 1, "t1", None), (0, 3, "t2", "u")]
    assert sorted((r.uid, r.error) for r in ex.unusable_items(df).collect()) == [
        (0, "item 2 is no object"), (0, "item 4 is no object"), (0, "item 5 is no object")]


def test_label_tokens(spark):
    from mailweave.functions import meta
    cases = ['"a b" c', "'it''s' x\\\\ y", '"\\\\Inbox" \\\\Sent', 'open "quote x', '"" z', 'a"b c"d', "t\\", "\\\"q", '"a\\\"b\\c"']
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    import shlex
    got = {r.c: r.t for r in df.select("c", meta.label_tokens(F.col("c")).alias("t")).collect()}
    for c in cases:
        try:
            assert got[c] == [t for t in shlex.split(c) if t], c
        except ValueError:
            assert got[c] == [t.strip("\"'") for t in c.split()], c


def test_label_group_of_a_megabyte(spark):
    from mailweave.functions import meta
    groups = ["x" * 1_000_000, '"a b" ' * 170_000, "\\a" * 300_000]
    df = spark.createDataFrame([(i, f"RFC822.SIZE 99999999999999999999 X-GM-LABELS ({g})") for i, g in enumerate(groups)], "i int, m string")
    got = df.select("i", meta.provider_meta(F.col("m")).alias("p")).select("i", "p.size", F.size("p.labels").alias("n")).collect()
    assert {r.i: (r.size, r.n) for r in got} == {0: (None, 1), 1: (None, 170_000), 2: (None, 1)}


def test_rule_items_of_odd_anchors(spark):
    html = ('<a href="https://x/1?a=1&amp;b=2"><b>t1</b> &hellip;</a><A class=x HREF=\'y&#38;z\'>\n t2 </A>'
            '<a href=bare>t&lt;3</a><a name="n">no target</a><abbr href="q">no anchor</abbr>')
    df = spark.createDataFrame([("a", "m", 1, html, "2026-12-01T10:00:00+01:00", "N <n@x.org>")],
                               f"{KEYED}, html string, date_iso string, from_addr string")
    got = [(r.pos, r.title, r.url, r.date, r.sender) for r in ig.rule_extract(df).orderBy("pos").collect()]
    assert got == [(1, "t1 …", "https://x/1?a=1&b=2", "2026-12-01 10:00", "n@x.org"), (2, "t2", "y&z", "2026-12-01 10:00", "n@x.org"),
                   (3, "t<3", "bare", "2026-12-01 10:00", "n@x.org")]


def test_overflowing_numbers_fall_back(spark):
    from mailweave.sources import tables as tb
    df = spark.createDataFrame([(1, '{"a:b": "99999999999999999999"}'), (2, '{"a:b": 1e30}'), (3, '{"a:b": 5}')], "id int, text string")
    assert [(r.id, r.last_uid) for r in st.load_json(df, "id").collect()] == [(3, 5)]
    files = spark.createDataFrame([("/x/99999999999999999999.eml", bytearray(b"x"), 1)], "path string, content binary, length bigint")
    assert tb.eml_records(files, "a", "m").first().uid == 0


def test_links_follow_the_structure_of_the_page(spark):
    """Expected links written from the pages' structure, not from a pattern."""
    pages = [
        ("""<script>var a = "<a href='s'>no</a>";</script><!-- <a href="c">no</a> --><a href="x">one</a>""", [("x", "one")]),
        ("""<p><a href="u1">first <a href='u2'>se<b>con</b>d</a> tail <a name=n>none</a> <a\nclass="q>" href=u3 >t3</a>""",
         [("u1", "first"), ("u2", "second"), ("u3", "t3")]),
        ("""a < b <a href="e?a=1&amp;b=2">&lt;x&gt;</a> <abbr href="no">z</abbr></a><a href=""></a>""", [("e?a=1&b=2", "<x>"), ("", "")]),
        ("""<a href="last">open <!-- x --> end""", [("last", "open  end")]),
        ("""<style>a{content:"<a href=q>"}</style><A HREF="U">up</A >""", [("U", "up")]),
        ("""<!-- unclosed <a href="x">y</a>""", []), ("", []), (None, [])]
    df = spark.createDataFrame([(k, p, "2026-12-01T17:02:00+08:00", "n <n@x.org>") for k, (p, _) in enumerate(pages)],
                               "k int, html string, date_iso string, from_addr string")
    from pyspark.sql import functions as F

    from mailweave.operators import ingest as ig
    got = df.select("k", ig.rule_item_array(F.col("html"), F.col("date_iso"), F.col("from_addr")).alias("items")).collect()
    assert {r.k: [(i.url, i.title) for i in r["items"]] for r in got} == {k: want for k, (_, want) in enumerate(pages)}


def test_calls_in_flight_are_bounded_and_ended(spark, tmp_path):
    """Never more than ``concurrency`` calls at once, also after calls that ran
    into the limit; those are really ended; rows keep the prompts' order."""
    import os
    import time

    from mailweave.operators import extract as ex
    folder = str(tmp_path)

    def model(prompt):
        me = f"{folder}/{prompt}-{time.time()}"
        open(me + ".on", "w").close()
        now = len([f for f in os.listdir(folder) if f.endswith(".on")])
        open(f"{folder}/seen-{now}", "w").close()
        if int(prompt) % 4 == 0:
            time.sleep(30)
            open(f"{folder}/late", "w").close()
        time.sleep(0.05)
        os.rename(me + ".on", me + ".off")
        return "[]"
    prompts = spark.createDataFrame([("a", "m", k, str(k)) for k in range(12)], "account string, mailbox string, uid bigint, prompt string")
    t0 = time.time()
    rows = ex.batch_extract(prompts.coalesce(1), model, max_attempts=2, wait_s=0.0, concurrency=4, calls_per_task=4, timeout_s=0.6).collect()
    assert time.time() - t0 < 25
    assert {r.uid: r.response for r in rows if r.attempt_no == 1} == {k: None if k % 4 == 0 else "[]" for k in range(12)}
    assert {r.error for r in rows if r.uid % 4 == 0} == {"no answer within 0.6 s"} and len(rows) == 15
    # marks of ended calls stay: at most the calls in flight and those left by the six that were ended
    ended = len([f for f in os.listdir(folder) if f.endswith(".on")])
    assert ended == 6 and not os.path.exists(f"{folder}/late")
    assert max(int(f[5:]) for f in os.listdir(folder) if f.startswith("seen-")) <= 4 + ended
    order = [r.uid for r in rows]
    assert order == sorted(order)


def test_a_model_that_dies_is_an_error(spark):
    import os

    from mailweave.operators import extract as ex
    prompts = spark.createDataFrame([("a", "m", 1, "p")], "account string, mailbox string, uid bigint, prompt string")
    rows = ex.batch_extract(prompts, lambda p: os._exit(3), max_attempts=1, timeout_s=5.0).collect()
    assert [(r.response, r.error) for r in rows] == [(None, "the model's process ended without an answer")]


def test_state_files(spark):
    import json
    import os

    from mailweave.operators import state as st
    from mailweave.session import scratch_path

    from .conftest import local
    folder = scratch_path(spark, "state")
    marks = lambda path: sorted((r.account, r.mailbox, r.last_uid) for r in st.read_state_files(spark, path).collect())
    assert marks(folder) == marks(folder + "/none.json") == []
    state = spark.createDataFrame([("a", "m", 5), ("a", "n:x", 7), ("b/c", "m", 9)], "account string, mailbox string, last_uid bigint")
    assert st.write_state_files(state, folder).count() == 2
    assert marks(folder) == [("a", "m", 5), ("a", "n:x", 7), ("b/c", "m", 9)]
    st.write_state_files(state.withColumn("last_uid", state.last_uid + 1), folder)            # replaced as a whole
    assert marks(folder) == [("a", "m", 6), ("a", "n:x", 8), ("b/c", "m", 10)]
    for name, content in (("list", "[1]"), ("word", "no JSON"), ("bad", json.dumps({"x:y": 1, "z:z": "one"})), ("empty", ""), ("nil", "null")):
        with open(f"{local(folder)}/{name}.json", "w") as f:
            f.write(content)
        assert marks(f"{folder}/{name}.json") == []
    with open(f"{local(folder)}/old.json", "w") as f:
        f.write(json.dumps({"a:m": "4", "d:e": 2.9, "f:g": True}))
    assert marks(folder) == [("a", "m", 6), ("a", "n:x", 8), ("b/c", "m", 10), ("d", "e", 2), ("f", "g", 1)]
    assert not [n for n in os.listdir(local(folder)) if n.endswith(".part")]
