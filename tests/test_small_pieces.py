"""Python stages hold small pieces of their batches, whatever a batch's size."""

import pyarrow as pa

from mailweave.functions import mime
from mailweave.functions.batches import PIECE_BYTES, PIECE_ROWS, pieces
from mailweave.functions.frontmatter import _render_udf
from mailweave.functions.markdown import _markdown_udf
from mailweave.operators import extract as ex


def raw_batch(bodies):
    n = len(bodies)
    raw = [None if b is None else b"Subject: s%d\r\nContent-Type: text/plain\r\n\r\n%s" % (i, b) for i, b in enumerate(bodies)]
    return pa.RecordBatch.from_pydict({
        "account": ["a"] * n, "mailbox": ["m"] * n, "uid": pa.array(range(1, n + 1), pa.int64()), "raw": pa.array(raw, pa.binary()),
        "size": pa.array([1] * n, pa.int64()), "labels": pa.array([None] * n, pa.list_(pa.string())), "thread_id": pa.array([None] * n, pa.string())})


def test_pieces_are_bounded_and_whole():
    batch = raw_batch([b"x" * (PIECE_BYTES // 4)] * 9 + [None] + [b"y" * (3 * PIECE_BYTES)] + [b"z"] * (2 * PIECE_ROWS))
    got = list(pieces(batch, "raw"))
    assert [u for p in got for u in p.column("uid").to_pylist()] == list(range(1, batch.num_rows + 1))
    assert all(p.num_rows <= PIECE_ROWS for p in got)
    assert all(p.num_rows == 1 or sum(len(r or b"") for r in p.column("raw").to_pylist()) <= PIECE_BYTES for p in got)
    assert list(pieces(batch.slice(0, 0), "raw")) == []


def test_a_large_batch_is_parsed_in_pieces():
    out = list(mime.parse_batches(iter([raw_batch([b"x"] * 1000 + [None])])))
    assert max(b.num_rows for b in out) <= PIECE_ROWS
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["uid"] for r in rows] == list(range(1, 1002)) and rows[999]["subject"] == "s999"
    assert [r["uid"] for r in rows if r["parse_error"]] == [1001]


def test_row_udfs_take_no_arrow_batches():
    from pyspark.util import PythonEvalType
    for f in (_markdown_udf, _render_udf):
        assert f.evalType == PythonEvalType.SQL_BATCHED_UDF


def test_prompts_are_taken_in_pieces(spark):
    """The attempts of a long batch come out in pieces, in the prompts' order, a null key included."""
    from pyspark.sql import functions as F
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    try:
        rows = spark.range(0, 2000, 1, 1).select(F.lit("a").alias("account"), F.lit("m").alias("mailbox"),
                                                 F.when(F.col("id") != 7, F.col("id")).alias("uid"), F.col("id").cast("string").alias("prompt"))
        att = ex.batch_extract(rows, lambda p: p, wait_s=0.0).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    assert [r.response for r in att] == [str(i) for i in range(2000)]
    assert [r.uid for r in att] == [None if i == 7 else i for i in range(2000)]
