import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


def local(path: str) -> str:
    """A scratch path of a local session for Python's own file functions."""
    return path.removeprefix("file:")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8"))
    # tests set their own shared folder only where the cluster names none
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mailweave-test-ckpt-"))
    b.getOrCreate()
    from mailweave.session import build_session
    s = build_session()
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ["pages", "conversations", "documents", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
