"""Every registered query against its DuckDB oracle (or a rows check) at sf0.001."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
from scripts.check_oracle import digest

from __spark_entry__ import entry, oracle_sql, queries
from mailweave.plans.queries import REGISTRY

NAMES = sorted(REGISTRY)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    assert all(t in ("string", "bigint", "int", "boolean", "double") for _, t in df.dtypes), df.dtypes
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    h1, l1 = digest(cols, rows)
    h2, l2 = digest(ocols, orows)
    assert h1 == h2, (sorted(set(l1) - set(l2))[:2], sorted(set(l2) - set(l1))[:2])


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["account", "mailbox", "uid", "pos", "title", "url", "summary", "date", "sender"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    assert set(REGISTRY) <= set(queries())
    assert set(REGISTRY) - set(oracle_sql()) == {"html_to_markdown", "front_matter_yaml"}


def test_entry_without_the_training_data_operators(tmp_path):
    """The rest of the library and its queries do not need that subpackage."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "mailweave", tmp_path / "mailweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"], cwd=tmp_path,
                         env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == NAMES
