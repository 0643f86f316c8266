"""Each query against its SQL."""

import os

import duckdb
import pytest

from sparkloom import queries


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, con, name):
    df = queries.QUERIES[name](spark, sf)
    got = sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
    if name in queries.SQL:
        rel = con.execute(queries.SQL[name])
        names = [d[0] for d in rel.description]
        assert sorted(names) == sorted(df.columns)
        assert got == sorted(repr(tuple(x for _, x in sorted(zip(names, r)))) for r in rel.fetchall())
    assert got or name in queries.SQL


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("pipeline", [False, True])
def test_the_rest_works_without_the_subpackage(tmp_path, pipeline):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])))
    code = "import __spark_entry__ as e; n = e.queries(); assert 'canonical_urls' in n and not any(k.startswith('op') for k in n) and 'pipeline' not in n; assert set(e.oracle_sql()) <= set(n)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env={**os.environ, "PYTHONPATH": str(tmp_path / "r")})


def test_pushdown_and_pruning(spark, sf):
    """The scan reads the columns that a query needs, and filters reach it."""
    plan = queries.QUERIES["url_depth"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan.split("ReadSchema")[1]
    plan = queries.QUERIES["include_exclude"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(url,/en/)" in plan.split("PushedFilters")[1] and "html" not in plan.split("ReadSchema")[1]
