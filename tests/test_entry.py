"""The driver's contract: names, schemas, and equality with SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v)[:19] if hasattr(v, "isoformat") else v


def same_as_sql(spark, name, query, sql):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df = query(spark, SF)
    cols = sorted(df.columns)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols, name
    at = [names.index(c) for c in cols]
    ours = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert ours == theirs, name


def test_core_queries_equal_their_sql(spark):
    queries, sql = entry._core()
    assert set(sql) <= set(queries)
    for name in sql:
        same_as_sql(spark, name, queries[name], sql[name])


def test_names_need_no_session():
    """The names can be listed where no Spark runs."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["doc_id", "severity", "sent_run", "phrase_run", "worst"] and out.count() > 0
