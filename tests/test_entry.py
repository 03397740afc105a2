"""Driver contract: entry() runs, and every query with an oracle matches
DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from roadpulse.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["supplier", "lineitem", "events"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "hour", "avg_speed", "avg_congestion_score"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(x) for x in r) for r in df.select(*cols).collect())
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    want = sorted(tuple(_norm(r[idx[c]]) for c in cols) for r in rel.fetchall())
    assert got == want


def test_import_without_session():
    """The driver may import the contract before any session exists."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]


def test_checkpoint_fallback_only_on_a_local_master():
    from roadpulse.session import is_local_master
    assert is_local_master("local") and is_local_master("local[8]") and is_local_master("local[*]")
    assert is_local_master("local-cluster[2,1,1024]")
    assert not is_local_master("yarn") and not is_local_master("spark://host:7077")
    assert not is_local_master("k8s://https://host:443") and not is_local_master(None)
