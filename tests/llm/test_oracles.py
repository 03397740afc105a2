"""Every query of the subpackage with an oracle matches it on the smallest tables."""

import math

import duckdb
import pytest

from roadpulse.llm import queries

from .conftest import SF

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(x) for x in r) for r in df.select(*cols).collect())
    rel = con.sql(queries.ORACLE[name])
    assert sorted(rel.columns) == cols
    at = {c: i for i, c in enumerate(rel.columns)}
    assert got == sorted(tuple(norm(r[at[c]]) for c in cols) for r in rel.fetchall())


def test_registered_queries():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
