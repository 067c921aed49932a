"""Registered queries against their DuckDB SQL, on small tables."""

import os

import duckdb
import pytest

from ridelake.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_query_equals_its_sql(spark, name):
    fn, sql = REGISTRY[name]
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in fn(spark, SF).select(names).collect())


def test_every_operator_has_its_query():
    names = list(REGISTRY)
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
