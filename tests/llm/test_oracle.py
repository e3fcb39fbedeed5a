"""Queries with SQL against DuckDB; all registered queries over the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from reelmart.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    res = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    have = sorted((tuple(str(r[c]) for c in sorted(columns)) for r in df.collect()))
    want = sorted(tuple(str(r[columns.index(c)]) for c in sorted(columns)) for r in res.fetchall())
    assert have == want


def test_every_operator_is_registered_once():
    numbers = [int(n[2:].split("_")[0]) for n in queries()]
    assert sorted(numbers) == list(range(1, 14))
    assert set(queries()) | {"pipeline"} <= set(E.queries())
