"""The operators' queries that have SQL, and that every operator has its query."""

import duckdb
import pytest

import __spark_entry__ as entry
from corpuskiln.llm import queries

DATA = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [sum(q.startswith(f"op{n}_") for q in queries.QUERIES) for n in range(1, 14)] == [1] * 13 and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_sql(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r[n] for n in sorted(names)) for r in df.collect()), key=repr) == sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in want.fetchall()), key=repr)
