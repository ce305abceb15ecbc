"""Every query that has SQL, on sf0.001, against DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = {k: v for k, v in entry.oracle_sql().items() if k != "pipeline" and not k.startswith("op")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return round(x, 9) if isinstance(x, float) else x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, want.fetchall())


def test_every_reference_query_has_sql():
    from corpuskiln.plans import queries

    assert set(queries.QUERIES) == set(queries.ORACLE)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_imports_without_the_corpus_operators(tmp_path):
    """A copy without the llm folders and the pipeline still has the other queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "corpuskiln", tmp_path / "corpuskiln", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'select_by_type' in q and not any(k.startswith('op') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
