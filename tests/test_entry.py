"""The catalogue against DuckDB on the smallest tables, and the contract of the entry module."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from collatio.catalog.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted(repr([plain(r[i]) for i in order]) for r in values)


def same(spark, oracle, name, query, sql):
    df = query(spark, SF)
    answer = oracle.execute(sql)
    assert sorted(df.columns) == sorted(c[0] for c in answer.description), name
    assert rows(df.columns, df.collect()) == rows([c[0] for c in answer.description], answer.fetchall()), name


@pytest.mark.parametrize("name", sorted(SQL))
def test_catalogue_equals_sql(spark, oracle, name):
    same(spark, oracle, name, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


def test_rest_works_without_the_training_data_part(tmp_path):
    """What the driver deletes may be missing: everything else must import."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "collatio"), tmp_path / "collatio", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
