"""Every query that has a SQL twin gives exactly its rows."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry_points  # noqa: E402

TABLES = ("documents", "labels", "embeddings", "conversations", "pages", "benchmark")


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, duck, data_dir, name):
    frame = entry_points.queries()[name](spark, data_dir)
    columns = sorted(frame.columns)
    ours = sorted(repr(tuple(r)) for r in frame.select(*columns).collect())
    cursor = duck.execute(entry_points.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert ours, "no rows"
    assert ours == theirs


def test_every_sql_twin_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
