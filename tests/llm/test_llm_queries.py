"""Every registered query of the package runs over the given tables; those with SQL equal it."""

import duckdb
import pytest

from millrace.llm import queries
from tests.test_queries import FOLDER, TABLES, comparable


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    assert got
    if name in queries.ORACLES:
        cursor = duck.execute(queries.ORACLES[name])
        cols = [c[0] for c in cursor.description]
        assert sorted(df.columns) == sorted(cols)
        assert comparable(df.columns, got) == comparable(cols, cursor.fetchall())
    elif name != "op3_decontamination":
        assert sorted(r[0] for r in got) == list(range(len(got)))
