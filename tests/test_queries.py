"""Every registered query of the engine against its SQL in DuckDB on the smallest tables."""

import importlib.util

import duckdb
import pytest

from admitflow.plans import document_queries, more_queries, rule_queries, stream_queries  # noqa: F401
from admitflow.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return round(float(value), 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in at) for r in cur.fetchall()), key=repr)
    assert got == expected


def test_entry_registers_everything():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if importlib.util.find_spec("admitflow.llm") is None:
        assert not any(n.startswith("op") and n[2:3].isdigit() for n in entry.queries())
