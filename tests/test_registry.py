"""The driver contract: entry() smoke run, and every SQL-checked query against
DuckDB on the sf0.001 tables (the driver repeats this at sf0.01)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tabforge.sources.tables import TABLES

from .conftest import SF001


def _digest(columns, rows):
    def norm(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(round(v, 6) + 0.0)
        return str(int(v)) if isinstance(v, bool) else str(v)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["kind", "part", "n", "predicted_1", "accuracy", "avg_acct"]
    assert df.count() > 0


def test_every_sql_query_has_a_builder():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) >= 50


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


@pytest.mark.parametrize("name", ["q_gram_models", "q_model_impute", "q_nb", "q_tree"])
def test_rows_only_queries_keep_one_row_per_key(spark, name):
    df = entry.queries()[name](spark, SF001)
    key = df.columns[0]
    assert df.count() == df.select(key).distinct().count() or name == "q_model_impute"
