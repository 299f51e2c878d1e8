"""Every query with SQL equals DuckDB over the same files; every other one runs."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from sunframe.oracles import ORACLES
from sunframe.queries import QUERIES
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    rows = [r.asDict() for r in df.collect()]
    assert rows
    if name in ORACLES:
        found = duck.execute(ORACLES[name])
        names = [d[0] for d in found.description]
        want = [dict(zip(names, r, strict=True)) for r in found.fetchall()]
        assert sorted(df.columns) == sorted(names)
        key = lambda r: str(sorted(r.items()))
        assert sorted(rows, key=key) == sorted(want, key=key)


def test_entry_and_names(spark):
    assert driver.entry(spark).count() == 10
    assert set(driver.oracle_sql()) <= set(driver.queries())
    without = set(QUERIES) - set(ORACLES)
    assert without == {"loss_history", "rf_forecast", "svr_forecast", "cnn_forecast", "lstm_forecast", "cnn_lstm_forecast"}
