"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = dict(entry.all_queries.RUNS), dict(entry.all_queries.SQL)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_only_additive_forecasts_lack_sql():
    assert set(SQL) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(SQL)) == [
        "j01_additive_forecast",
        "l11_created_forecast",
        "l12_closed_forecast",
    ]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    got = rows_of(frame.columns, frame.collect())
    if name not in SQL:
        assert got
        return
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry_is_the_spike_report(spark):
    assert entry.entry(spark).columns == ["model_id", "day", "daily_discussions", "rolling_avg", "spike_ratio"]
