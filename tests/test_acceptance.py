"""Every registered query against its DuckDB SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as driver
from acceptance.oracle import ORACLE
from acceptance.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [
        tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows
    ]
    return sorted(columns), sorted(values, key=str)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = driver.queries()[name](spark, SF)
    result = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in result.description]
    expected = canonical(names, result.fetchall())
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[1]


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


def test_pull_reaches_the_last_entry_of_a_large_store(spark, tmp_path):
    """Entries past the end of 2025, as tables have them that are many times larger."""
    duck = duckdb.connect()
    duck.execute(f"copy (select * replace (event_id + 1315800 as event_id) from '{SF}/events.parquet' limit 300) to '{tmp_path}/events.parquet' (format parquet)")
    duck.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    frame = driver.queries()["pull_range"](spark, str(tmp_path))
    result = duck.execute(driver.oracle_sql()["pull_range"])
    expected = canonical([c[0] for c in result.description], result.fetchall())
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == expected
