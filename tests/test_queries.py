"""Every registered query against the same question in SQL, on the small tables."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from settleflow.queries import ORACLES, QUERIES

from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def rows_of(names, rows):
    order = [names.index(n) for n in sorted(names)]
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = rows_of(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, result.fetchall())


def test_get_date_reads_a_column(spark):
    made = QUERIES["dat_02_get_date_of_events"](spark, SMALL)
    assert made.count() == spark.read.parquet(f"{SMALL}/events.parquet").count()
    assert made.select("v").distinct().count() > 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_point_offers_every_query():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
