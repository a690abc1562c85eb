"""Every registered query against its DuckDB SQL on the given tables."""

import datetime
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from fieldnorm.registered.queries import QUERIES

DATA = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(DATA))
    result = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = Counter(result.fetchall())
    got = Counter(tuple(row) for row in df.select(*names).collect())
    assert got == expected
    assert expected, "the check compares nothing"


def test_entry_is_the_flagship_query(spark):
    df = contract.entry(spark)
    assert df.count() == 1500
    assert df.where("k = 0").first().TRN_BGN_DATE


def test_known_counts(spark):
    rows = contract.queries()["normalize_pos"](spark, str(DATA)).selectExpr(
        "count(*)", "count(TRN_BGN_DATE)", "count(TRN_BGN_TIME)", "count(AMT_1)"
    )
    assert tuple(rows.first()) == (15000, 12500, 12500, 13500)
    dates = contract.queries()["parse_date"](spark, str(DATA)).where("k = 0").first()
    assert dates.begin_date == datetime.date(1998, 10, 3)


def test_dirty_counts(spark):
    report = contract.queries()["source_quality_dirty"](spark, str(DATA)).first().asDict()
    assert {name: count for name, count in report.items() if count} == {
        "BAD_TRN_BGN_DATE": 300,
        "BAD_TRN_BGN_TIME": 300,
        "NO_DATE_TRN_BGN_TIME": 300,
        "BAD_AMT_1": 300,
        "OVERFLOW_AMT_1": 300,
        "BAD_POST_DATE": 150,
    }
