"""Even parts and repeatable appends: the statements, run in DuckDB, and the rows handed to Spark's writer.

DuckDB stands for the database here: it lives in this process, so Spark itself cannot reach it.
"""

import random
from datetime import date, datetime

import duckdb
import pytest

from fieldnorm.sources import append_batch, hash_predicates, jdbc
from fieldnorm.sources.jdbc import quantile_predicates, quantile_query, range_predicates, sql_literal, written_keys_query


@pytest.fixture
def database():
    """A skewed column with ties and nulls, a text and a day for each row."""
    r = random.Random(4)
    rows = [(int(r.paretovariate(0.3)) % 10**9, f"it's {k % 97}", date(2026, 1, 1 + k % 28), k - 500) for k in range(2000)]
    rows += [(None, None, None, None)] * 300 + [(5, "x", date(2026, 2, 1), 7)] * 200
    connection = duckdb.connect()
    connection.execute("CREATE TABLE card_rows (n BIGINT, s VARCHAR, d DATE, k BIGINT)")
    connection.executemany("INSERT INTO card_rows VALUES (?, ?, ?, ?)", rows)
    return connection


def parts(database, predicates):
    return [database.execute(f"SELECT count(*) FROM card_rows WHERE {p}").fetchone()[0] for p in predicates]


def firsts(database, column, n):
    return [first for _, first in sorted(database.execute(f"SELECT * FROM {quantile_query('card_rows', column, n)}").fetchall())]


@pytest.mark.parametrize("column", ["n", "s", "d", "k"])
@pytest.mark.parametrize("n", [1, 2, 8, 40])
def test_every_row_is_in_one_part(database, column, n):
    predicates = range_predicates(column, firsts(database, column, n))
    sizes = parts(database, predicates)
    assert sum(sizes) == 2500 and sizes[-1] == 300
    together = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    assert database.execute(f"SELECT min({together}), max({together}) FROM card_rows").fetchone() == (1, 1)


def test_parts_of_a_skewed_column_are_even(database):
    sizes = parts(database, range_predicates("k", firsts(database, "k", 8)))[:-1]
    assert len(sizes) == 8 and max(sizes) < 2 * 2200 / 8
    low, high = database.execute("SELECT min(n), max(n) FROM card_rows").fetchone()
    strides = parts(database, [f"n >= {low + (high - low) * k // 8} AND n < {low + (high - low) * (k + 1) // 8 + k // 7}" for k in range(8)])
    assert max(strides) > 3 * max(parts(database, range_predicates("n", firsts(database, "n", 8)))[:-1])


def test_hash_parts(database):
    sizes = parts(database, hash_predicates("k", 7))
    assert sum(sizes) == 2500 and sizes[-1] == 300 and len(sizes) == 8
    assert sum(parts(database, hash_predicates("hash(s) % 1000", 3))) == 2500
    with pytest.raises(ValueError, match="0 parts"):
        hash_predicates("k", 0)


def test_no_rows_and_odd_bounds(database):
    database.execute("DELETE FROM card_rows")
    assert parts(database, range_predicates("n", firsts(database, "n", 4))) == [0, 0]
    assert sql_literal(datetime(2026, 1, 31, 10, 0, 5)) == "TIMESTAMP '2026-01-31 10:00:05'"
    assert sql_literal("a'b") == "'a''b'"
    with pytest.raises(ValueError, match="cannot bound"):
        sql_literal(b"x")


def test_the_database_is_asked_once(spark, monkeypatch):
    asked = []

    class Reader:
        def option(self, name, value):
            asked.append((name, value))
            return self

        def load(self):
            return self

        def collect(self):
            return [(2, 30), (1, 10), (3, 30)]

    monkeypatch.setattr(jdbc, "_reader", lambda *args: Reader())
    assert quantile_predicates(spark, "jdbc:x", "t", "k", 3) == ["k < 30", "k >= 30", "k IS NULL"]
    assert asked == [("dbtable", quantile_query("t", "k", 3))]


def test_a_batch_is_appended_once(spark, monkeypatch):
    table, asked = [], []

    def read(session, url, query, **kw):
        asked.append(query)
        done = [(k, p) for k, p, _, batch in table if f"'{batch}'" in query]
        return spark.createDataFrame(done, "K long, P string")

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, *args, **kw: table.extend(map(tuple, df.select("K", "P", "V", "BATCH_ID").collect())))
    rows = spark.createDataFrame([(k, "ab"[k % 2], k * 10) for k in range(20)], "K long, P string, V long")
    append_batch(rows.where("K < 8"), "jdbc:x", "t", "run-1", keys=["K", "P"])  # stopped half-way
    append_batch(rows, "jdbc:x", "t", "run-1", keys=["K", "P"])
    append_batch(rows, "jdbc:x", "t", "run-1", keys=["K", "P"])
    assert sorted(table) == [(k, "ab"[k % 2], k * 10, "run-1") for k in range(20)]
    assert set(asked) == {written_keys_query("t", ["K", "P"], "BATCH_ID", "run-1")}
    append_batch(rows, "jdbc:x", "t", "run-2", keys=["K", "P"])  # another batch writes the same keys
    assert len(table) == 40
    with pytest.raises(ValueError, match="needs keys"):
        append_batch(rows, "jdbc:x", "t", "run-3", keys=[])
