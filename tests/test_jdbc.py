"""JDBC access: which options reach Spark's source. No database is started here."""

from datetime import date
from decimal import Decimal

import pytest

from fieldnorm.sources import jdbc_count, read_jdbc, write_jdbc


class Recorder:
    """Stands in for a Spark reader or writer and notes what it was told."""

    def __init__(self, row=None, loads=None):
        self.told = {}
        self.loads = [] if loads is None else loads
        self.row = row

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def options(self, **values):
        self.told.update(values)
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def load(self):
        self.loads.append(dict(self.told))
        return self

    def save(self):
        self.loads.append(dict(self.told))

    def first(self):
        return self.row

    def jdbc(self, url, table, predicates, properties):
        self.loads.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self

    @property
    def read(self):
        return Recorder(self.row, self.loads)

    write = read


URL = "jdbc:some:url"
LOGIN = {"user": "u", "password": "p", "driver": "d"}


def test_plain_read():
    spark = Recorder()
    read_jdbc(spark, URL, "t", single_task=True, options=LOGIN)
    assert spark.loads == [{**LOGIN, "url": URL, "dbtable": "t", "fetchsize": 1000}]


@pytest.mark.parametrize(
    "bounds, shown",
    [
        ((1, 900), ("1", "900")),
        ((Decimal("1.0000000000"), Decimal("900.5")), ("1", "900")),
        ((date(2025, 1, 1), date(2025, 2, 1)), ("2025-01-01", "2025-02-01")),
    ],
)
def test_partitioned_read(bounds, shown):
    spark = Recorder(row=bounds)
    read_jdbc(spark, URL, "t", partition_column="id", num_partitions=8, fetch_rows=50, options=LOGIN)
    query, read = spark.loads
    assert "MIN(id)" in query["dbtable"] and "MAX(id)" in query["dbtable"] and "FROM t)" in query["dbtable"]
    assert read["dbtable"] == "t" and read["fetchsize"] == 50
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"]) == ("id", *shown)
    assert read["numPartitions"] == 8


def test_partitioned_read_of_an_empty_table():
    spark = Recorder(row=(None, None))
    read_jdbc(spark, URL, "t", partition_column="id", num_partitions=8)
    assert "partitionColumn" not in spark.loads[-1]


def test_read_by_predicates():
    spark = Recorder()
    parts = ["h(id) % 2 = 0", "h(id) % 2 = 1"]
    read_jdbc(spark, URL, "t", predicates=parts, options=LOGIN)
    assert spark.loads == [{**LOGIN, "url": URL, "dbtable": "t", "predicates": parts, "fetchsize": "1000"}]


def test_contradicting_arguments():
    with pytest.raises(ValueError, match="go together"):
        read_jdbc(Recorder(), URL, "t", partition_column="id")
    with pytest.raises(ValueError, match="give one of"):
        read_jdbc(Recorder(), URL, "t")
    with pytest.raises(ValueError, match="give one of"):
        read_jdbc(Recorder(), URL, "t", single_task=True, predicates=["a = 1"])
    with pytest.raises(ValueError, match="give one of"):
        read_jdbc(Recorder(), URL, "t", partition_column="id", num_partitions=2, predicates=["a = 1"])


def test_count_is_left_to_the_database():
    spark = Recorder(row=(Decimal(42),))
    assert jdbc_count(spark, URL, "t", options=LOGIN) == 42
    assert "COUNT(*)" in spark.loads[0]["dbtable"] and spark.loads[0]["user"] == "u"


def test_append():
    df = Recorder()
    write_jdbc(df, URL, "stage", connections=16, options=LOGIN)
    assert df.loads == [
        {**LOGIN, "url": URL, "dbtable": "stage", "numPartitions": 16, "batchsize": 1000, "mode": "append"}
    ]
