"""Fingerprints of content, and copies that are refused because of it."""

import decimal
from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldnorm import POS_SPECS, FieldSpec, PublishError, compare, fingerprint, normalize, refresh_backup, run_job, stage_verified
from fieldnorm.operators import Fingerprint, fingerprint_of
from fieldnorm.operators.fingerprint import observed
from fieldnorm.registered.raw_views import raw_pos
from fieldnorm.sources import catalog

DAY = date(2026, 1, 31)


@pytest.fixture(scope="module")
def rows(spark):
    return raw_pos(spark, "/root/testdata/sf0.001")


@pytest.fixture
def table(spark, database, rows):
    rows.where("k < 100").write.saveAsTable(f"{database}.card_rows")
    return f"{database}.card_rows"


def changed(df, where, **values):
    return df.withColumns({name: F.when(F.expr(where), F.lit(value)).otherwise(F.col(name)) for name, value in values.items()})


def test_order_and_layout_do_not_matter(spark, rows):
    once = fingerprint_of(rows)
    assert once == fingerprint_of(rows.repartition(7).sortWithinPartitions(F.rand(3)))
    assert once.rows == 1500 and set(once.columns) == {"ROW", *(name.upper() for name in rows.columns)}
    assert once.digest() == fingerprint_of(rows.orderBy(F.desc("k"))).digest()


@pytest.mark.parametrize(
    ("where", "values", "names"),
    [
        ("k = 7", {"AMT_2": "70"}, ["AMT_2"]),
        ("k = 7", {"NOTE": None}, ["NOTE"]),
        ("k = 17", {"TRN_BGN_DATE": ""}, ["TRN_BGN_DATE"]),
        ("k in (3, 4)", {"AMT_2": "x", "NOTE": "y"}, ["AMT_2", "NOTE"]),
    ],
)
def test_changed_values_are_seen(rows, where, values, names):
    assert fingerprint_of(rows).differences(fingerprint_of(changed(rows, where, **values))) == names


def test_values_that_trade_places(rows):
    traded = rows.withColumn("AMT_2", F.expr("CASE k WHEN 7 THEN '8' WHEN 8 THEN '7' ELSE AMT_2 END"))
    assert fingerprint_of(rows).differences(fingerprint_of(traded)) == ["ROW"]


def test_an_even_number_of_equal_changes(spark):
    twice = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    other = spark.createDataFrame([("c",), ("c",), ("b",)], "x string")
    one, two = fingerprint_of(twice), fingerprint_of(other)
    assert one.columns["X"][0] == two.columns["X"][0] and one.differences(two) == ["X"]  # only the sums tell


def test_nulls_in_other_columns(spark):
    schema = "a int, b int"
    one, two = (spark.createDataFrame(x, schema) for x in ([(None, 1), (1, None)], [(None, None), (1, 1)]))
    assert fingerprint_of(one).differences(fingerprint_of(two)) == ["ROW"]


def test_every_type_has_a_fingerprint(spark):
    df = spark.sql(
        "SELECT 1 AS i, 1.5D AS d, decimal('1.20') AS n, date'2026-01-31' AS t, timestamp'2026-01-31 10:00:00' AS s, x'00ff' AS y, "
        "map('a', 1) AS m, array(map(1, struct('q'))) AS deep, struct(1 AS u, null AS v) AS st, true AS o, parse_json('{\"a\":1}') AS va, `c d` FROM VALUES ('e') AS v(`c d`)"
    )
    assert fingerprint_of(df).differences(fingerprint_of(df.withColumn("m", F.expr("map('a', 2)")))) == ["M"]
    assert fingerprint_of(df).differences(fingerprint_of(df.withColumn("n", F.lit(decimal.Decimal("1.21"))))) == ["N"]


def test_no_rows(spark, rows):
    none = fingerprint_of(rows.where("k < 0"))
    assert none == fingerprint_of(spark.createDataFrame([], rows.schema)) and none.rows == 0
    for empty in (rows.where("k < 0"), rows.where("false"), spark.createDataFrame([], rows.schema)):
        seen, found = observed(empty)
        seen.write.format("noop").mode("overwrite").save()
        assert found() == none


def test_reports(spark, rows):
    lanes = {x.column_name: x for x in fingerprint(rows).collect()}
    assert set(lanes) == {"ROW", *rows.columns} and {x.rows for x in lanes.values()} == {1500}
    both = {x.column_name: (x.source_rows, x.target_rows, x.matched) for x in compare(rows, changed(rows, "k = 1", NOTE="z").drop("AMT_1")).collect()}
    assert both["AMT_2"] == (1500, 1500, True) and both["NOTE"] == (1500, 1500, False)
    assert both["AMT_1"] == (1500, None, False) and both["ROW"][2] is False
    assert Fingerprint(1, {"A": (1, 1)}).differences(Fingerprint(1, {"B": (1, 1)})) == ["A", "B"]


def altered_write(monkeypatch, where, end, column="AMT_2", value="9"):
    """Writes to tables whose name has this end store another value than they are given."""
    real = catalog.append_rows

    def write(df, table):
        given = real(df, table)
        if table.endswith(end):
            spark, other = df.sparkSession, f"{table}_other"
            changed(spark.table(table), where, **{column: value}).write.saveAsTable(other)
            spark.sql(f"INSERT OVERWRITE {table} SELECT * FROM {other}")
            spark.sql(f"DROP TABLE {other}")
        return given

    monkeypatch.setattr(catalog, "append_rows", write)


def test_a_backup_with_one_other_value_is_refused(spark, table, monkeypatch):
    altered_write(monkeypatch, "k = 7", "_BAK_TMP")
    with pytest.raises(PublishError, match="other content than was read from .*, in AMT_2.*untouched"):
        refresh_backup(spark, table, DAY)
    assert spark.catalog.tableExists(f"{table}_BAK_TMP") and not spark.catalog.tableExists(f"{table}_BAK_20260131")


def test_a_stage_with_one_other_value_is_refused(spark, table, monkeypatch):
    altered_write(monkeypatch, "k = 7", "_CVT_TMP", "AMT_2", "0.09")
    raw = spark.table(table)
    with pytest.raises(PublishError, match="other content than was written, in AMT_2"):
        stage_verified(spark, normalize(raw, POS_SPECS), table, POS_SPECS, 100)


def test_a_source_that_changes_between_the_scans_is_refused(spark, table, monkeypatch):
    before = sorted(map(tuple, spark.table(table).collect()))
    real = catalog.mark

    def mark_and_change(session, name, **notes):
        real(session, name, **notes)
        if name.endswith("_BAK_TMP"):  # the backup is verified; now one value changes
            changed(session.table(table), "k = 8", NOTE="later").write.saveAsTable(f"{table}_x")
            session.sql(f"INSERT OVERWRITE {table} SELECT * FROM {table}_x")

    monkeypatch.setattr(catalog, "mark", mark_and_change)
    with pytest.raises(PublishError, match="changed between backup and conversion, in NOTE"):
        run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    assert sorted(map(tuple, spark.table(f"{table}_BAK_20260131").collect())) == before


def test_char_columns_and_other_types_of_a_source(spark, database):
    name = f"{database}.chars"
    spark.sql(f"CREATE TABLE {name} (k BIGINT, c CHAR(6), v VARCHAR(8), d STRING, n DECIMAL(10,2)) USING parquet")
    fresh = spark.sql("SELECT 1 AS k, 'ab' AS c, 'x ' AS v, '251231' AS d, 5 AS n UNION ALL SELECT 2, null, '', null, null")
    out = run_job(spark, fresh, [FieldSpec("d", "DATE")], target=name, dry_run=False, run_date=DAY)
    assert sorted(map(tuple, out.collect()))[0][:4] == (1, "ab    ", "x", "31_12-2025")
    refresh_backup(spark, name, DAY)


def test_an_empty_table_is_published(spark, table):
    spark.sql(f"TRUNCATE TABLE {table}")
    assert run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY).count() == 0
