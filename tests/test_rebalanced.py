"""Writes rebalanced by partition: few files for each, also where one partition holds most rows."""

from datetime import date
from urllib.parse import unquote

import pytest

from fieldnorm import FieldSpec, PublishError, refresh_backup, run_job
from fieldnorm.operators.fingerprint import fingerprint_of
from fieldnorm.plans import publish
from fieldnorm.sources import catalog

DAY = date(2026, 1, 31)
SPECS = [FieldSpec("D", "DATE")]
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PLACES = ["hot", "a b", None, "x/y", "5"]


@pytest.fixture
def rows(spark):
    """20,000 rows in 16 tasks that each hold all places; nine of ten rows are of one place."""
    place = "CASE WHEN id % 10 < 9 THEN 'hot' " + " ".join(f"WHEN id % 50 = {9 + 10 * k} THEN {'NULL' if p is None else repr(p)}" for k, p in enumerate(PLACES)) + " END"
    return spark.range(0, 20000, 1, 16).selectExpr("id AS k", "'251231' AS D", "sha2(string(id), 512) AS note", f"{place} AS P")


@pytest.fixture
def table(spark, database, rows):
    rows.where("k % 2 = 0").coalesce(1).write.partitionBy("P").saveAsTable(f"{database}.placed")
    return f"{database}.placed"


@pytest.fixture
def small_parts(spark):
    """Small pieces, and so many shuffle partitions that no place shares one with the hot place."""
    settings = {ADVISORY: "200KB", "spark.sql.shuffle.partitions": "97"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def files_by_place(spark, table):
    out = {}
    for file in spark.table(table).inputFiles():
        value = unquote(unquote(file)).split("P=", 1)[1].rsplit("/", 1)[0]
        out.setdefault(value, []).append(file)
    return {value: len(files) for value, files in out.items()}


def test_hot_partition_is_split_and_small_ones_are_merged(spark, table, rows, small_parts):
    out = run_job(spark, rows, SPECS, target=table, dry_run=False, run_date=DAY, rebalance=True)
    assert out.count() == 20000 and out.where("D <> '31_12-2025'").count() == 0
    assert sorted(map(tuple, out.select("k", "note", "P").collect())) == sorted(map(tuple, rows.select("k", "note", "P").collect()))
    files = files_by_place(spark, table)
    assert len(files) == 5 and files["hot"] > 3
    assert all(n <= 2 for value, n in files.items() if value != "hot")
    # Without it each of the 16 tasks writes a file into each partition.
    stage = run_job(spark, rows, SPECS, target=table, dry_run=False, run_date=date(2026, 2, 1))
    assert stage.count() == 20000 and set(files_by_place(spark, table).values()) == {16}


def test_content_is_verified(spark, table, rows, monkeypatch):
    real = catalog.append_rows

    def loses_a_value(df, name):
        """Another note is written than was handed over, which the fingerprint of the write shows."""
        if name.endswith("_CVT_TMP"):
            given = fingerprint_of(df)
            real(df.selectExpr("k", "D", "IF(k = 7, 'other', note) AS note", "P"), name)
            return given
        return real(df, name)

    monkeypatch.setattr(publish.catalog, "append_rows", loses_a_value)
    with pytest.raises(PublishError, match="other content"):
        run_job(spark, rows, SPECS, target=table, dry_run=False, run_date=DAY, rebalance=True)
    assert spark.table(table).count() == 10000


def test_empty_and_unpartitioned_tables(spark, database):
    spark.sql(f"CREATE TABLE {database}.none (D STRING, P STRING) USING parquet PARTITIONED BY (P)")
    assert run_job(spark, f"{database}.none", SPECS, dry_run=False, run_date=DAY, rebalance=True).count() == 0
    spark.sql(f"CREATE TABLE {database}.plain USING parquet AS SELECT '251231' AS D, id FROM range(0, 100, 1, 10)")
    backup = refresh_backup(spark, f"{database}.plain", DAY, rebalance=True)
    assert spark.table(backup).count() == 100 and len(spark.table(backup).inputFiles()) == 1
