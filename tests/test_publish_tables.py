"""Publishing tables with wide structs, partitions, qualified names; values lost to null."""

from datetime import date

import pytest

from fieldnorm import POS_SPECS, FieldSpec, PublishError, normalize, run_job, stage_verified
from fieldnorm.operators import filled, quality_pass
from fieldnorm.plans import publish
from fieldnorm.session import HUGE_METHOD_LIMIT
from fieldnorm.sources import WorkTableError, catalog, schema_profile

DAY = date(2026, 1, 31)
SPECS = [FieldSpec("D", "DATE")]
PLACES = ["a b", " a ", "10:00", None, "2"]


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=repr)


def tables_beside(spark, table):
    found = spark.sql(f"SHOW TABLES IN {table.split('.')[0]}").where("not isTemporary").collect()
    return {row.tableName for row in found}


@pytest.fixture
def wide(spark, database):
    def make(name, last):
        fields = ", ".join(f"f{k}: INT" for k in range(29))
        spark.sql(f"CREATE TABLE {database}.{name} (D STRING, S STRUCT<{fields}, `last one`: {last}>) USING parquet")
        return f"{database}.{name}"

    return make


@pytest.fixture
def placed(spark, database):
    """A table partitioned by a text column whose values are written escaped in paths."""
    table = f"{database}.placed"
    rows = [(k, "251231", place) for k, place in enumerate(PLACES)]
    spark.createDataFrame(rows, "k int, D string, P string").write.partitionBy("P").saveAsTable(table)
    return table


def test_types_of_wide_structs_are_whole(spark, wide):
    one, other = wide("one", "INT"), wide("other", "STRING")
    assert not catalog.same_schema(spark, one, other)
    assert "f28" in catalog.columns_of(spark, one)[1].data_type
    assert "f28" in schema_profile(spark, one).where("column_name = 'S'").first().data_type


def test_a_table_with_a_wide_struct_is_published(spark, wide):
    table = wide("one", "STRING")
    values = ", ".join(map(str, range(29)))
    spark.sql(f"INSERT INTO {table} SELECT '251231', struct({values}, 'x')")
    out = run_job(spark, table, SPECS, dry_run=False, run_date=DAY).first()
    assert out.D == "31_12-2025" and out.S["f28"] == 28 and out.S["last one"] == "x"
    assert catalog.columns_of(spark, table)[1] == catalog.columns_of(spark, f"{table}_BAK_20260131")[1]


def test_partitions_with_escaped_values(spark, placed):
    raw = rows_of(spark, placed)
    for _ in range(2):  # the second run replaces the first one's backup
        run_job(spark, placed, SPECS, dry_run=False, run_date=DAY)
        assert rows_of(spark, placed) == sorted(((k, "31_12-2025", place) for k, place in enumerate(PLACES)), key=repr)
        assert rows_of(spark, f"{placed}_BAK_20260131") == raw
        spark.sql(f"INSERT OVERWRITE {placed} SELECT * FROM {placed}_BAK_20260131")
        spark.catalog.refreshTable(placed)


def test_mapped_partition_column(spark, database):
    table = f"{database}.by_day"
    rows = [(1, "2025-12-31 10:00:00"), (2, "2025-01-02"), (3, None)]
    spark.createDataFrame(rows, "k int, D string").write.partitionBy("D").saveAsTable(table)
    run_job(spark, table, SPECS, dry_run=False, run_date=DAY)
    assert rows_of(spark, table) == [(1, "31_12-2025"), (2, "02_01-2025"), (3, None)]


@pytest.mark.parametrize("calls", range(4))
def test_every_row_is_there_after_a_failed_count(spark, placed, monkeypatch, calls):
    raw, real, count = rows_of(spark, placed), publish.row_count, iter(range(100))
    monkeypatch.setattr(publish, "row_count", lambda *args: real(*args) + (next(count) == calls))
    if calls < 3:
        with pytest.raises(PublishError) as error:
            run_job(spark, placed, SPECS, dry_run=False, run_date=DAY)
        assert "untouched" in str(error.value) or "restored" in str(error.value) or "kept as" in str(error.value)
        assert rows_of(spark, placed) == raw
    else:
        run_job(spark, placed, SPECS, dry_run=False, run_date=DAY)


def test_restored_is_said_only_of_whole_tables(spark, placed, monkeypatch):
    real = catalog.require_text_columns

    def refuse(session, table, widths):
        real(session, table, widths)
        if table == placed:
            monkeypatch.setattr(publish, "_visible_rows", lambda *args: 3)
            raise OSError("catalog lost")

    monkeypatch.setattr(catalog, "require_text_columns", refuse)
    with pytest.raises(PublishError, match="shows 3 of 5 rows"):
        run_job(spark, placed, SPECS, dry_run=False, run_date=DAY)


def test_values_lost_to_null_are_refused(spark, placed):
    raw = spark.table(placed)
    report = quality_pass(raw, SPECS).first()
    broken = raw.selectExpr("k", "if(k = 1, '251399', D) AS D", "P")
    with pytest.raises(PublishError, match="FILLED_D.*5, 4"):
        stage_verified(spark, normalize(broken, SPECS), placed, SPECS, 5, filled(report))


def test_session_catalog_name(spark, placed):
    run_job(spark, f"spark_catalog.{placed}", SPECS, dry_run=False, run_date=DAY)
    assert spark.table(placed).where("D = '31_12-2025'").count() == 5
    assert tables_beside(spark, placed) == {"placed", "placed_bak_20260131"}


def test_other_catalogs_are_refused_before_writing(spark, placed):
    with pytest.raises(ValueError, match="catalog other"):
        run_job(spark, spark.table(placed), SPECS, target=f"other.{placed}", dry_run=False)
    assert tables_beside(spark, placed) == {"placed"}


def test_crash_between_the_renames_is_named(spark, placed):
    catalog.rename(spark, placed, f"{placed}_SWAP_OLD")
    with pytest.raises(WorkTableError, match="_SWAP_OLD"):
        run_job(spark, placed, SPECS, dry_run=False, run_date=DAY)


def test_the_session_is_as_it_was(spark, placed):
    before = spark.conf.get(HUGE_METHOD_LIMIT)
    run_job(spark, placed, SPECS)
    assert spark.conf.get(HUGE_METHOD_LIMIT) == before
    with pytest.raises(ValueError):
        run_job(spark, placed, POS_SPECS)
    assert spark.conf.get(HUGE_METHOD_LIMIT) == before
