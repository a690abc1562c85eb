"""Publishing: clean runs, refusals, and what is left after each kind of failure."""

from datetime import date

import pytest

from fieldnorm import (
    POS_SPECS,
    FieldSpec,
    PublishError,
    QualityError,
    normalize,
    publish_swap,
    refresh_backup,
    run_job,
    stage_verified,
)
from fieldnorm.plans import publish
from fieldnorm.registered.raw_views import raw_pos
from fieldnorm.sources import WorkTableError, catalog, schema_profile

DAY = date(2026, 1, 31)
DATED = "_BAK_20260131"


@pytest.fixture
def table(spark, database):
    name = f"{database}.card_rows"
    rows = raw_pos(spark, "/root/testdata/sf0.001").where("k < 100")
    columns = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "NOTE")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, NOTE VARCHAR(40) COMMENT 'it''s free text', "
        "INS_DATE DATE DEFAULT current_date()) USING parquet TBLPROPERTIES ('purpose' = 'ops')"
    )
    rows.createOrReplaceTempView("rows_to_load")
    spark.sql(f"INSERT INTO {name} ({', '.join(rows.columns)}) SELECT * FROM rows_to_load")
    return name


def contents(spark, table):
    return sorted(map(tuple, spark.table(table).collect()))


def tables(spark, table):
    """Suffixes of the tables beside (and including) the given one."""
    database, base = table.split(".")
    return {row.tableName[len(base) :].upper() for row in spark.sql(f"SHOW TABLES IN {database}").collect() if not row.isTemporary}


def declared(spark, table):
    return {c.column_name: c.data_type for c in catalog.columns_of(spark, table)}


def failing_after(monkeypatch, name, calls, result=None):
    """Let ``publish.name`` work ``calls`` times and then return ``result`` or raise."""
    real = getattr(publish, name)
    count = iter(range(1000))

    def wrapped(*args):
        if next(count) < calls:
            return real(*args)
        if isinstance(result, Exception):
            raise result
        return result

    monkeypatch.setattr(publish, name, wrapped)


def failing_rename(monkeypatch, old_end, new_end):
    real = catalog.rename

    def wrapped(spark, table, new_name):
        if table.endswith(old_end) and new_name.endswith(new_end):
            raise OSError("rename refused")
        real(spark, table, new_name)

    monkeypatch.setattr(catalog, "rename", wrapped)


def test_publish(spark, table):
    raw = contents(spark, table)
    expected = sorted(map(tuple, normalize(spark.table(table), POS_SPECS).collect()))
    out = run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    assert sorted(map(tuple, out.collect())) == expected == contents(spark, table)
    assert tables(spark, table) == {"", DATED}
    assert contents(spark, table + DATED) == raw
    types = declared(spark, table)
    assert (types["TRN_BGN_DATE"], types["TRN_BGN_TIME"], types["AMT_1"]) == ("varchar(10)", "varchar(19)", "varchar(21)")
    assert (types["NOTE"], types["INS_DATE"], types["k"]) == ("varchar(40)", "date", "bigint")
    spark.sql(f"INSERT INTO {table} (k) VALUES (-1)")
    assert spark.table(table).where("k = -1").first().INS_DATE is not None
    assert [r.comment for r in spark.sql(f"DESCRIBE {table}").collect() if r.col_name == "NOTE"] == ["it's free text"]
    assert spark.sql(f"SHOW TBLPROPERTIES {table} ('purpose')").first().value == "ops"


def test_second_run_refreshes_the_backup(spark, table):
    run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet AS SELECT * FROM {table}{DATED} WHERE k < 50")
    run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    assert tables(spark, table) == {"", DATED}
    assert spark.table(table).count() == spark.table(table + DATED).count() == 50


def test_dry_run_changes_nothing(spark, table):
    raw = contents(spark, table)
    assert run_job(spark, table, POS_SPECS, preview_key="k").count() == 20
    assert contents(spark, table) == raw and tables(spark, table) == {""}


def test_bad_source_changes_nothing(spark, table):
    spark.sql(f"INSERT INTO {table} (k, AMT_1) VALUES (500, '12a')")
    for dry_run in (True, False):
        with pytest.raises(QualityError) as error:
            run_job(spark, table, POS_SPECS, dry_run=dry_run)
        assert error.value.counts == {"BAD_AMT_1": 1, "OVERFLOW_AMT_1": 1}
    assert tables(spark, table) == {""}


@pytest.mark.parametrize("suffix", ["_CVT_TMP", "_SWAP_OLD", "_BAK_TMP", "_BAK_OLD"])
def test_leftover_work_tables_are_refused(spark, table, suffix):
    spark.sql(f"CREATE TABLE {table}{suffix} (x INT) USING parquet")
    raw = contents(spark, table)
    with pytest.raises(WorkTableError, match=suffix):
        run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    assert contents(spark, table) == raw and tables(spark, table) == {"", suffix}


def test_failed_first_backup_check(spark, table, monkeypatch):
    raw = contents(spark, table)
    failing_after(monkeypatch, "row_count", 0, 99)
    with pytest.raises(PublishError, match="99 rows instead of 100.*untouched"):
        run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    assert contents(spark, table) == raw and tables(spark, table) == {"", "_BAK_TMP"}


def test_backup_with_other_columns(spark, table, monkeypatch):
    monkeypatch.setattr(catalog, "same_schema", lambda *args: False)
    with pytest.raises(PublishError, match="columns"):
        refresh_backup(spark, table, DAY)
    assert tables(spark, table) == {"", "_BAK_TMP"}


@pytest.mark.parametrize("result", [99, OSError("no answer")], ids=["mismatch", "exception"])
@pytest.mark.parametrize("earlier", [True, False])
@pytest.mark.parametrize("bad_taken", [True, False])
def test_failed_second_backup_check(spark, table, monkeypatch, result, earlier, bad_taken):
    kept = "_BAK_BAD"
    expected = {"", "_BAK_BAD"}
    if bad_taken:
        spark.sql(f"CREATE TABLE {table}_BAK_BAD (x INT) USING parquet")
        kept = "_BAK_BAD_2"
        expected |= {kept}
    if earlier:
        refresh_backup(spark, table, DAY)
        expected |= {DATED}
    before = contents(spark, table)
    spark.sql(f"INSERT INTO {table} (k) VALUES (777)")
    failing_after(monkeypatch, "row_count", 1, result)
    with pytest.raises(PublishError, match=kept):
        refresh_backup(spark, table, DAY)
    assert tables(spark, table) == expected
    assert len(contents(spark, table + kept)) == 101
    if earlier:
        assert contents(spark, table + DATED) == before


def test_failed_backup_rename(spark, table, monkeypatch):
    refresh_backup(spark, table, DAY)
    before = contents(spark, table + DATED)
    failing_rename(monkeypatch, "_BAK_TMP", DATED)
    with pytest.raises(OSError):
        refresh_backup(spark, table, DAY)
    assert tables(spark, table) == {"", DATED, "_BAK_TMP"}
    assert contents(spark, table + DATED) == before


def test_stage_with_missing_rows(spark, table):
    raw = contents(spark, table)
    converted = normalize(spark.table(table), POS_SPECS)
    with pytest.raises(PublishError, match="99 rows instead of 100"):
        stage_verified(spark, converted.where("k > 0"), table, POS_SPECS, 100)
    assert contents(spark, table) == raw and tables(spark, table) == {"", "_CVT_TMP"}


def test_stage_with_raw_values(spark, table):
    with pytest.raises(QualityError, match="_CVT_TMP"):
        stage_verified(spark, spark.table(table).selectExpr("*").where("k % 6 != 3"), table, POS_SPECS, 83)


def test_stage_enforces_the_width(spark, table):
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        stage_verified(spark, spark.table(table), table, POS_SPECS, 100)


def test_failed_second_swap_rename(spark, table, monkeypatch):
    raw = contents(spark, table)
    stage = stage_verified(spark, normalize(spark.table(table), POS_SPECS), table, POS_SPECS, 100)
    failing_rename(monkeypatch, "_CVT_TMP", "card_rows")
    with pytest.raises(OSError):
        publish_swap(spark, table, stage, POS_SPECS, 100)
    assert contents(spark, table) == raw and tables(spark, table) == {"", "_CVT_TMP"}


@pytest.mark.parametrize("result", [99, OSError("no answer")], ids=["mismatch", "exception"])
def test_failed_check_after_the_swap(spark, table, monkeypatch, result):
    raw = contents(spark, table)
    failing_after(monkeypatch, "row_count", 2, result)
    with pytest.raises(PublishError, match="restored"):
        run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    assert contents(spark, table) == raw
    assert tables(spark, table) == {"", "_CVT_TMP", DATED}
    assert len(contents(spark, table + "_CVT_TMP")) == 100


def test_old_table_that_cannot_be_dropped_is_a_warning(spark, table, monkeypatch):
    def refuse(*args):
        raise OSError("drop refused")

    monkeypatch.setattr(catalog, "drop", refuse)
    with pytest.warns(UserWarning, match="_SWAP_OLD"):
        run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY)
    assert tables(spark, table) == {"", "_SWAP_OLD", DATED}


def test_other_source_for_a_target(spark, table):
    fresh = spark.table(table).where("k < 10")
    out = run_job(spark, fresh, POS_SPECS, target=table, dry_run=False, run_date=DAY)
    assert out.count() == 10
    assert spark.table(table + DATED).count() == 100
    with pytest.raises(ValueError, match="needs a target"):
        run_job(spark, fresh, POS_SPECS, dry_run=False)


def test_partitions_and_buckets_are_kept(spark, database):
    name = f"{database}.parted"
    spark.sql(
        f"CREATE TABLE {name} (k BIGINT, d STRING, n DECIMAL(12,2), p STRING) USING parquet "
        "PARTITIONED BY (p) CLUSTERED BY (k) SORTED BY (k) INTO 4 BUCKETS"
    )
    spark.sql(f"INSERT INTO {name} SELECT id, IF(id % 2 = 0, '000000', '250131'), 5, id % 3 FROM range(30)")
    run_job(spark, name, [FieldSpec("d", "DATE"), FieldSpec("n", "AMOUNT")], dry_run=False, run_date=DAY)
    columns = {c.name: c for c in spark.catalog.listColumns(name)}
    assert columns["p"].isPartition and columns["k"].isBucket
    assert declared(spark, name) == {"k": "bigint", "d": "varchar(10)", "n": "varchar(21)", "p": "string"}
    assert spark.table(name).where("d = '31_01-2025'").count() == 15
    assert spark.table(name).where("d IS NULL").count() == 15
    assert spark.table(name + DATED).where("d = '000000'").count() == 15


def test_views_and_odd_names_are_refused(spark, table):
    spark.sql(f"CREATE VIEW {table}_view AS SELECT * FROM {table}")
    with pytest.raises(ValueError, match="not a table"):
        refresh_backup(spark, f"{table}_view", DAY)
    with pytest.raises(ValueError, match="plain table name"):
        refresh_backup(spark, f"{table}; DROP TABLE x", DAY)


def test_profile(spark, table):
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (fee DECIMAL(9,3), code CHAR(4))")
    rows = {row.column_name: tuple(row)[1:] for row in schema_profile(spark, table).collect()}
    assert rows["k"] == (1, "bigint", None, None, None)
    assert rows["NOTE"] == (9, "varchar(40)", 40, None, None)
    assert rows["fee"] == (11, "decimal(9,3)", None, 9, 3)
    assert rows["code"] == (12, "char(4)", 4, None, None)


def test_width_gate(spark, table):
    with pytest.raises(ValueError, match="AMT_1.*string instead of varchar\\(21\\)"):
        catalog.require_text_columns(spark, table, {"AMT_1": 21})
    with pytest.raises(ValueError, match="varchar\\(40\\) instead of varchar\\(41\\)"):
        catalog.require_text_columns(spark, table, {"note": 41})
    with pytest.raises(ValueError, match="missing"):
        catalog.require_text_columns(spark, table, {"nowhere": 1})
    catalog.require_text_columns(spark, table, {"note": 40})
