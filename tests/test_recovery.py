"""Runs killed between any two steps, and what recovery makes of them; tables in folders of their own."""

import os
from datetime import date
from urllib.parse import unquote, urlparse

import pytest

from fieldnorm import POS_SPECS, FieldSpec, PublishError, normalize, publish_swap, recover, refresh_backup, run_job, stage_verified
from fieldnorm.plans import publish
from fieldnorm.registered.raw_views import raw_pos_partitioned
from fieldnorm.sources import WorkTableError, catalog

DAY = date(2026, 1, 31)
DATED = "_bak_20260131"
STEPS = ("create_empty_like", "append_rows", "mark", "unmark", "rename", "drop")


class Killed(BaseException):
    """The end of the process: no handler of the library catches it."""


@pytest.fixture
def table(spark, database):
    rows = raw_pos_partitioned(spark, "/root/testdata/sf0.001").where("k < 40")
    rows.write.partitionBy("PLACE").saveAsTable(f"{database}.card_rows")
    return f"{database}.card_rows"


def contents(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(map(tuple, spark.table(table).collect()), key=repr)


def beside(spark, table):
    database, base = table.split(".")
    found = spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").collect()
    return {row.tableName[len(base) :] for row in found if row.tableName.startswith(base)}


def kill_after(monkeypatch, number):
    """Kill the run after its step of this number; returns what counts the steps."""
    done = []
    for name in STEPS:

        def step(*args, _real=getattr(catalog, name), _name=name, **kw):
            done.append(_name)
            out = _real(*args, **kw)
            if len(done) == number:
                raise Killed
            return out

        monkeypatch.setattr(catalog, name, step)
    return done


@pytest.mark.parametrize(("own_folders", "number"), [(False, 1), (True, 8)])
def test_killed_after_every_step(spark, table, monkeypatch, own_folders, number):
    """One table goes through kills after every step of a run that also replaces an earlier backup.

    In folders of their own only the kills from the stage on, where these matter.
    """
    raw = contents(spark, table)
    expected = sorted(map(tuple, normalize(spark.table(table), POS_SPECS, untrimmed=["PLACE"]).collect()), key=repr)
    refresh_backup(spark, table, DAY, own_folder=own_folders)
    outcomes = []
    while True:
        with monkeypatch.context() as patch:
            done = kill_after(patch, number)
            try:
                run_job(spark, table, POS_SPECS, dry_run=False, run_date=DAY, own_folders=own_folders)
                break  # no such step any more
            except Killed:
                pass
        ended = recover(spark, table, POS_SPECS)
        last = not ended.steps and number > 8  # killed after its last step, the run is complete
        assert not last or done[-1] == "unmark"
        ended.published |= last
        outcomes.append((done[-1], ended.published))
        assert beside(spark, table) == {"", DATED}
        assert contents(spark, table) == (expected if ended.published else raw)
        assert contents(spark, table + DATED) == raw
        assert catalog.marks(spark, table).keys() <= {"folder"} and recover(spark, table, POS_SPECS).steps == []
        if ended.published:  # back to the raw rows for the next kill
            catalog.drop(spark, table)
            catalog.create_empty_like(spark, table + DATED, table, own_folder=own_folders)
            catalog.append_rows(spark.table(table + DATED), table)
        number += 1
    assert contents(spark, table) == expected
    published = [x for _, x in outcomes]
    # Undone up to the verified stage, finished from there on.
    assert published == sorted(published) and True in published and False in published
    assert own_folders or {name for name, _ in outcomes} == set(STEPS)


def test_recovery_may_be_killed_too(spark, table, monkeypatch):
    expected = sorted(map(tuple, normalize(spark.table(table), POS_SPECS, untrimmed=["PLACE"]).collect()), key=repr)
    stage = stage_verified(spark, normalize(spark.table(table), POS_SPECS, untrimmed=["PLACE"]), table, POS_SPECS, 40)
    catalog.rename(spark, table, f"{table}_SWAP_OLD")
    number = 1
    while True:
        with monkeypatch.context() as patch:
            kill_after(patch, number)
            try:
                recover(spark, table, POS_SPECS)
                break
            except Killed:
                number += 1
    assert number > 2 and contents(spark, table) == expected and beside(spark, table) == {""} and stage.endswith("_CVT_TMP")


def test_an_unverified_stage_is_not_published(spark, table):
    raw = contents(spark, table)
    catalog.create_empty_like(spark, table, f"{table}_CVT_TMP")
    catalog.rename(spark, table, f"{table}_SWAP_OLD")
    assert not recover(spark, table, POS_SPECS).published
    assert contents(spark, table) == raw and beside(spark, table) == {""}


def test_a_verified_stage_is_dropped_if_the_table_changed(spark, table):
    notes = {"replaces": publish.fingerprint_of(spark.table(table)).digest(), "in_place": True}
    stage_verified(spark, normalize(spark.table(table), POS_SPECS), table, POS_SPECS, 40, notes=notes)
    spark.sql(f"INSERT INTO {table} (k) VALUES (777)")
    raw = contents(spark, table)
    ended = recover(spark, table, POS_SPECS)
    assert not ended.published and "dropped" in ended.steps[0] and contents(spark, table) == raw


def test_new_rows_that_fail_their_check_are_taken_back(spark, table):
    raw = contents(spark, table)
    stage = stage_verified(spark, normalize(spark.table(table), POS_SPECS), table, POS_SPECS, 40)
    catalog.mark(spark, stage, rows=41)
    catalog.rename(spark, table, f"{table}_SWAP_OLD")
    with pytest.raises(PublishError, match="40 rows instead of 41.*restored"):
        recover(spark, table, POS_SPECS)
    assert contents(spark, table) == raw and not recover(spark, table, POS_SPECS).published
    assert beside(spark, table) == {""}


def test_what_no_run_leaves_is_refused(spark, table):
    with pytest.raises(ValueError, match="nothing to recover"):
        recover(spark, f"{table}_none", POS_SPECS)
    spark.sql(f"CREATE TABLE {table}_SWAP_OLD (x INT) USING parquet")
    with pytest.raises(WorkTableError, match="inspect both"):
        recover(spark, table, POS_SPECS)
    assert beside(spark, table) == {"", "_swap_old"}
    spark.sql(f"DROP TABLE {table}_SWAP_OLD")
    spark.sql(f"CREATE TABLE {table}_BAK_OLD (x INT) USING parquet")
    with pytest.raises(WorkTableError, match="run_date"):
        recover(spark, table, POS_SPECS)
    assert recover(spark, table, POS_SPECS, DAY).steps and beside(spark, table) == {"", DATED}


def test_a_short_backup_is_set_aside(spark, table):
    refresh_backup(spark, table, DAY)
    raw = contents(spark, table + DATED)
    catalog.rename(spark, table + DATED, f"{table}_BAK_OLD")
    catalog.create_empty_like(spark, table, table + DATED)
    recover(spark, table, POS_SPECS)
    assert beside(spark, table) == {"", DATED, "_bak_bad"} and contents(spark, table + DATED) == raw


def files(spark, table):
    return set(spark.table(table).inputFiles())


def test_swaps_in_own_folders_move_no_files(spark, table, monkeypatch):
    statements, real = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **kw: (statements.append(text), real(text, *a, **kw))[1])
    expected = sorted(map(tuple, normalize(spark.table(table), POS_SPECS, untrimmed=["PLACE"]).collect()), key=repr)
    for run in range(2):
        refresh_backup(spark, table, DAY, own_folder=True)
        stage = stage_verified(spark, normalize(spark.table(table), POS_SPECS, untrimmed=["PLACE"]), table, POS_SPECS, 40, own_folder=True)
        before, partitions = files(spark, stage), spark.sql(f"SHOW PARTITIONS {stage}").collect()
        old_files = files(spark, table)
        statements.clear()
        publish_swap(spark, table, stage, POS_SPECS, 40)
        assert files(spark, table) == before and spark.sql(f"SHOW PARTITIONS {table}").collect() == partitions
        assert contents(spark, table) == expected and beside(spark, table) == {"", DATED}
        assert old_files and not any(os.path.exists(unquote(urlparse(path).path)) for path in old_files)
        recovered = sum("RECOVER PARTITIONS" in text for text in statements)
        assert recovered == (run == 0)  # only the first old table was managed
        # The raw rows come back from the backup; the table keeps its own folder.
        backup = spark.table(table + DATED)
        catalog.drop(spark, table)
        catalog.create_empty_like(spark, table + DATED, table, own_folder=True)
        catalog.append_rows(backup, table)


def test_own_folders_keep_what_others_hold(spark, database, tmp_path):
    """An external table of the user keeps its files when it is replaced."""
    spark.sql(f"CREATE TABLE {database}.ext (d STRING) USING parquet LOCATION '{tmp_path}/ext'")
    spark.sql(f"INSERT INTO {database}.ext VALUES ('251231')")
    run_job(spark, f"{database}.ext", [FieldSpec("d", "DATE")], dry_run=False, run_date=DAY, own_folders=True)
    assert spark.table(f"{database}.ext").first().d == "31_12-2025"
    assert spark.read.parquet(f"{tmp_path}/ext").first().d == "251231"


def test_a_table_whose_name_says_restored(spark, database, monkeypatch):
    name = f"{database}.restored_rows"
    spark.sql(f"CREATE TABLE {name} (d STRING) USING parquet")
    spark.sql(f"INSERT INTO {name} VALUES ('251231')")
    stage = stage_verified(spark, normalize(spark.table(name), [FieldSpec("d", "DATE")]), name, [FieldSpec("d", "DATE")], 1)
    real, counts = catalog.rename, iter([1, 0])

    def refuse(session, table, new_name):
        if table == stage:
            raise OSError("rename refused")
        real(session, table, new_name)

    monkeypatch.setattr(catalog, "rename", refuse)
    monkeypatch.setattr(publish, "_visible_rows", lambda *args: next(counts))
    with pytest.raises(PublishError, match="shows 0 of 1 rows"):
        publish_swap(spark, name, stage, [FieldSpec("d", "DATE")], 1)


def test_a_rename_back_that_half_fails(spark, table, monkeypatch):
    """The name is back although the rename reported an error: rows are counted all the same."""
    stage = stage_verified(spark, normalize(spark.table(table), POS_SPECS), table, POS_SPECS, 40)
    real = catalog.rename

    def refuse(session, name, new_name):
        if name == stage:
            raise OSError("rename refused")
        real(session, name, new_name)
        if name.endswith("_SWAP_OLD"):
            raise OSError("partitions not found")

    monkeypatch.setattr(catalog, "rename", refuse)
    with pytest.raises(OSError, match="rename refused"):
        publish_swap(spark, table, stage, POS_SPECS, 40)
    assert len(contents(spark, table)) == 40
