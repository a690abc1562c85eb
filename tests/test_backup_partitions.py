"""Backups refreshed by partition: which partitions are copied, and that contents decide."""

from datetime import date

import pytest

from fieldnorm.operators import compare_groups
from fieldnorm.plans import PublishError, partitions, recover, refresh_backup_partitions
from fieldnorm.session import dynamic_overwrite
from fieldnorm.sources import catalog
from fieldnorm.spec import FieldSpec

DAY = date(2026, 1, 31)
PLACES = ["a b", " a ", "10:00", None, "x/y", "%41", "it's", "ü"]


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=repr)


@pytest.fixture
def placed(spark, database):
    table = f"{database}.placed"
    rows = [(10 * k + j, f"v{j}", place) for k, place in enumerate(PLACES) for j in range(3)]
    spark.createDataFrame(rows, "k int, D string, P string").write.partitionBy("P").saveAsTable(table)
    return table


def replace_partition(spark, table, rows):
    df = spark.createDataFrame(rows, "k int, D string, P string")
    with dynamic_overwrite(spark):
        df.write.insertInto(table, overwrite=True)


def test_only_changed_partitions_are_copied(spark, placed, monkeypatch):
    assert refresh_backup_partitions(spark, placed, DAY).whole
    backup = f"{placed}_BAK_20260131"
    files = {path for path in spark.table(backup).inputFiles()}
    seen, plain = [], catalog.append_rows

    def watched(df, table):
        seen.append((df.inputFiles(), plain(df, table)))
        return seen[-1][1]

    monkeypatch.setattr(catalog, "append_rows", watched)
    done = refresh_backup_partitions(spark, placed, DAY)
    assert (done.copied, done.dropped, done.kept, done.whole) == (0, 0, 8, False) and not seen
    # One value changes while the number of rows stays.
    replace_partition(spark, placed, [(20, "v0", "10:00"), (21, "other", "10:00"), (22, "v2", "10:00")])
    done = refresh_backup_partitions(spark, placed, DAY)
    assert (done.copied, done.kept) == (1, 7)
    assert seen[0][1].rows == 3
    assert rows_of(spark, backup) == rows_of(spark, placed)
    after = {path for path in spark.table(backup).inputFiles()}
    assert {path for path in files if "/P=10" not in path} < after
    assert catalog.marks(spark, backup)["rows"] == "24"


@pytest.mark.parametrize("place", ["10:00", None, "it's", "%41"])
def test_every_kind_of_value_is_copied_and_dropped(spark, placed, place):
    refresh_backup_partitions(spark, placed, DAY)
    backup = f"{placed}_BAK_20260131"
    replace_partition(spark, placed, [(99, "new", place)])
    assert refresh_backup_partitions(spark, placed, DAY).copied == 1
    assert rows_of(spark, backup) == rows_of(spark, placed)
    literal = "null" if place is None else catalog.text_literal(place)
    spark.sql(f"ALTER TABLE {placed} DROP PARTITION (P = {literal})")
    done = refresh_backup_partitions(spark, placed, DAY)
    assert (done.copied, done.dropped, done.kept) == (0, 1, 7)
    assert rows_of(spark, backup) == rows_of(spark, placed)


def test_many_partitions_in_steps_and_two_keys(spark, database, monkeypatch):
    monkeypatch.setattr(partitions, "STEP", 3)
    table = f"{database}.two"
    df = spark.range(40).selectExpr("id AS k", "id % 4 AS a", "DATE '2026-01-01' + CAST(id % 5 AS INT) AS b")
    df.write.partitionBy("a", "b").saveAsTable(table)
    refresh_backup_partitions(spark, table, DAY)
    spark.sql(f"INSERT OVERWRITE {table} SELECT k + 1, a, b FROM {table}_BAK_20260131 WHERE a < 3")
    spark.catalog.refreshTable(table)
    done = refresh_backup_partitions(spark, table, DAY)
    assert (done.copied, done.dropped) == (15, 5)
    assert rows_of(spark, f"{table}_BAK_20260131") == rows_of(spark, table)


def test_a_copy_that_differs_is_refused_and_recovered(spark, placed, monkeypatch):
    refresh_backup_partitions(spark, placed, DAY)
    before = rows_of(spark, f"{placed}_BAK_20260131")
    replace_partition(spark, placed, [(99, "new", "ü")])
    plain = catalog.append_rows

    def lossy(df, table):
        content = plain(df, table)
        spark.sql(f"INSERT OVERWRITE {table} VALUES (99, 'lost', 'ü')")
        return content

    monkeypatch.setattr(catalog, "append_rows", lossy)
    with pytest.raises(PublishError, match="other content"):
        refresh_backup_partitions(spark, placed, DAY)
    assert rows_of(spark, f"{placed}_BAK_20260131") == before
    monkeypatch.undo()
    with pytest.raises(catalog.WorkTableError):
        refresh_backup_partitions(spark, placed, DAY)
    recover(spark, placed, [FieldSpec("D", "DATE")])
    assert refresh_backup_partitions(spark, placed, DAY).copied == 1
    assert rows_of(spark, f"{placed}_BAK_20260131") == rows_of(spark, placed)


def test_refusals_and_groups(spark, database):
    spark.sql(f"CREATE TABLE {database}.flat (D STRING) USING parquet")
    with pytest.raises(ValueError, match="no partitions"):
        refresh_backup_partitions(spark, f"{database}.flat", DAY)
    one = spark.createDataFrame([(1, "x", None), (2, "y", "p"), (3, "z", "q")], "key_0 int, ROWS string, g string")
    other = spark.createDataFrame([("y", 2, "p"), ("x", 9, None), ("z", 3, "r")], "rows string, key_0 int, G string")
    found = {row.g: tuple(row)[1:] for row in compare_groups(one, other, ["g"]).collect()}
    assert found == {None: (1, 1, False), "p": (1, 1, True), "q": (1, None, False), "r": (None, 1, False)}
    assert compare_groups(one.limit(0), other.limit(0), ["g"]).isEmpty()
    with pytest.raises(ValueError, match="columns differ"):
        compare_groups(one, other.drop("rows"), ["g"])
