"""Backups of partitioned tables that copy only the partitions whose content changed.

Which partitions changed is told by their fingerprints, one aggregate row for each partition
of either side, not by counts, times or names. What changed is copied to the temporary backup
and verified there before it replaces anything, then goes into the dated backup by dynamic
overwrite. Copies are narrow and read the changed partitions alone; the list of those is held
by the driver, as Spark holds the partitions of such a write anyway.

Nothing about progress is remembered: the next refresh compares contents again and copies what
still differs. A killed refresh leaves the temporary backup, which ``recover`` drops.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldnorm.functions.text import column
from fieldnorm.operators.fingerprint import compare_groups
from fieldnorm.plans import names
from fieldnorm.plans.publish import PublishError, copy_mismatch, refresh_backup, row_count
from fieldnorm.session import dynamic_overwrite
from fieldnorm.sources import catalog

#: How many partitions one predicate names; longer lists are copied in several writes.
STEP = 500


@dataclass
class BackupRefresh:
    """Name of the backup, and how many partitions were copied, dropped and left as they were.

    ``whole`` says that all of the table was copied, since there was no backup of that date to compare with.
    """

    name: str
    copied: int = 0
    dropped: int = 0
    kept: int = 0
    whole: bool = False


def _among(partitions: Sequence[Row], keys: Sequence[str]) -> Column:
    """Rows of these partitions; null is a value like others."""

    def one(row: Row) -> Column:
        return reduce(and_, (column(key).isNull() if value is None else column(key) == F.lit(value) for key, value in zip(keys, row, strict=True)))

    parts = [one(row) for row in partitions]
    while len(parts) > 1:  # a balanced tree: Spark walks predicates recursively
        parts = [reduce(or_, pair) for pair in itertools.batched(parts, 2)]
    return parts[0]


def _steps(partitions: Sequence[Row]) -> Iterator[Sequence[Row]]:
    return itertools.batched(partitions, STEP)


def refresh_backup_partitions(spark: SparkSession, table: str, run_date: date) -> BackupRefresh:
    """Bring the backup of ``table`` for ``run_date`` up to date.

    Without one of that date, or with one of other columns or partitioning, all is copied by
    ``refresh_backup``. Otherwise each partition's content in the table and in the backup is
    compared (one scan of each), those that differ are copied and verified, and those the table
    no longer has are dropped from the backup. A table without partitions is refused.
    """
    catalog.require_session_catalog(spark, table)
    keys = catalog.partition_columns(spark, table)
    if not keys:
        raise ValueError(f"{table} has no partitions; use refresh_backup")
    dated, tmp = names.backup_name(table, run_date), names.backup_tmp_name(table)
    catalog.require_absent(spark, [tmp, names.backup_old_name(table)])
    if not catalog.exists(spark, dated) or not catalog.same_schema(spark, dated, table) or catalog.partition_columns(spark, dated) != keys:
        return BackupRefresh(refresh_backup(spark, table, run_date), whole=True)

    found = compare_groups(spark.table(table), spark.table(dated), keys)
    state = F.when(F.col("matched"), "kept").when(F.col("source_rows").isNull(), "dropped").otherwise("copied")
    totals = {row.state: row["count"] for row in found.groupBy(state.alias("state")).count().collect()}
    done = BackupRefresh(dated, totals.get("copied", 0), totals.get("dropped", 0), totals.get("kept", 0))
    differing = found.where(~F.col("matched")).select(*map(column, keys), F.col("source_rows").isNull().alias("gone")).collect() if done.copied or done.dropped else []
    changed = [row[:-1] for row in differing if not row.gone]
    gone = [row[:-1] for row in differing if row.gone]
    if differing:
        # Not whole until all is done: without its mark, recovery does not rely on it.
        catalog.unmark(spark, dated, "rows", "content")
    for step in _steps(changed):
        _copy(spark, table, dated, tmp, keys, step)
    if gone:
        _drop_partitions(spark, dated, keys, gone)
    rows, expected = row_count(spark, dated), row_count(spark, table)
    if rows != expected:
        raise PublishError(f"backup of {table} failed: {dated} has {rows} rows instead of {expected}. The table is untouched.")
    catalog.mark(spark, dated, rows=rows)
    return done


def _copy(spark: SparkSession, table: str, backup: str, tmp: str, keys: Sequence[str], partitions: Sequence[Row]) -> None:
    """Copy some partitions of the table to the backup by way of a verified temporary table."""
    wanted = _among(partitions, keys)
    catalog.create_empty_like(spark, table, tmp)
    content = catalog.append_rows(spark.table(table).where(wanted), tmp)
    if problem := copy_mismatch(spark, tmp, table, content.rows, content):
        raise PublishError(f"backup of {table} failed: {problem}. The table is untouched, inspect {tmp}.")
    with dynamic_overwrite(spark):
        spark.table(tmp).write.insertInto(catalog.quoted(backup), overwrite=True)
    other = compare_groups(spark.table(tmp), spark.table(backup).where(wanted), keys).where(~F.col("matched")).count()
    if other:
        raise PublishError(f"backup of {table} failed: {other} partitions of {backup} have other content than {tmp}, which is kept.")
    catalog.drop(spark, tmp)


def _drop_partitions(spark: SparkSession, backup: str, keys: Sequence[str], partitions: Sequence[Row]) -> None:
    for step in _steps(partitions):
        specs = []
        for row in step:
            values = (f"`{key.replace('`', '``')}` = {'null' if value is None else catalog.text_literal(str(value))}" for key, value in zip(keys, row, strict=True))
            specs.append(f"PARTITION ({', '.join(values)})")
        spark.sql(f"ALTER TABLE {catalog.quoted(backup)} DROP IF EXISTS {', '.join(specs)}")
    spark.catalog.refreshTable(backup)
