"""Replace a catalog table safely: verified backup, verified stage, swap with rollback.

Every step keeps the data it has not yet verified a replacement for. Renames are two
catalog operations, so a reader may see the table missing for a moment; the old table is
kept until the new one is verified. A rename of a managed table moves its files, which
object stores do by copying; with ``own_folders`` work tables stand in folders of their own
and a rename changes the catalog only.

All copies are narrow scan-project-write stages under Spark's commit protocol: lost tasks
are run again and only committed output becomes visible. Row counts need no data columns. A
copy is verified by content: the write itself takes the fingerprint of the rows it is given,
and one scan of what it wrote must give the same.

Verified work tables are marked in their properties, with what they were made from, so that
``recover`` can finish or undo a run that was killed.
"""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession

from fieldnorm.operators.fingerprint import Fingerprint, fingerprint_aggregates, fingerprint_of, read_fingerprint
from fieldnorm.operators.quality import ROWS, counted_output_quality, filled, require_clean
from fieldnorm.operators.reconcile import reconcile
from fieldnorm.plans import names
from fieldnorm.sources import catalog
from fieldnorm.spec import FieldSpec, output_widths


#: What marks a verified stage: its rows, the content of the table it replaces, whether it was made of that table.
STAGE_MARKS = ("rows", "replaces", "in_place")


class PublishError(RuntimeError):
    """A verification failed. The message says what was restored and what was kept."""


def row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def copy_mismatch(spark: SparkSession, copy: str, original: str, expected_rows: int, content: Fingerprint | None = None) -> str | None:
    """What is wrong with a copy, or None. The cheaper checks come first: columns, rows, content."""
    if not catalog.same_schema(spark, copy, original):
        return f"the columns of {copy} differ from those of {original}"
    rows = row_count(spark, copy)
    if rows != expected_rows:
        return f"{copy} has {rows} rows instead of {expected_rows}"
    if content and (other := fingerprint_of(spark.table(copy)).differences(content)):
        return f"{copy} has other content than was read from {original}, in {', '.join(other)}"
    return None


def refresh_backup(
    spark: SparkSession,
    table: str,
    run_date: date,
    source: DataFrame | None = None,
    expected_rows: int | None = None,
    own_folder: bool = False,
    rebalance: bool = False,
) -> str:
    """Make or replace the backup of ``table`` for ``run_date``; returns its name.

    A copy is written and verified by content under a temporary name, then takes the dated name
    and is counted again. An earlier backup of the same date is dropped only after that, and put
    back if anything fails; a copy that failed is kept. ``source`` is the snapshot of the
    table to copy, by default its present rows. With ``rebalance`` the rows
    are dealt by ``catalog.rebalanced`` first.
    """
    return fingerprinted_backup(spark, table, run_date, source, expected_rows, own_folder, rebalance)[0]


def fingerprinted_backup(
    spark: SparkSession,
    table: str,
    run_date: date,
    source: DataFrame | None = None,
    expected_rows: int | None = None,
    own_folder: bool = False,
    rebalance: bool = False,
) -> tuple[str, Fingerprint]:
    """``refresh_backup``, which also returns the fingerprint of the rows that were copied."""
    catalog.require_session_catalog(spark, table)
    dated = names.backup_name(table, run_date)
    tmp, old = names.backup_tmp_name(table), names.backup_old_name(table)
    catalog.require_absent(spark, [tmp, old])
    snapshot = spark.table(table) if source is None else source

    catalog.create_empty_like(spark, table, tmp, own_folder=own_folder, notes={"day": f"{run_date:%Y%m%d}"})
    content = catalog.append_rows(catalog.rebalanced(snapshot, table) if rebalance else snapshot, tmp)
    expected = content.rows if expected_rows is None else expected_rows
    if problem := copy_mismatch(spark, tmp, table, expected, content):
        raise PublishError(f"backup of {table} failed: {problem}. The table is untouched, inspect {tmp}.")
    catalog.mark(spark, tmp, rows=content.rows, content=content.digest())

    replaces = catalog.exists(spark, dated)
    if replaces:
        catalog.rename(spark, dated, old)
    try:
        catalog.rename(spark, tmp, dated)
    except Exception:
        if replaces:
            catalog.rename(spark, old, dated)
        raise
    try:
        problem = copy_mismatch(spark, dated, table, expected)
    except Exception as error:
        problem = f"{dated} could not be verified ({error})"
    if problem:
        kept = set_aside(spark, table, dated)
        if replaces:
            catalog.rename(spark, old, dated)
        restored = f"the earlier {dated} is back" if replaces else "there was no earlier one"
        raise PublishError(f"backup of {table} failed: {problem}. The copy is kept as {kept}, {restored}.")
    if replaces:
        catalog.drop(spark, old)
    return dated, content


def set_aside(spark: SparkSession, table: str, backup: str) -> str:
    """Rename a failed backup to the first free name for failed backups."""
    for attempt in itertools.count(1):
        free = names.backup_bad_name(table, attempt)
        if not catalog.exists(spark, free):
            catalog.rename(spark, backup, free)
            return free


def stage_verified(
    spark: SparkSession,
    converted: DataFrame,
    table: str,
    specs: Sequence[FieldSpec],
    expected_rows: int,
    expected_filled: Mapping[str, int] | None = None,
    own_folder: bool = False,
    notes: Mapping[str, object] | None = None,
    rebalance: bool = False,
) -> str:
    """Write normalised rows to the staging table of ``table`` and verify them there.

    The staging table has the structure of ``table`` with the specified columns as VARCHAR.
    What was written is read back once for row count, value shapes, content (it must be what
    the write was given) and, where the counters of ``quality_pass`` are given as
    ``expected_filled``, values lost to null. A staging table that fails is kept. One that
    passes is marked as verified, with ``notes``. With ``rebalance`` the rows are dealt by
    ``catalog.rebalanced`` first. Returns its name.
    """
    catalog.require_session_catalog(spark, table)
    stage = names.stage_name(table)
    widths = output_widths(specs)
    catalog.require_absent(spark, [stage])
    catalog.create_empty_like(spark, table, stage, widths, own_folder)
    catalog.require_text_columns(spark, stage, widths)
    given = catalog.append_rows(catalog.rebalanced(converted, table) if rebalance else converted, stage)

    found = spark.table(stage)
    written = counted_output_quality(found, specs, *fingerprint_aggregates(found)[1:]).first()
    if written[ROWS] != expected_rows:
        raise PublishError(
            f"{stage} has {written[ROWS]} rows instead of {expected_rows}. {table} is untouched, inspect {stage}."
        )
    counters = {key: count for key, count in written.asDict().items() if not key.startswith(("XOR_", "SUM_"))}
    require_clean(Row(**counters), f"check of the values in {stage}")
    if other := read_fingerprint(written, found.columns).differences(given):
        raise PublishError(f"{stage} has other content than was written, in {', '.join(other)}. {table} is untouched, inspect {stage}.")
    present = filled(written)
    lost = {name: (count, present[name]) for name, count in (expected_filled or {}).items() if present[name] != count}
    if lost:
        raise PublishError(
            f"{stage} has other numbers of values than the source (expected, found): {lost}. "
            f"{table} is untouched, inspect {stage}."
        )
    catalog.require_text_columns(spark, stage, widths)
    catalog.mark(spark, stage, rows=expected_rows, **(notes or {}))
    return stage


def _visible_rows(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def _restore(spark: SparkSession, table: str, old: str, rows: int) -> tuple[bool, str]:
    """Give the old table its name back; whether all its rows are there, and what came of it in words."""
    try:
        catalog.rename(spark, old, table)
    except Exception as error:
        if not catalog.exists(spark, table):
            return False, f"{table} could not get its name back ({error}), its rows are in {old}"
    try:
        found = _visible_rows(spark, table)
    except Exception as error:
        return False, f"{table} has its name back but could not be counted ({error})"
    if found == rows:
        return True, f"{table} is restored"
    return False, f"{table} has its name back but shows {found} of {rows} rows, inspect it before anything else"


def publish_swap(
    spark: SparkSession,
    table: str,
    stage: str,
    specs: Sequence[FieldSpec],
    expected_rows: int,
    in_place: bool = False,
) -> None:
    """Put a verified staging table in the place of ``table``.

    The old table is renamed away, the new one verified in its place, and the old one then
    dropped. ``in_place`` says that the new rows were made of the old ones: then both must
    have as many. If the new one cannot be verified, for whatever reason, the old table gets
    its name back and the new rows are kept under the staging name. Failure to drop the old
    table at the very end is a warning only.

    If the process is killed on the way, ``recover`` finishes or undoes the swap.
    """
    catalog.require_session_catalog(spark, table)
    old = names.swap_name(table)
    catalog.require_absent(spark, [old])
    before = _visible_rows(spark, table)
    catalog.rename(spark, table, old)
    try:
        catalog.rename(spark, stage, table)
    except Exception as error:
        whole, outcome = _restore(spark, table, old, before)
        if not whole:
            raise PublishError(f"swap failed: {error}. {outcome}.") from error
        raise
    finish_swap(spark, table, stage, specs, expected_rows, before, in_place)


def finish_swap(
    spark: SparkSession, table: str, stage: str, specs: Sequence[FieldSpec], expected_rows: int, rows_before: int, in_place: bool = False
) -> None:
    """Verify the new table under its name and drop the old one, or put the old one back."""
    old = names.swap_name(table)
    try:
        catalog.require_text_columns(spark, table, output_widths(specs))
        rows = row_count(spark, table)
        if rows != expected_rows:
            raise PublishError(f"{table} has {rows} rows instead of {expected_rows}")
        if in_place:
            counts = reconcile(spark.table(old), spark.table(table)).first()
            if not counts.matched:
                raise PublishError(f"{table} has {counts.target_rows} rows, the old table {counts.source_rows}")
    except Exception as error:
        # Refused now: without its mark, recovery does not take it for verified.
        catalog.unmark(spark, table, *STAGE_MARKS)
        catalog.rename(spark, table, stage)
        _, outcome = _restore(spark, table, old, rows_before)
        raise PublishError(f"swap failed: {error}. {outcome}, the new rows are kept as {stage}.") from error
    try:
        catalog.drop(spark, old)
    except Exception as error:
        warnings.warn(f"{table} is published, but its old rows could not be dropped from {old}: {error}", stacklevel=2)
        return
    catalog.unmark(spark, table, *STAGE_MARKS)
