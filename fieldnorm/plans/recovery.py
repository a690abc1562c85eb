"""Ending a publishing run that was killed between its steps.

Nothing is remembered but the catalog: which work tables there are, and their marks. A table
is marked only once it is verified, and every step of a run leaves one of these states
(``T`` the table, others by their suffix):

====================================  ==========================================================
State                                 Recovery
====================================  ==========================================================
T, BAK_TMP                            drop the unfinished copy
T, BAK_OLD, BAK_TMP                   give BAK_OLD its dated name back, drop the copy
T, BAK_OLD, dated backup              drop BAK_OLD if the new backup is marked and whole
T, CVT_TMP unmarked                   drop the unverified stage
T, CVT_TMP marked                     swap, if T still has the content that was backed up; else drop
SWAP_OLD, CVT_TMP marked              give the stage the table's name, verify, drop SWAP_OLD
SWAP_OLD, CVT_TMP unmarked or none    give SWAP_OLD the table's name back
T marked, SWAP_OLD                    verify T, drop SWAP_OLD; put SWAP_OLD back if T fails
T marked                              take the mark away
====================================  ==========================================================

Each line ends in a state further down or in the end, so recovery may itself be killed and
run again. The old rows are dropped only where the new ones are verified in their place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import SparkSession

from fieldnorm.operators.fingerprint import fingerprint_of
from fieldnorm.plans import names
from fieldnorm.plans.publish import STAGE_MARKS, finish_swap, publish_swap, row_count, set_aside
from fieldnorm.sources import catalog
from fieldnorm.sources.catalog import WorkTableError
from fieldnorm.spec import FieldSpec


@dataclass
class Recovery:
    """``published``: the killed run's rows are now in place. ``steps``: what was done.

    Without steps nothing was left of a run: there was none, or it was killed after its last step.
    """

    published: bool = False
    steps: list[str] = field(default_factory=list)


def recover(spark: SparkSession, table: str, specs: Sequence[FieldSpec], run_date: date | None = None) -> Recovery:
    """Finish or undo a run of ``run_job`` on ``table`` that was killed; does nothing to a clean table.

    ``specs`` are those of the run. ``run_date`` is needed only for an earlier backup that
    stands under ``_BAK_OLD`` and does not say its day (one made before backups were marked).
    """
    catalog.require_session_catalog(spark, table)
    done = Recovery()
    _end_swap(spark, table, specs, done)
    _end_backup(spark, table, run_date, done)
    return done


def _end_swap(spark: SparkSession, table: str, specs: Sequence[FieldSpec], done: Recovery) -> None:
    stage, old = names.stage_name(table), names.swap_name(table)
    here, staged, swapped = (catalog.exists(spark, name) for name in (table, stage, old))
    stage_marks = catalog.marks(spark, stage) if staged else {}
    if not here and not swapped:
        raise ValueError(f"neither {table} nor {old} exists, there is nothing to recover")
    if not here:
        if "rows" not in stage_marks:
            catalog.rename(spark, old, table)
            done.steps.append(f"renamed {old} back to {table}")
            swapped = False
        else:
            catalog.rename(spark, stage, table)
            done.steps.append(f"renamed {stage} to {table}")
            staged = False
    if swapped:
        marks = catalog.marks(spark, table)
        if "rows" not in marks:
            raise WorkTableError(f"{table} is not a verified table of a run, but {old} exists; inspect both")
        if staged:
            raise WorkTableError(f"{table}, {old} and {stage} all exist, which no run leaves; inspect them")
        in_place = marks.get("in_place") == "True"
        finish_swap(spark, table, stage, specs, int(marks["rows"]), row_count(spark, old), in_place)
        done.steps.append(f"verified {table} and dropped {old}")
        done.published = True
    elif staged:
        unchanged = "replaces" in stage_marks and fingerprint_of(spark.table(table)).digest() == stage_marks["replaces"]
        if unchanged:
            publish_swap(spark, table, stage, specs, int(stage_marks["rows"]), stage_marks.get("in_place") == "True")
            done.steps.append(f"swapped {stage} for {table}")
            done.published = True
        else:
            catalog.drop(spark, stage)
            done.steps.append(f"dropped {stage}, which was not verified or not made for the present {table}")
    elif "rows" in catalog.marks(spark, table):
        catalog.unmark(spark, table, *STAGE_MARKS)
        done.steps.append(f"{table} was published already")
        done.published = True


def _end_backup(spark: SparkSession, table: str, run_date: date | None, done: Recovery) -> None:
    tmp, old = names.backup_tmp_name(table), names.backup_old_name(table)
    if catalog.exists(spark, old):
        day = catalog.marks(spark, old).get("day")
        day = datetime.strptime(day, "%Y%m%d").date() if day else run_date
        if day is None:
            raise WorkTableError(f"{old} does not say its day; give run_date, or rename it")
        dated = names.backup_name(table, day)
        if catalog.exists(spark, dated) and not _whole(spark, dated):
            done.steps.append(f"renamed {dated} to {set_aside(spark, table, dated)}")
        if catalog.exists(spark, dated):
            catalog.drop(spark, old)
            done.steps.append(f"dropped {old}, {dated} is whole")
        else:
            catalog.rename(spark, old, dated)
            done.steps.append(f"renamed {old} back to {dated}")
    if catalog.exists(spark, tmp):
        catalog.drop(spark, tmp)
        done.steps.append(f"dropped {tmp}")


def _whole(spark: SparkSession, backup: str) -> bool:
    rows = catalog.marks(spark, backup).get("rows")
    return rows is not None and row_count(spark, backup) == int(rows)
