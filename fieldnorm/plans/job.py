"""The whole job: check, convert, check, then preview or publish."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from fieldnorm.operators.fingerprint import observed
from fieldnorm.operators.normalize import normalize, preview
from fieldnorm.operators.quality import OUTPUT_PREFIX, ROWS, filled, quality_pass, require_clean
from fieldnorm.plans import names
from fieldnorm.plans.publish import PublishError, fingerprinted_backup, publish_swap, stage_verified
from fieldnorm.session import tuned
from fieldnorm.sources.catalog import (
    WorkTableError,
    exists,
    partition_columns,
    require_absent,
    require_session_catalog,
)
from fieldnorm.spec import SENTINELS, FieldSpec

log = logging.getLogger(__name__)


def run_job(
    spark: SparkSession,
    source: str | DataFrame,
    specs: Sequence[FieldSpec],
    target: str | None = None,
    dry_run: bool = True,
    preview_key: str | None = None,
    sentinels: Iterable[str] = SENTINELS,
    run_date: date | None = None,
    own_folders: bool = False,
    rebalance: bool = False,
) -> DataFrame:
    """Normalise ``source`` and return a preview (dry run, the default) or the new table.

    ``source`` is a catalog table or any DataFrame of raw rows. A publishing run replaces
    ``target``, by default the source table itself, with the normalised rows; a target that
    is not the source must have the same columns. Nothing is written unless every raw value
    and every normalised value passes its check, and nothing is replaced before a verified
    backup of the target exists.

    The rows are scanned once for all checks (only the mapped columns), once for the backup
    and once for the stage; both copies are read back. Nobody else should write to the source
    meanwhile: if the number of rows, or of values in a mapped column, changes between the
    scans, or any value of a table that is replaced by its own rows, the run stops before
    the target is replaced. Partition columns that are not mapped are left as they are.

    With ``own_folders`` backup and new table are external tables in new folders beside the
    old one, so that renames move no files and look up no partitions. Dropping such a table
    by other means leaves its files behind.

    With ``rebalance`` the rows of backup and stage are shuffled by the target's partition
    columns before they are written. That is worth a shuffle where the source's tasks each
    hold rows of many partitions; by default nothing is shuffled.

    A run that was killed leaves work tables; ``recover`` finishes or undoes it.

    The session's limit for compiled methods is lowered while the run scans and writes, and
    put back afterwards; a preview is computed later, by whoever asks for its rows.
    """
    with tuned(spark):
        return _run(spark, source, specs, target, dry_run, preview_key, tuple(sentinels), run_date, own_folders, rebalance)


def _run(
    spark: SparkSession,
    source: str | DataFrame,
    specs: Sequence[FieldSpec],
    target: str | None,
    dry_run: bool,
    preview_key: str | None,
    sentinels: tuple[str, ...],
    run_date: date | None,
    own_folders: bool,
    rebalance: bool,
) -> DataFrame:
    target = source if target is None and isinstance(source, str) else target
    in_place = target is not None and target == source
    if not dry_run and target is None:
        raise ValueError("a publishing run needs a target table")
    if not dry_run:
        _require_ready(spark, target)

    raw = spark.table(source) if isinstance(source, str) else source
    report = quality_pass(raw, specs, sentinels).first()
    rows = report[ROWS]
    log.info("%s rows in %s, dry_run=%s", rows, source if isinstance(source, str) else "the source", dry_run)
    require_clean(report, "source check", prefix="")
    require_clean(report, "check of the converted values", prefix=OUTPUT_PREFIX)
    if dry_run:
        log.info("dry run complete, nothing was changed")
        return preview(raw, specs, preview_key, sentinels=sentinels)

    backup, copied = fingerprinted_backup(
        spark,
        target,
        run_date or date.today(),
        source=raw if in_place else None,
        expected_rows=rows if in_place else None,
        own_folder=own_folders,
        rebalance=rebalance,
    )
    log.info("verified backup %s", backup)
    notes = {"replaces": copied.digest(), "in_place": in_place}
    seen, content = observed(raw) if in_place else (raw, lambda: copied)
    converted = normalize(seen, specs, sentinels, untrimmed=partition_columns(spark, target))
    stage = stage_verified(spark, converted, target, specs, rows, filled(report), own_folders, notes, rebalance)
    if changed := content().differences(copied):
        raise PublishError(
            f"{target} changed between backup and conversion, in {', '.join(changed)}. {target} is untouched, drop {stage}."
        )
    publish_swap(spark, target, stage, specs, rows, in_place)
    log.info("%s published with %s rows, backup %s", target, rows, backup)
    return spark.table(target)


def _require_ready(spark: SparkSession, target: str) -> None:
    """Refuse a run that could not end well, before anything is read or written."""
    require_session_catalog(spark, target)
    stage, swap_old = names.stage_name(target), names.swap_name(target)
    if not exists(spark, target):
        if exists(spark, swap_old):
            raise WorkTableError(
                f"target table {target} does not exist: an earlier run stopped between its renames, recover() ends it. "
                f"The old rows are in {swap_old}" + (f", the new ones in {stage}" if exists(spark, stage) else "")
            )
        raise ValueError(f"target table {target} does not exist")
    require_absent(spark, [stage, swap_old, names.backup_tmp_name(target), names.backup_old_name(target)])
