"""Names of the work tables that stand beside a published table."""

from __future__ import annotations

from datetime import date

from fieldnorm.sources.catalog import beside

# The suffixes of the work tables.
STAGE = "_CVT_TMP"
SWAP_OLD = "_SWAP_OLD"
BACKUP = "_BAK_"
BACKUP_TMP = "_BAK_TMP"
BACKUP_OLD = "_BAK_OLD"
BACKUP_BAD = "_BAK_BAD"


def stage_name(table: str) -> str:
    return beside(table, STAGE)


def swap_name(table: str) -> str:
    return beside(table, SWAP_OLD)


def backup_name(table: str, run_date: date) -> str:
    return beside(table, f"{BACKUP}{run_date:%Y%m%d}")


def backup_tmp_name(table: str) -> str:
    return beside(table, BACKUP_TMP)


def backup_old_name(table: str) -> str:
    return beside(table, BACKUP_OLD)


def backup_bad_name(table: str, attempt: int = 1) -> str:
    return beside(table, BACKUP_BAD if attempt == 1 else f"{BACKUP_BAD}_{attempt}")
