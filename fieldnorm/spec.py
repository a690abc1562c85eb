"""What to normalise: field specifications, the operation names and the two presets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

# Operation names, the width of the text each one produces, and the
# two-digit date field that stands for "no date".
DATE = "DATE"
TIMESTAMP = "TIMESTAMP"
AMOUNT = "AMOUNT"
TRUNCATE_LAST_2 = "TRUNCATE_LAST_2"
WIDTHS = {DATE: 10, TIMESTAMP: 19, AMOUNT: 21, TRUNCATE_LAST_2: 19}
SENTINELS = ("000000",)


@dataclass(frozen=True)
class FieldSpec:
    """One column to normalise.

    ``date_column`` is needed for ``TIMESTAMP`` only: the column of the same row that
    holds the calendar date of the packed time.
    """

    column: str
    op: str
    date_column: str | None = None

    def __post_init__(self) -> None:
        if self.op not in WIDTHS:
            raise ValueError(f"{self.column}: unsupported operation {self.op!r}, use one of {sorted(WIDTHS)}")
        if (self.op == TIMESTAMP) != (self.date_column is not None):
            raise ValueError(f"{self.column}: date_column belongs to {TIMESTAMP} fields, and each needs one")


# The columns of the card-terminal (POS) and cash-machine (ATM) layouts.
POS_SPECS = (
    FieldSpec("TRN_BGN_DATE", DATE),
    FieldSpec("POST_DATE", DATE),
    FieldSpec("AINT_SETL_DATE", DATE),
    FieldSpec("IINT_SETL_DATE", DATE),
    FieldSpec("TRN_BGN_TIME", TIMESTAMP, date_column="TRN_BGN_DATE"),
    FieldSpec("AMT_1", AMOUNT),
    FieldSpec("AMT_2", AMOUNT),
)
ATM_SPECS = (
    FieldSpec("DATE_TRN_BGN", DATE),
    FieldSpec("POST_DATE", DATE),
    FieldSpec("ACQ_ICHG_SETL_DATE", DATE),
    FieldSpec("ISS_ICHG_SETL_DATE", DATE),
    FieldSpec("TRN_ENTY_TIME", TIMESTAMP, date_column="DATE_TRN_BGN"),
    FieldSpec("AMT_1", AMOUNT),
    FieldSpec("AMT_2", AMOUNT),
    FieldSpec("AMT_3", AMOUNT),
)


def output_widths(specs: Sequence[FieldSpec]) -> dict[str, int]:
    """Characters each normalised column needs, by column name."""
    return {spec.column: WIDTHS[spec.op] for spec in specs}


def resolve(columns: Sequence[str], specs: Sequence[FieldSpec]) -> dict[str, str]:
    """Map every column name used by ``specs`` to its spelling in ``columns``.

    Names are compared without regard to case. All missing columns are reported together.
    """
    if not specs:
        raise ValueError("no fields to normalise: the list of field specifications is empty")
    spelled: dict[str, list[str]] = {}
    for name in columns:
        spelled.setdefault(name.upper(), []).append(name)
    mapped = [spec.column.upper() for spec in specs]
    repeated = sorted({name for name in mapped if mapped.count(name) > 1})
    if repeated:
        raise ValueError(f"fields specified more than once: {repeated}")
    absent = sorted(spec.column for spec in specs if spec.column.upper() not in spelled)
    if absent:
        raise ValueError(f"mapped columns missing from the source: {absent}")
    found = {}
    for spec in specs:
        for name in filter(None, (spec.column, spec.date_column)):
            matches = spelled.get(name.upper(), [])
            if not matches:
                raise ValueError(f"{spec.column}: linked date column {name} is missing from the source")
            if len(matches) > 1:
                raise ValueError(f"column name {name} is ambiguous, it matches {matches}")
            found[name] = matches[0]
    return found
