"""Data-quality counters: how many rows break each rule, counted in one pass.

Every report is a one-row DataFrame of bigint counters from a single ungrouped aggregate:
each task folds its rows into one partial row, so the only exchange carries one row per
task. Only the columns the rules need are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from fieldnorm.functions.text import column
from fieldnorm.operators.readings import Readings, wrong_shape
from fieldnorm.spec import SENTINELS, FieldSpec, resolve

ROWS = "ROWS"
OUTPUT_PREFIX = "OUTPUT_"
FILLED_PREFIX = "FILLED_"


class QualityError(ValueError):
    """Some rows broke a rule. ``counts`` holds the counters that are not zero."""

    def __init__(self, label: str, counts: dict[str, int]):
        super().__init__(f"{label} failed: {counts}")
        self.label = label
        self.counts = counts


def _counted(flags: dict[str, Column], prefix: str = "") -> list[Column]:
    return [F.count_if(flag).alias(prefix + name) for name, flag in flags.items()]


def source_quality(df: DataFrame, specs: Sequence[FieldSpec], sentinels: Iterable[str] = SENTINELS) -> DataFrame:
    """Count raw values that cannot be normalised.

    ``BAD_c``: not an accepted encoding of the field. ``NO_DATE_c``: a time whose date is
    missing or not a date. ``OVERFLOW_c``: an amount that is no 19-digit number (text that
    is no number at all counts in both).
    """
    readings = Readings(df, specs, sentinels)
    return readings.df.agg(*_counted(readings.faults()))


def output_quality(df: DataFrame, specs: Sequence[FieldSpec]) -> DataFrame:
    """Count normalised values that do not have the shape of their operation (``BAD_c``).

    Nulls pass: a value lost to null shows up in ``source_quality`` only.
    """
    return df.agg(*_counted(_stored_faults(df, specs)))


def counted_output_quality(df: DataFrame, specs: Sequence[FieldSpec], *more: Column) -> DataFrame:
    """``output_quality``, the row count (``ROWS``), the values that are there
    (``FILLED_c``) and ``more`` aggregates from the same scan."""
    spelling = resolve(df.columns, specs)
    present = {spec.column: column(spelling[spec.column]) != "" for spec in specs}
    return df.agg(
        F.count("*").alias(ROWS), *_counted(_stored_faults(df, specs)), *_counted(present, FILLED_PREFIX), *more
    )


def filled(report: Row) -> dict[str, int]:
    """The ``FILLED_c`` counters of a report."""
    return {name: count for name, count in report.asDict().items() if name.startswith(FILLED_PREFIX)}


def _stored_faults(df: DataFrame, specs: Sequence[FieldSpec]) -> dict[str, Column]:
    spelling = resolve(df.columns, specs)
    return {f"BAD_{spec.column}": wrong_shape(column(spelling[spec.column]), spec.op) for spec in specs}


def quality_pass(df: DataFrame, specs: Sequence[FieldSpec], sentinels: Iterable[str] = SENTINELS) -> DataFrame:
    """Row count, source counters and output counters of a raw table in one scan.

    ``FILLED_c`` counts the raw values that must not become null. The output counters (``OUTPUT_BAD_c``) are taken on the values ``normalize`` would
    write, computed beside the source checks from the same decoded fields.
    """
    readings = Readings(df, specs, sentinels)
    faults = readings.faults()
    results = {f"{OUTPUT_PREFIX}{i}": spec for i, spec in enumerate(specs)}
    checked = readings.df.select(
        *(flag.alias(name) for name, flag in faults.items()),
        *(readings.filled(spec).alias(FILLED_PREFIX + spec.column) for spec in specs),
        *(readings.result(spec).alias(name) for name, spec in results.items()),
    )
    return checked.agg(
        F.count("*").alias(ROWS),
        *_counted({name: column(name) for name in faults}),
        *_counted({spec.column: column(FILLED_PREFIX + spec.column) for spec in specs}, FILLED_PREFIX),
        *_counted({f"BAD_{spec.column}": wrong_shape(F.col(name), spec.op) for name, spec in results.items()}, OUTPUT_PREFIX),
    )


def require_clean(report: DataFrame | Row, label: str, prefix: str | None = None) -> dict[str, int]:
    """Raise ``QualityError`` if any counter of a one-row report is above zero.

    With ``prefix`` only the counters that start with it are looked at; ``""`` selects
    those that belong to the source. The row count and the
    filled values are no faults. Returns the report.
    """
    row = report.first() if isinstance(report, DataFrame) else report
    counts = row.asDict()

    def selected(name: str) -> bool:
        if name == ROWS or name.startswith(FILLED_PREFIX):
            return False
        if prefix is None:
            return True
        return name.startswith(prefix) if prefix else not name.startswith(OUTPUT_PREFIX)

    broken = {name: count for name, count in counts.items() if selected(name) and count}
    if broken:
        raise QualityError(label, broken)
    return counts
