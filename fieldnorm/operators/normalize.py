"""Rewrite the specified columns of a table to normalised text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnorm.functions.text import column, is_text
from fieldnorm.operators.readings import Readings
from fieldnorm.spec import SENTINELS, FieldSpec


def normalize(
    df: DataFrame, specs: Sequence[FieldSpec], sentinels: Iterable[str] = SENTINELS, untrimmed: Iterable[str] = ()
) -> DataFrame:
    """Replace every specified column by its normalised text, in place.

    Row count, column order and the spelling of column names are kept. Other text columns
    are trimmed (an all-blank value becomes ``""``) unless named in ``untrimmed`` (partition
    columns, where a trimmed value is another partition), other types pass through. All
    expressions read source values, so a timestamp sees its date column in raw form. The
    whole table is one narrow pass: no shuffle, no Python.

    Apply it to raw values only; see ``amount_text`` for what a second run would do.
    """
    readings = Readings(df, specs, sentinels)
    as_is = {name.upper() for name in untrimmed}
    mapped = {readings.spelling[spec.column]: spec for spec in specs}

    def shown(field):
        if field.name in mapped:
            return readings.result(mapped[field.name]).alias(field.name)
        if is_text(field.dataType) and field.name.upper() not in as_is:
            return F.trim(column(field.name)).alias(field.name)
        return column(field.name)

    return readings.df.select(*map(shown, df.schema.fields))


def preview(
    df: DataFrame,
    specs: Sequence[FieldSpec],
    key: str | None = None,
    rows: int = 20,
    sentinels: Iterable[str] = SENTINELS,
) -> DataFrame:
    """The specified columns of a few normalised rows: the first by ``key``, or any.

    The rows are picked from the source before anything is converted, so only these few
    are normalised. With a key that is one top-k operator: each task keeps its ``rows``
    best, and the table is not sorted.
    """
    picked = (df if key is None else df.orderBy(column(key))).limit(rows)
    readings = Readings(picked, specs, sentinels, stacked=False)
    return readings.df.select(*(readings.result(spec).alias(readings.spelling[spec.column]) for spec in specs))
