"""Shared steps of all fields, laid out as stacked projections.

Conversion and checks of one field use the same trimmed text and the same decoded date
several times. Nested into one expression per output they would be generated anew at each
use, and the method generated for a whole table soon passes the 8000 bytes of bytecode
beyond which the JVM no longer compiles it (measured: six times slower). So each step has
its own projection: trimmed text, decoded value, result. Catalyst keeps them apart because
a step is used more than once, whole-stage code generation still runs them as one loop,
and steps nobody asks for are pruned.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnorm.functions import encodings as enc
from fieldnorm.functions.text import column, field_text
from fieldnorm.spec import AMOUNT, DATE, TIMESTAMP, TRUNCATE_LAST_2, FieldSpec, resolve

_SHAPES = {
    DATE: enc.DATE_SHAPE,
    TIMESTAMP: enc.TIMESTAMP_SHAPE,
    AMOUNT: enc.AMOUNT_SHAPE,
    TRUNCATE_LAST_2: enc.SHORT_CODE_SHAPE,
}


def wrong_shape(value: Column, op: str) -> Column:
    """Whether a normalised value does not look like the result of ``op``; blank passes."""
    fits = value.rlike(_SHAPES[op])
    if op == TRUNCATE_LAST_2:
        fits = fits & (F.length(value) <= enc.SHORT_CODE_WIDTH)
    return (value != "") & ~fits


class Readings:
    """The rows of a table (``df``) with the decoded values of every field beside them.

    With ``stacked=False`` nothing is put beside them: every result is one nested
    expression over ``source``. For a handful of rows that costs nothing, and a single
    projection over a sort and a limit still becomes one top-k operator.
    """

    def __init__(
        self, source: DataFrame, specs: Sequence[FieldSpec], sentinels: Iterable[str], stacked: bool = True
    ):
        self.specs = tuple(specs)
        self.sentinels = tuple(sentinels)
        self.spelling = resolve(source.columns, self.specs)
        self._prefix = "_field"
        while any(name.startswith(self._prefix) for name in source.columns):
            self._prefix += "_"

        names = list(dict.fromkeys(self.spelling.values()))
        self._steps: dict[str, Column] = {}
        self.df = source
        self._add({self._step("text", name): field_text(source, name) for name in names}, stacked)
        decoded = {}
        for spec in self.specs:
            if spec.op == AMOUNT:
                name = self.spelling[spec.column]
                decoded[self._step("units", name)] = enc.whole_units(self._text(name))
            if (name := self._date_name(spec)) is not None:
                decoded[self._step("day", name)] = enc.parse_date(self._text(name), self.sentinels)
        self._add(decoded, stacked)

    def _add(self, values: dict[str, Column], stacked: bool) -> None:
        if stacked and values:
            self.df = self.df.withColumns(values)
            self._steps.update({name: column(name) for name in values})
        else:
            self._steps.update(values)

    def _step(self, kind: str, name: str) -> str:
        return f"{self._prefix}_{kind}_{name}"

    def _text(self, name: str) -> Column:
        return self._steps[self._step("text", name)]

    def _date_name(self, spec: FieldSpec) -> str | None:
        """The column that holds the date of the field: its own, or the linked one."""
        if spec.op == DATE:
            return self.spelling[spec.column]
        return self.spelling[spec.date_column] if spec.date_column else None

    def _day(self, spec: FieldSpec) -> Column:
        return self._steps[self._step("day", self._date_name(spec))]

    def _undated(self, spec: FieldSpec) -> Column:
        return self._day(spec).isNull()

    def _units(self, spec: FieldSpec) -> Column:
        return self._steps[self._step("units", self.spelling[spec.column])]

    def result(self, spec: FieldSpec) -> Column:
        """The normalised text of the field."""
        text = self._text(self.spelling[spec.column])
        if spec.op == DATE:
            return enc.date_layout(self._day(spec))
        if spec.op == TIMESTAMP:
            return enc.clock_layout(text, enc.date_layout(self._day(spec)))
        if spec.op == AMOUNT:
            return enc.amount_layout(self._units(spec))
        return enc.truncate_last_2(text)

    def filled(self, spec: FieldSpec) -> Column:
        """Whether the field holds a raw value that must not become null."""
        text = self._text(self.spelling[spec.column])
        if spec.op == DATE:
            return (text != "") & ~enc.is_sentinel(text, self.sentinels)
        return text != ""

    def faults(self) -> dict[str, Column]:
        """What makes a raw value bad, by counter name. Null counts as not bad."""
        flags: dict[str, Column] = {}
        for spec in self.specs:
            text = self._text(self.spelling[spec.column])
            filled = text != ""
            bad = f"BAD_{spec.column}"
            if spec.op == DATE:
                flags[bad] = filled & ~enc.is_sentinel(text, self.sentinels) & self._undated(spec)
            elif spec.op == TIMESTAMP:
                flags[bad] = filled & ~text.rlike(enc.PACKED_TIME)
                flags[f"NO_DATE_{spec.column}"] = filled & self._undated(spec)
            elif spec.op == AMOUNT:
                units = self._units(spec)
                flags[bad] = filled & ~units.rlike(enc.WHOLE_NUMBER)
                flags[f"OVERFLOW_{spec.column}"] = filled & enc.as_minor_units(units).isNull()
            else:
                flags[bad] = filled & ~(text.rlike(enc.CODE) & text.endswith(enc.CODE_SUFFIX))
        return flags
