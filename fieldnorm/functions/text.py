"""Text view of a column: the common ground on which every encoding is recognised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, DataType, DecimalType, StringType, VarcharType

# BigDecimal text stays plain up to this scale; beyond it small values turn scientific.
_PLAIN_SCALE = 6


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_text(data_type: DataType) -> bool:
    return isinstance(data_type, (StringType, CharType, VarcharType))


def text_view(value: Column, data_type: DataType | None = None) -> Column:
    """``value`` as text without surrounding blanks (U+0020 only; tabs and newlines stay).

    Give the type of the column where it is known: text of a decimal with a large scale
    would otherwise depend on the session's ANSI setting (``0E-10`` or ``0.0000000000``).
    """
    if isinstance(data_type, DecimalType) and data_type.scale > _PLAIN_SCALE:
        return F.translate(F.format_number(value, data_type.scale), ",", "")
    if data_type is not None and is_text(data_type):
        return F.trim(value)
    return F.trim(value.cast("string"))


def field_text(df: DataFrame, name: str) -> Column:
    """The text view of column ``name`` of ``df``, chosen by its type."""
    return text_view(column(name), df.schema[name].dataType)


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every text column in one projection; nulls and other types are unchanged.

    An all-blank value becomes the empty string, not null.
    """
    return df.select(
        *(
            F.trim(column(field.name)).alias(field.name) if is_text(field.dataType) else column(field.name)
            for field in df.schema.fields
        )
    )
