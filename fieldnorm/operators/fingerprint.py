"""Fingerprints of a table's content: what a row count cannot see.

For every column, and for all columns of a row together (``ROW``), the 64-bit hashes of all
rows are folded by xor and by a sum of their low 24 bits. Neither depends on the order of
rows, so a copy has the fingerprint of its original however it is laid out. One changed value
changes the xor; a change that leaves the xor as it is (an even number of equal hashes) still
changes the sum of the column and that of the rows, but for one case in 2**48. Values that
trade places between rows change ``ROW`` alone.

A fingerprint is an ungrouped aggregate: one partial row a task. ``observed`` takes it from
rows on their way to somewhere else, so that the source of a copy is not scanned again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from fieldnorm.functions.text import column

WHOLE_ROW = "ROW"
_LOW_BITS = (1 << 24) - 1


@dataclass(frozen=True)
class Fingerprint:
    """Number of rows, and xor and sum of the hashes of each column (by upper-case name)."""

    rows: int
    columns: Mapping[str, tuple[int, int]]

    def differences(self, other: Fingerprint) -> list[str]:
        """Names of the columns whose content differs; ``ROW`` alone if only their combination does."""
        names = [name for name in self.columns if self.columns[name] != other.columns.get(name)]
        names += [name for name in other.columns if name not in self.columns]
        return [name for name in names if name != WHOLE_ROW] or names

    def digest(self) -> str:
        return hashlib.sha256(repr((self.rows, sorted(self.columns.items()))).encode()).hexdigest()


def _hashed(kind: DataType) -> Callable[[Column], Column]:
    """How values of a type become something that can be hashed: maps and variants have no hash of their own."""

    def odd(part: DataType) -> bool:
        if isinstance(part, StructType):
            return any(odd(field.dataType) for field in part)
        return odd(part.elementType) if isinstance(part, ArrayType) else isinstance(part, (MapType, VariantType))

    return (lambda value: F.to_json(F.struct(value.alias("v")))) if odd(kind) else (lambda value: value)


def _aggregates(columns: Mapping[str, tuple[Column, DataType]]) -> list[Column]:
    values = [_hashed(kind)(value) for value, kind in columns.values()]
    # Beside each value its being null, since hashes skip nulls: (null, 1) is not (1, null).
    parts = [x for value in values for x in (value, value.isNull())]
    out = [F.count(F.lit(1)).alias("ROWS")]
    for k, hashed in enumerate([F.xxhash64(F.lit(0), *parts), *map(F.xxhash64, values)]):
        out.append(F.coalesce(F.bit_xor(hashed), F.lit(0)).alias(f"XOR_{k}"))
        out.append(F.coalesce(F.sum(hashed.bitwiseAND(_LOW_BITS)), F.lit(0)).alias(f"SUM_{k}"))
    return out


def _own(df: DataFrame) -> dict[str, tuple[Column, DataType]]:
    return {field.name: (column(field.name), field.dataType) for field in df.schema}


def fingerprint_aggregates(df: DataFrame) -> list[Column]:
    """The fingerprint as aggregates, to be taken in a scan that counts other things too."""
    return _aggregates(_own(df))


def read_fingerprint(report: Row | Mapping, names: list[str]) -> Fingerprint:
    """The fingerprint in a report of ``fingerprint_aggregates`` over columns of these names."""
    lanes = [WHOLE_ROW, *(name.upper() for name in names)]
    return Fingerprint(report["ROWS"], {name: (report[f"XOR_{k}"], report[f"SUM_{k}"]) for k, name in enumerate(lanes)})


def fingerprint_of(df: DataFrame) -> Fingerprint:
    """The fingerprint of all rows, by one scan."""
    return read_fingerprint(df.agg(*fingerprint_aggregates(df)).first(), df.columns)


def observed(df: DataFrame, stored_as: Mapping[str, tuple[Column, DataType]] | None = None) -> tuple[DataFrame, Callable[[], Fingerprint]]:
    """The same rows, and a function that gives their fingerprint after one action has read them all.

    ``stored_as`` gives the values as they will be stored, by name, where the rows have other types.
    """
    columns = stored_as or _own(df)
    observation = Observation()
    return df.observe(observation, *_aggregates(columns)), lambda: read_fingerprint(observation.get, list(columns))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row for each column and one for whole rows: column_name, rows, hash_xor, hash_sum."""
    names = [WHOLE_ROW, *df.columns]
    lanes = [F.struct(F.lit(name).alias("column_name"), F.col("ROWS").alias("rows"), F.col(f"XOR_{k}").alias("hash_xor"), F.col(f"SUM_{k}").alias("hash_sum")) for k, name in enumerate(names)]
    return df.agg(*fingerprint_aggregates(df)).select(F.inline(F.array(*lanes)))


def compare(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row for each column (and ``ROW``) of two tables: column_name, source_rows, target_rows, matched.

    Columns are matched by name without regard to case; one that a side lacks does not match.
    The two scans run in one job, and only one row for each column is joined.
    """
    sides = [
        fingerprint(df).select(F.upper("column_name").alias("column_name"), F.col("rows").alias(f"{side}_rows"), F.struct("rows", "hash_xor", "hash_sum").alias(side))
        for side, df in (("source", source), ("target", target))
    ]
    both = sides[0].join(sides[1], "column_name", "full")
    return both.select("column_name", "source_rows", "target_rows", F.coalesce(F.col("source") == F.col("target"), F.lit(False)).alias("matched"))


def compare_groups(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each value of the keys on either side: keys, source_rows, target_rows, matched.

    ``matched`` says that both sides hold the same rows there, in whatever order; rows are null
    where a side has none. Null is a key like others. Tasks fold their rows into one partial row
    for each group they meet, so a group may be of any size; only one row a group is joined.
    Columns are matched by name without regard to case and must be the same on both sides.
    """
    if sorted(map(str.upper, source.columns)) != sorted(map(str.upper, target.columns)):
        raise ValueError(f"columns differ: {source.columns} and {target.columns}")
    aliases = [f"key_{k}" for k in range(len(keys))]
    sides = []
    for side, df in (("source", source), ("target", target.select(*map(column, source.columns)))):
        aggregates = fingerprint_aggregates(df)
        groups = df.groupBy(*(column(key).alias(alias) for key, alias in zip(keys, aliases, strict=True))).agg(*aggregates)
        lanes = [name for name in groups.columns if name not in aliases]
        own = [F.col(alias).alias(f"{side}_{alias}") for alias in aliases]
        sides.append(groups.select(*own, F.col("ROWS").alias(f"{side}_rows"), F.struct(*lanes).alias(side)))
    same = [F.col(f"source_{alias}").eqNullSafe(F.col(f"target_{alias}")) for alias in aliases]
    both = sides[0].join(sides[1], same, "full")
    out = [F.when(F.col("source").isNotNull(), F.col(f"source_{alias}")).otherwise(F.col(f"target_{alias}")).alias(key) for key, alias in zip(keys, aliases, strict=True)]
    return both.select(*out, "source_rows", "target_rows", F.coalesce(F.col("source") == F.col("target"), F.lit(False)).alias("matched"))
