"""Catalog tables: metadata, verbatim and retyped empty copies, renames.

Table names are plain identifiers, optionally qualified (``table``, ``database.table`` or
``spark_catalog.database.table``). Work tables stand beside the table they belong to. Only the
session catalog can publish; tables of other catalogs can be read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnorm.functions.text import column
from fieldnorm.operators.fingerprint import Fingerprint, observed

SESSION_CATALOG = "spark_catalog"
_NAME = re.compile(r"\w+(\.\w+){0,2}")
_SIZED = re.compile(r"(?:varchar|char)\((\d+)\)")


class WorkTableError(RuntimeError):
    """A work table is in the way; it may hold recoverable data, so nothing was changed."""


def quoted(table: str) -> str:
    if not _NAME.fullmatch(table):
        raise ValueError(f"not a plain table name: {table!r}")
    return ".".join(f"`{part}`" for part in table.split("."))


def beside(table: str, suffix: str) -> str:
    """Name of the work table of ``table`` with this suffix."""
    quoted(table)
    return table + suffix


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def require_absent(spark: SparkSession, tables: Iterable[str]) -> None:
    """Raise ``WorkTableError`` if any of the tables exists."""
    found = [table for table in tables if exists(spark, table)]
    if found:
        raise WorkTableError(f"work tables already exist, inspect them before running again: {', '.join(found)}")


def require_session_catalog(spark: SparkSession, table: str) -> None:
    """Raise ``ValueError`` for a table of another catalog: work tables can't be renamed there."""
    quoted(table)
    parts = table.split(".")
    catalog = parts[0] if len(parts) == 3 else spark.catalog.currentCatalog()
    if catalog.lower() != SESSION_CATALOG:
        raise ValueError(f"{table} is in catalog {catalog}; only tables of {SESSION_CATALOG} can be replaced")


def rename(spark: SparkSession, table: str, new_name: str) -> None:
    """Rename within the same database. Spark refuses a name that is already taken.

    The rename of a managed table moves its files, and a catalog may then no longer find
    partitions whose values are written escaped in paths (a blank, a colon), so they are looked
    up anew. A table with a folder of its own only changes its name: its files and the
    partitions that its write has registered stay as they are, and no folder is listed.
    """
    within = new_name.split(".")[-2:]  # the new name is one of the same catalog
    details = _details(spark, table)
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted('.'.join(within))}")
    if details.get("partition_columns") and details.get("type") != "EXTERNAL":
        spark.sql(f"ALTER TABLE {quoted(new_name)} RECOVER PARTITIONS")
        spark.catalog.refreshTable(new_name)


def drop(spark: SparkSession, table: str) -> None:
    """Drop a table, with its files if it is managed or has a folder that ``create_empty_like`` gave it.

    Such a folder is emptied first (Spark overwrites it with no rows), so that the table is
    still there to be dropped if that is interrupted.
    """
    if folder := marks(spark, table).get(FOLDER):
        nothing = spark.createDataFrame([], spark.table(table).schema)
        nothing.coalesce(1).write.mode("overwrite").parquet(folder)
    spark.sql(f"DROP TABLE {quoted(table)}")


#: Prefix of the table properties in which a run says how far it came; clones do not get them.
MARK = "fieldnorm."
FOLDER = "folder"


def marks(spark: SparkSession, table: str) -> dict[str, str]:
    """What a run has noted about a work table, without the prefix."""
    properties = _details(spark, table).get("table_properties") or {}
    return {key[len(MARK) :]: value for key, value in properties.items() if key.startswith(MARK)}


def mark(spark: SparkSession, table: str, **notes: object) -> None:
    """Note something in a table's properties."""
    pairs = ", ".join(f"{text_literal(MARK + key)} = {text_literal(str(value))}" for key, value in notes.items())
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({pairs})")


def unmark(spark: SparkSession, table: str, *keys: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(table)} UNSET TBLPROPERTIES IF EXISTS ({', '.join(text_literal(MARK + key) for key in keys)})")


@dataclass(frozen=True)
class ColumnProfile:
    """Declared metadata of one column. ``length`` is set for (var)char, ``precision`` and
    ``scale`` for decimals."""

    column_name: str
    ordinal: int
    data_type: str
    length: int | None = None
    precision: int | None = None
    scale: int | None = None


def _details(spark: SparkSession, table: str) -> dict:
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} AS JSON").first()[0])


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return _details(spark, table).get("partition_columns") or []


# Type names of the JSON description that SQL spells differently.
_SQL_NAMES = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint", "timestamp_ltz": "timestamp"}


def _type_text(described: dict) -> str:
    """The whole SQL text of a type of the JSON description, however many fields it has."""
    name = described["name"]
    if name in ("varchar", "char"):
        return f"{name}({described['length']})"
    if name == "decimal":
        return f"decimal({described['precision']},{described['scale']})"
    if name == "array":
        return f"array<{_type_text(described['element_type'])}>"
    if name == "map":
        return f"map<{_type_text(described['key_type'])},{_type_text(described['value_type'])}>"
    if name == "struct":
        return f"struct<{','.join(map(_field_text, described['fields']))}>"
    if name == "string" and described.get("collation", "UTF8_BINARY") != "UTF8_BINARY":
        return f"string collate {described['collation']}"
    if name == "interval":
        units = [described[key] for key in ("start_unit", "end_unit") if described.get(key)]
        return " ".join(["interval", " to ".join(dict.fromkeys(units))]).strip()
    return _SQL_NAMES.get(name, name)


def _field_text(field: dict) -> str:
    parts = [_quoted_column(field["name"]) + ":", _type_text(field["type"])]
    if field.get("nullable") is False:
        parts.append("not null")
    if field.get("comment"):
        parts.append(f"comment {text_literal(field['comment'])}")
    return " ".join(parts)


def _quoted_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Fixed value: where Spark keeps the declared text of a type with (var)char in it.
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def columns_of(spark: SparkSession, table: str) -> list[ColumnProfile]:
    """The columns of a table in order, with whole types and declared text widths."""
    declared = {field.name: field.metadata.get(_DECLARED) for field in spark.table(table).schema}
    profiles = []
    for ordinal, column in enumerate(_details(spark, table)["columns"], start=1):
        text = declared.get(column["name"]) or _type_text(column["type"])
        sized = _SIZED.fullmatch(text)
        precision, scale = column["type"].get("precision"), column["type"].get("scale")
        profiles.append(ColumnProfile(column["name"], ordinal, text, int(sized[1]) if sized else None, precision, scale))
    return profiles


def schema_profile(spark: SparkSession, table: str) -> DataFrame:
    """``columns_of`` as a DataFrame, one row per column."""
    return spark.createDataFrame(
        [astuple(profile) for profile in columns_of(spark, table)],
        "column_name string, ordinal int, data_type string, length int, precision int, scale int",
    )


def same_schema(spark: SparkSession, table: str, other: str) -> bool:
    """Whether two tables have the same columns, types, widths and order."""
    return columns_of(spark, table) == columns_of(spark, other)


def require_text_columns(spark: SparkSession, table: str, widths: Mapping[str, int]) -> None:
    """Raise ``ValueError`` unless each column is VARCHAR of at least the given width."""
    declared = {profile.column_name.upper(): profile for profile in columns_of(spark, table)}
    wrong = {}
    for name, width in widths.items():
        profile = declared.get(name.upper())
        if profile is None:
            wrong[name] = "missing"
        elif not profile.data_type.startswith("varchar") or profile.length < width:
            wrong[name] = f"{profile.data_type} instead of varchar({width})"
    if wrong:
        raise ValueError(f"{table}: mapped columns are not text of the needed width: {wrong}")


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _own_folder(spark: SparkSession, table: str) -> str:
    """A new folder for a table, in the folder of its database; no other table has or gets it."""
    parts = table.split(".")
    database = parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()
    home = spark.catalog.getDatabase(database).locationUri
    return f"{home.rstrip('/')}/{parts[-1].lower()}-{uuid.uuid4().hex}"


def create_empty_like(
    spark: SparkSession,
    table: str,
    new_table: str,
    widths: Mapping[str, int] | None = None,
    own_folder: bool = False,
    notes: Mapping[str, object] | None = None,
) -> None:
    """Create ``new_table`` with the structure of ``table`` and no rows.

    Format, options, partitioning, buckets, properties, comments and column defaults are
    kept. Columns in ``widths`` become VARCHAR of that width with no default, since a
    default for raw values does not fit normalised ones. The new table is managed even if
    the old one is external, or with ``own_folder`` external in a new folder, which ``drop``
    empties; then renaming it moves no files. ``notes`` are its first marks.
    """
    details = _details(spark, table)
    if details.get("type") not in ("MANAGED", "EXTERNAL"):
        raise ValueError(f"{table} is not a table but {details.get('type')}")
    if details.get("provider", "hive") == "hive":
        raise ValueError(f"{table}: only data source tables (parquet, orc and so on) can be cloned")
    retyped = {name.upper(): width for name, width in (widths or {}).items()}
    described = {column["name"]: column for column in details["columns"]}

    def declared(profile: ColumnProfile) -> str:
        info = described[profile.column_name]
        name = _quoted_column(profile.column_name)
        width = retyped.get(profile.column_name.upper())
        parts = [name, profile.data_type if width is None else f"VARCHAR({width})"]
        if width is None and info.get("default"):
            parts.append(f"DEFAULT {info['default']}")
        if info.get("comment"):
            parts.append(f"COMMENT {text_literal(info['comment'])}")
        return " ".join(parts)

    def names(key: str) -> str:
        return ", ".join(map(_quoted_column, details[key]))

    def pairs(values: Mapping[str, str]) -> str:
        return ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in values.items())

    clauses = [
        f"CREATE TABLE {quoted(new_table)} ({', '.join(map(declared, columns_of(spark, table)))})",
        f"USING {details['provider']}",
    ]
    properties = {k: v for k, v in (details.get("table_properties") or {}).items() if not k.startswith(MARK)}
    properties |= {MARK + k: str(v) for k, v in (notes or {}).items()}
    if own_folder:
        properties[MARK + FOLDER] = _own_folder(spark, new_table)
    options = {k: v for k, v in (details.get("storage_properties") or {}).items() if k.lower() != "path"}
    if options:
        clauses.append(f"OPTIONS ({pairs(options)})")
    if details.get("partition_columns"):
        clauses.append(f"PARTITIONED BY ({names('partition_columns')})")
    if details.get("bucket_columns"):
        ordered = f" SORTED BY ({names('sort_columns')})" if details.get("sort_columns") else ""
        clauses.append(f"CLUSTERED BY ({names('bucket_columns')}){ordered} INTO {details['num_buckets']} BUCKETS")
    if details.get("comment"):
        clauses.append(f"COMMENT {text_literal(details['comment'])}")
    if own_folder:
        clauses.append(f"LOCATION {text_literal(properties[MARK + FOLDER])}")
    if properties:
        clauses.append(f"TBLPROPERTIES ({pairs(properties)})")
    spark.sql("\n".join(clauses))


def rebalanced(df: DataFrame, table: str) -> DataFrame:
    """The rows shuffled by the table's partition columns, to be written to it.

    Each partition is then written by as few tasks as its size asks for: Spark merges small
    partitions into one task and splits one that holds most rows, by the advisory partition
    size (with it what its hash puts beside it, so don't set too few shuffle partitions). For
    sources whose tasks each hold rows of many partitions, which would write a file for each.
    """
    return df.hint("rebalance", *map(column, partition_columns(df.sparkSession, table)))


def append_rows(df: DataFrame, table: str) -> Fingerprint:
    """Append rows to a table, matching columns by name without regard to case.

    A narrow write: each task writes what it reads, nothing is shuffled. Types and text
    widths are enforced by Spark's store assignment. Returns the fingerprint of the rows as
    they were handed over, in the types of the table, taken by the write itself.
    """
    spark = df.sparkSession
    by_name = {name.upper(): name for name in df.columns}
    profiles = columns_of(spark, table)
    wanted = [profile.column_name for profile in profiles]
    if sorted(by_name) != sorted(name.upper() for name in wanted):
        raise ValueError(f"{table} has columns {wanted}, the rows have {df.columns}")
    ordered = df.select(*(_quoted_column(by_name[name.upper()]) for name in wanted))
    kinds = spark.table(table).schema
    values = {}
    for profile, field in zip(profiles, kinds, strict=True):
        value = column(by_name[field.name.upper()]).cast(field.dataType)
        # Spark fills values of a CHAR column up with blanks.
        value = F.rpad(value, profile.length, " ") if profile.data_type.startswith("char(") else value
        values[field.name] = (value, field.dataType)
    seen, written = observed(ordered, values)
    seen.write.insertInto(quoted(table))
    return written()
