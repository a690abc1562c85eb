"""Database tables through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

FETCH_ROWS = 1000
BATCH_ROWS = 1000


def _reader(spark: SparkSession, url: str, fetch_rows: int, options: Mapping[str, str] | None) -> DataFrameReader:
    return spark.read.format("jdbc").options(**(options or {})).option("url", url).option("fetchsize", fetch_rows)


def _bound(value: object) -> str:
    """A stride bound as the source wants it: whole numbers, dates and timestamps as text.

    Bounds only place the strides, they filter nothing, so a fraction may be cut off.
    """
    return str(int(value) if isinstance(value, (Decimal, float)) else value)


def sql_literal(value: object) -> str:
    """A number, text, date or timestamp as databases read it in a condition."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"{value!r} cannot bound a part")


def quantile_query(table: str, column: str, num_parts: int) -> str:
    """The statement with which the database finds where equal parts of its rows begin: one row a part."""
    ranked = f"SELECT {column} AS part_key, NTILE({num_parts}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"(SELECT part, MIN(part_key) AS first_key FROM ({ranked}) ranked GROUP BY part) parts"


def range_predicates(column: str, firsts: Sequence[object]) -> list[str]:
    """Conditions that cut the rows at these values: disjoint, and every row meets one.

    Rows without a value are a part of their own, since there may be any number of them.
    Equal values stay together, so a value that fills several parts makes one larger part.
    """
    cuts = list(dict.fromkeys(firsts))[1:]
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    bounds = [sql_literal(cut) for cut in cuts]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]}", *inner, f"{column} >= {bounds[-1]}", f"{column} IS NULL"]


def hash_predicates(number: str, num_parts: int) -> list[str]:
    """Conditions that deal rows by a whole number the database computes (a key, or a hash of one).

    Negative numbers are dealt too, and rows without one are a part of their own.
    """
    if num_parts < 1:
        raise ValueError(f"{num_parts} parts")
    return [*(f"ABS(MOD({number}, {num_parts})) = {part}" for part in range(num_parts)), f"({number}) IS NULL"]


def quantile_predicates(
    spark: SparkSession, url: str, table: str, column: str, num_parts: int, *, fetch_rows: int = FETCH_ROWS, options: Mapping[str, str] | None = None
) -> list[str]:
    """``predicates`` for ``read_jdbc`` with about as many rows each, however the column is distributed.

    The database ranks the column once (an index serves) and returns one row for each part.
    """
    if num_parts < 1:
        raise ValueError(f"{num_parts} parts")
    query = quantile_query(table, column, num_parts)
    rows = _reader(spark, url, fetch_rows, options).option("dbtable", query).load().collect()
    return range_predicates(column, [first for _, first in sorted(tuple(row) for row in rows)])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    single_task: bool = False,
    fetch_rows: int = FETCH_ROWS,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a whole database table, in a way that has to be chosen.

    With ``partition_column`` and ``num_partitions`` the range of that column is looked up
    by one small query and read in equal strides. Strides of a skewed column are uneven:
    give ``predicates`` then, WHERE conditions that are disjoint and together cover every
    row, one task each: those of ``quantile_predicates`` or ``hash_predicates``, or your own.
    ``single_task`` reads everything in one task, which suits small tables only.

    ``options`` are the other options of the source: user, password, driver and so on.
    Parts are read by separate statements; reconcile the row count if the table may change.
    """
    if (predicates is not None) + bool(partition_column or num_partitions) + single_task != 1:
        raise ValueError("give one of: a partition column with its number of partitions, predicates, single_task=True")
    if predicates is not None:
        properties = {**(options or {}), "fetchsize": str(fetch_rows)}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    reader = _reader(spark, url, fetch_rows, options).option("dbtable", table)
    if (partition_column is None) != (num_partitions is None):
        raise ValueError("partition_column and num_partitions go together")
    if single_task:
        return reader.load()
    query = f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) bounds"
    lowest, highest = _reader(spark, url, fetch_rows, options).option("dbtable", query).load().first()
    if lowest is None:
        return reader.load()
    return (
        reader.option("partitionColumn", partition_column)
        .option("lowerBound", _bound(lowest))
        .option("upperBound", _bound(highest))
        .option("numPartitions", num_partitions)
        .load()
    )


def jdbc_count(
    spark: SparkSession, url: str, table: str, *, fetch_rows: int = FETCH_ROWS, options: Mapping[str, str] | None = None
) -> int:
    """Row count of a database table, counted by the database."""
    query = f"(SELECT COUNT(*) AS row_count FROM {table}) counted"
    return int(_reader(spark, url, fetch_rows, options).option("dbtable", query).load().first()[0])


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    batch_rows: int = BATCH_ROWS,
    connections: int | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Append rows to a database table, at most ``connections`` tasks at a time.

    Each partition is one transaction. A task repeated after its commit (a lost executor)
    writes its rows again, so append to a staging table and reconcile the row count before
    the rows are used.
    """
    writer = df.write.format("jdbc").options(**(options or {})).option("url", url).option("dbtable", table)
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    writer.option("batchsize", batch_rows).mode("append").save()


def written_keys_query(table: str, keys: Sequence[str], batch_column: str, batch: str) -> str:
    """The statement that names the rows a batch has already written."""
    return f"(SELECT {', '.join(keys)} FROM {table} WHERE {batch_column} = {sql_literal(batch)}) written"


def append_batch(
    df: DataFrame,
    url: str,
    table: str,
    batch: str,
    *,
    keys: Sequence[str],
    batch_column: str = "BATCH_ID",
    batch_rows: int = BATCH_ROWS,
    connections: int | None = None,
    predicates: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """``write_jdbc`` that can be repeated: rows this batch has already written are left out.

    Rows carry the name of their batch in ``batch_column``, and ``keys`` identify a row within
    it. Before writing, the keys the batch has in the table are read (in one task, or in parts
    by ``predicates``) and taken off by an anti join; so a run that stopped is simply run
    again. Keys compare like any others and must not be null. A task that is repeated within
    one run, after a commit whose answer was lost, is what the join cannot see: a unique
    constraint on the batch column and the keys makes the database refuse it, and the next run
    writes what is missing.
    """
    if not keys:
        raise ValueError("a batch needs keys")
    spark = df.sparkSession
    query = written_keys_query(table, keys, batch_column, batch)
    if predicates is None:
        written = read_jdbc(spark, url, query, single_task=True, options=options)
    else:
        written = read_jdbc(spark, url, query, predicates=predicates, options=options)
    written = written.toDF(*(f"__written_{k}" for k in range(len(keys))))
    same = [df[key] == written[f"__written_{k}"] for k, key in enumerate(keys)]
    missing = df.join(written, same, "left_anti").withColumn(batch_column, F.lit(batch))
    write_jdbc(missing, url, table, batch_rows=batch_rows, connections=connections, options=options)
