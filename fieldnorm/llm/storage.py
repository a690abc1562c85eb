"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where a local session names none (as in tests), a temporary folder is taken; on a
    cluster that would be one machine's own disk, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="fieldnorm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them back.

    Lost executors cannot take the rows with them, and what is read later is what was
    written, also where the plan would not give the same rows twice. The shuffle files of
    the write are dropped when it ends, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/fieldnorm-{name}-{uuid.uuid4().hex}"
    with dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs meanwhile go when it ends."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def discard(*tables: DataFrame) -> None:
    """Remove the rows of ``stored`` tables that nothing reads any more: Spark overwrites them with none."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            spark.createDataFrame([], table.schema).coalesce(1).write.mode("overwrite").parquet(folder)
