"""Session settings that matter for wide tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

HUGE_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
JIT_LIMIT = 8000
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def tune(spark: SparkSession) -> SparkSession:
    """Let Spark leave whole-stage code generation where it would hurt.

    The JVM does not compile methods above 8000 bytes of bytecode. The presets stay below,
    but a table with some thirty more text columns does not and would run interpreted.
    With this limit Spark splits such a projection into small methods instead. A lower
    limit already set on the session is kept.
    """
    if int(spark.conf.get(HUGE_METHOD_LIMIT)) > JIT_LIMIT:
        spark.conf.set(HUGE_METHOD_LIMIT, str(JIT_LIMIT))
    return spark


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[SparkSession]:
    """Overwrites of a block replace only the partitions they write; afterwards the session is as it was.

    ``insertInto`` goes by the session's setting, not by an option of the write.
    """
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield spark
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """``tune`` for the actions of a block; afterwards the session is as it was."""
    before = spark.conf.get(HUGE_METHOD_LIMIT)
    tune(spark)
    try:
        yield spark
    finally:
        spark.conf.set(HUGE_METHOD_LIMIT, before)
