"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldnorm.functions import amount_text, date_text, field_text, parse_date, timestamp_text, trim_strings
from fieldnorm.functions import truncate_last_2 as drop_last_2
from fieldnorm.operators import compare, compare_groups, normalize, output_quality, preview, quality_pass, reconcile, source_quality
from fieldnorm.plans import publish_swap, recover, refresh_backup, run_job, stage_verified
from fieldnorm.plans.names import swap_name
from fieldnorm.registered.raw_views import (
    raw_atm,
    raw_atm_dirty,
    raw_codes,
    raw_codes_dirty,
    raw_pos,
    raw_pos_dirty,
    raw_pos_partitioned,
    read_table,
)
from fieldnorm.session import tune
from fieldnorm.sources import create_empty_like, rename, text_literal
from fieldnorm.sources import schema_profile as profile_of
from fieldnorm.spec import ATM_SPECS, POS_SPECS, TRUNCATE_LAST_2, FieldSpec

Query = Callable[[SparkSession, str], DataFrame]

CODE_SPECS = (FieldSpec("CODE", TRUNCATE_LAST_2),)
RUN_DATE = date(2026, 1, 31)
PROFILED = ("customer", "lineitem", "orders", "part", "supplier")

_scratch: list[str] = []


def _texts(df: DataFrame, *names: str) -> list[Column]:
    return [field_text(df, name) for name in names]


def parse_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_pos_dirty(spark, sf_dir)
    begin, post = _texts(raw, "TRN_BGN_DATE", "POST_DATE")
    return raw.select("k", parse_date(begin).alias("begin_date"), parse_date(post).alias("post_date"))


def date_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_pos_dirty(spark, sf_dir)
    begin, post = _texts(raw, "TRN_BGN_DATE", "POST_DATE")
    return raw.select("k", date_text(begin).alias("begin_date"), date_text(post).alias("post_date"))


def timestamp_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_pos_dirty(spark, sf_dir)
    time, day = _texts(raw, "TRN_BGN_TIME", "TRN_BGN_DATE")
    return raw.select("k", timestamp_text(time, day).alias("begin_time"))


def amount_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_pos_dirty(spark, sf_dir)
    first, second = _texts(raw, "AMT_1", "AMT_2")
    return raw.select("k", amount_text(first).alias("amount_1"), amount_text(second).alias("amount_2"))


def truncate_last_2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_codes(spark, sf_dir)
    (code,) = _texts(raw, "CODE")
    return raw.select("k", drop_last_2(code).alias("code"))


def _scratch_database(spark: SparkSession) -> str:
    """A new database in the shared folder the cluster names, or where none is named in the
    session's warehouse. ``drop_scratch`` drops it.

    Both are taken as they are named: a ``file:`` folder may be a mount that all machines share.
    ``_scratch_table`` counts what has arrived there.
    """
    database = f"fieldnorm_{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    location = f" LOCATION {text_literal(shared.rstrip('/') + '/' + database)}" if shared else ""
    spark.sql(f"CREATE DATABASE {database}{location}")
    _scratch.append(database)
    return database


def _scratch_table(spark: SparkSession, rows: DataFrame, *partitions: str) -> str:
    """Store raw rows as a table in a database of its own.

    Raises ``ValueError`` if not all of them can be read back: executors that don't share the
    folder leave their rows on their own disks.
    """
    table = f"{_scratch_database(spark)}.card_rows"
    written = Observation()
    seen = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = seen.write.partitionBy(*partitions) if partitions else seen.write
    writer.saveAsTable(table)
    found = spark.table(table).count()
    if found != written.get["rows"]:
        raise ValueError(
            f"{table} has {found} of {written.get['rows']} rows; set spark.checkpoint.dir to a folder that all machines share"
        )
    return table


def drop_scratch(spark: SparkSession) -> None:
    """Drop the databases this process made, once nobody reads their tables any more."""
    while _scratch:
        spark.sql(f"DROP DATABASE IF EXISTS {_scratch.pop()} CASCADE")


def _staged(spark: SparkSession, sf_dir: str) -> tuple[str, str, int]:
    """A raw table, its verified staging table and the row count of both."""
    table = _scratch_table(spark, raw_pos(spark, sf_dir))
    raw = spark.table(table)
    rows = raw.count()
    return table, stage_verified(spark, normalize(raw, POS_SPECS), table, POS_SPECS, rows), rows


def schema_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of clones with the given tables' columns, and of the verified stage of the raw rows."""
    database = _scratch_database(spark)
    stage = _staged(spark, sf_dir)[1]
    profiles = profile_of(spark, stage).select(F.lit("stage").alias("table_name"), "*")
    for name in PROFILED:
        spark.catalog.createTable(f"{database}.{name}", source="parquet", schema=read_table(spark, sf_dir, name).schema)
        create_empty_like(spark, f"{database}.{name}", f"{database}.{name}_empty")
        profiles = profiles.union(profile_of(spark, f"{database}.{name}_empty").select(F.lit(name).alias("table_name"), "*"))
    return profiles


def row_count_reconcile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, stage, _ = _staged(spark, sf_dir)
    return reconcile(spark.table(table), spark.table(stage))


def copy_compare_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows against their backup, and against a copy with equal counts and other values."""
    table = _scratch_table(spark, raw_pos(spark, sf_dir))
    backup = spark.table(refresh_backup(spark, table, RUN_DATE))
    amount = F.when(F.col("k") % 5000 == 77, "0").otherwise(F.col("AMT_2"))
    # Notes of two keys trade places, so that the column holds the same values.
    note = F.when(F.col("k") == 1, "  5-LOW ").when(F.col("k") == 2, "  1-URGENT ").otherwise(F.col("NOTE"))
    changed = backup.withColumns({"AMT_2": amount, "NOTE": note})
    reports = [compare(spark.table(table), copy).select(F.lit(name).alias("copy"), "*") for name, copy in (("backup", backup), ("changed", changed))]
    return reports[0].union(reports[1])


def compare_groups_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows by place against rows of which one place is gone and one has other notes."""
    raw = raw_pos_partitioned(spark, sf_dir)
    note = F.when(F.col("k") % 8 == 1, "other").otherwise(F.col("NOTE"))
    return compare_groups(raw, raw.where(F.col("k") % 4 != 2).withColumn("NOTE", note), ["PLACE"])


def recover_killed_run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that was killed between its two renames, ended by ``recover``."""
    table, _, _ = _staged(spark, sf_dir)
    rename(spark, table, swap_name(table))
    recover(spark, table, POS_SPECS)
    return spark.table(table)


def publish_own_folders_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _scratch_table(spark, raw_pos_partitioned(spark, sf_dir), "PLACE")
    return run_job(spark, table, POS_SPECS, dry_run=False, run_date=RUN_DATE, own_folders=True)


def publish_rebalanced_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are no table's, dealt over all tasks without regard to place, replace those of a partitioned table."""
    raw = raw_pos_partitioned(spark, sf_dir)
    table = _scratch_table(spark, raw.where("k % 2 = 0"), "PLACE")
    return run_job(spark, raw, POS_SPECS, target=table, dry_run=False, run_date=RUN_DATE, rebalance=True)


def backup_refresh_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes on one date, so the second replaces the first."""
    table = _scratch_table(spark, raw_pos(spark, sf_dir))
    refresh_backup(spark, table, RUN_DATE)
    return spark.table(refresh_backup(spark, table, RUN_DATE))


def stage_verified_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_staged(spark, sf_dir)[1])


def publish_swap_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, stage, rows = _staged(spark, sf_dir)
    publish_swap(spark, table, stage, POS_SPECS, rows)
    return spark.table(table)


def run_job_publish_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _scratch_table(spark, raw_pos(spark, sf_dir))
    return run_job(spark, table, POS_SPECS, dry_run=False, run_date=RUN_DATE)


def run_job_publish_atm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _scratch_table(spark, raw_atm(spark, sf_dir))
    return run_job(spark, table, ATM_SPECS, dry_run=False, run_date=RUN_DATE)


def publish_partitioned_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _scratch_table(spark, raw_pos_partitioned(spark, sf_dir), "PLACE")
    return run_job(spark, table, POS_SPECS, dry_run=False, run_date=RUN_DATE)


QUERIES: dict[str, Query] = {
    "parse_date": parse_date_query,
    "date_text": date_text_query,
    "timestamp_text": timestamp_text_query,
    "amount_text": amount_text_query,
    "truncate_last_2": truncate_last_2_query,
    "trim_strings": lambda spark, sf_dir: trim_strings(raw_pos(spark, sf_dir)),
    "normalize_pos": lambda spark, sf_dir: normalize(raw_pos(spark, sf_dir), POS_SPECS),
    "normalize_atm": lambda spark, sf_dir: normalize(raw_atm(spark, sf_dir), ATM_SPECS),
    "normalize_codes": lambda spark, sf_dir: normalize(raw_codes(spark, sf_dir), CODE_SPECS),
    "source_quality": lambda spark, sf_dir: source_quality(raw_pos(spark, sf_dir), POS_SPECS),
    "source_quality_dirty": lambda spark, sf_dir: source_quality(raw_pos_dirty(spark, sf_dir), POS_SPECS),
    "source_quality_codes": lambda spark, sf_dir: source_quality(raw_codes(spark, sf_dir), CODE_SPECS),
    "source_quality_dirty_atm": lambda spark, sf_dir: source_quality(raw_atm_dirty(spark, sf_dir), ATM_SPECS),
    "source_quality_dirty_codes": lambda spark, sf_dir: source_quality(raw_codes_dirty(spark, sf_dir), CODE_SPECS),
    "output_quality_codes": lambda spark, sf_dir: output_quality(
        normalize(raw_codes_dirty(spark, sf_dir), CODE_SPECS), CODE_SPECS
    ),
    "output_quality": lambda spark, sf_dir: output_quality(normalize(raw_pos(spark, sf_dir), POS_SPECS), POS_SPECS),
    "output_quality_raw": lambda spark, sf_dir: output_quality(raw_pos(spark, sf_dir), POS_SPECS),
    "quality_pass": lambda spark, sf_dir: quality_pass(raw_pos_dirty(spark, sf_dir), POS_SPECS),
    "quality_pass_atm": lambda spark, sf_dir: quality_pass(raw_atm(spark, sf_dir), ATM_SPECS),
    "preview_mapped": lambda spark, sf_dir: preview(raw_pos(spark, sf_dir), POS_SPECS, key="k"),
    "schema_profile": schema_profile_query,
    "row_count_reconcile": row_count_reconcile_query,
    "copy_compare": copy_compare_query,
    "compare_groups": compare_groups_query,
    "backup_refresh": backup_refresh_query,
    "stage_verified": stage_verified_query,
    "publish_swap": publish_swap_query,
    "run_job_dry": lambda spark, sf_dir: run_job(spark, raw_pos(spark, sf_dir), POS_SPECS, preview_key="k"),
    "run_job_publish": run_job_publish_query,
    "run_job_dry_atm": lambda spark, sf_dir: run_job(spark, raw_atm(spark, sf_dir), ATM_SPECS, preview_key="k"),
    "run_job_publish_atm": run_job_publish_atm_query,
    "publish_partitioned": publish_partitioned_query,
    "publish_own_folders": publish_own_folders_query,
    "publish_rebalanced": publish_rebalanced_query,
    "recover_killed_run": recover_killed_run_query,
}


def tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)
