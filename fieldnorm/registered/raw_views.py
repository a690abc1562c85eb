"""Raw transaction tables derived row by row from the given ``orders`` and ``events``.

Text is cut from the printed form of the zone-free timestamps, so the encodings do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint").cast("string")


def _two_digits(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def raw_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card-terminal rows from ``orders``: every accepted date encoding, blanks, sentinels,
    signed amounts and amounts with a zero fraction."""
    rows = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 19).alias("stamp"),
        _cents(F.col("o_totalprice")).alias("cents"),
        "o_orderpriority",
    )
    rows = rows.withColumn("dashed", F.substring("stamp", 1, 10))
    rows = rows.withColumn("long", F.translate("dashed", "-", ""))
    rows = rows.withColumn("short", F.substring("long", 3, 6))
    key, stamp, cents, dashed, long, short = map(F.col, ("k", "stamp", "cents", "dashed", "long", "short"))

    style = key % 6
    begin_date = (
        F.when(style == 0, short)
        .when(style == 1, long)
        .when(style == 2, dashed)
        .when(style == 3, stamp)
        .when(style == 4, F.concat(F.lit("  "), short, F.lit(" ")))
        .when(key % 12 == 5, "000000")
    )
    begin_time = F.when(style == 5, "").otherwise(
        F.concat(_two_digits(key % 24), _two_digits(key % 60), _two_digits(key * 7 % 60), _two_digits(key % 100))
    )
    first_amount = (
        F.when(key % 10 == 2, " ")
        .when(key % 10 == 0, F.concat(F.lit("-"), cents))
        .when(key % 10 == 1, F.concat(cents, F.lit(".00")))
        .otherwise(cents)
    )
    return rows.select(
        key,
        begin_date.alias("TRN_BGN_DATE"),
        begin_time.alias("TRN_BGN_TIME"),
        long.alias("POST_DATE"),
        short.alias("AINT_SETL_DATE"),
        dashed.alias("IINT_SETL_DATE"),
        first_amount.alias("AMT_1"),
        key.cast("string").alias("AMT_2"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("NOTE"),
    )


def raw_pos_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_pos`` with one broken field in eight of every hundred rows."""
    broken = {
        "TRN_BGN_DATE": {7: "251301", 77: "00000000"},
        "TRN_BGN_TIME": {17: "25000000", 27: "1234"},
        "AMT_1": {37: "12a", 47: "12345678901234567890", 57: "500.50"},
        "POST_DATE": {67: "20250230"},
    }

    return _overwritten(raw_pos(spark, sf_dir), broken)


def _overwritten(rows: DataFrame, broken: dict[str, dict[int, str]]) -> DataFrame:
    """Values put over those of the rows whose key has these last two digits."""
    slot = F.col("k") % 100

    def overwrite(name: str) -> Column:
        value = F.col(name)
        for at, text in broken[name].items():
            value = F.when(slot == at, text).otherwise(value)
        return value

    return rows.withColumns({name: overwrite(name) for name in broken})


def raw_atm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash-machine rows from ``events``: dates with a time part, hundredths of a second."""
    rows = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("k"),
        F.col("ts").cast("string").alias("stamp"),
        _cents(F.col("value")).alias("cents"),
        "event_type",
    )
    rows = rows.withColumn("dashed", F.substring("stamp", 1, 10))
    rows = rows.withColumn("long", F.translate("dashed", "-", ""))
    key, stamp, cents, dashed, long = map(F.col, ("k", "stamp", "cents", "dashed", "long"))
    hundredths = F.rpad(F.substring(stamp, 21, 2), 2, "0")
    return rows.select(
        key,
        F.substring(long, 3, 6).alias("DATE_TRN_BGN"),
        long.alias("POST_DATE"),
        stamp.alias("ACQ_ICHG_SETL_DATE"),
        F.when(key % 7 == 0, "000000").otherwise(dashed).alias("ISS_ICHG_SETL_DATE"),
        F.concat(F.translate(F.substring(stamp, 12, 8), ":", ""), hundredths).alias("TRN_ENTY_TIME"),
        cents.alias("AMT_1"),
        key.cast("string").alias("AMT_2"),
        F.when(F.col("event_type") == "purchase", cents).alias("AMT_3"),
    )


def raw_atm_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_atm`` with broken dates, times and amounts, one in eight of every hundred rows."""
    broken = {
        "DATE_TRN_BGN": {7: "251399", 17: "2024-02-30"},
        "TRN_ENTY_TIME": {27: "24000000", 37: "123456"},
        "ISS_ICHG_SETL_DATE": {47: "2024/01/02"},
        "AMT_1": {57: "1e5"},
        "AMT_3": {67: "12a", 77: "99999999999999999999"},
    }
    return _overwritten(raw_atm(spark, sf_dir), broken)


def raw_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys as text codes that end in ``00``; every seventh is blank."""
    key = F.col("o_orderkey")
    code = F.when(key % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), (key + 1).cast("string"), F.lit("00")))
    return read_table(spark, sf_dir, "orders").select(key.alias("k"), code.alias("CODE"))


def raw_codes_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_codes`` with codes of another ending, length or alphabet."""
    broken = {"CODE": {7: "12301", 37: "00", 47: "12345678901234567800", 57: "12a00"}}
    return _overwritten(raw_codes(spark, sf_dir), broken)


def raw_pos_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_pos`` with a text column whose values are written escaped in paths."""
    slot = F.col("k") % 4
    place = F.when(slot == 0, "a b").when(slot == 1, "10:00").when(slot == 2, " x ")
    return raw_pos(spark, sf_dir).withColumn("PLACE", place)
