"""DuckDB SQL for the registered queries, written against the given tables alone.

The raw views are built again in SQL, and the fields are decoded by DuckDB's own functions
(``try_strptime``, ``strftime``, ``TRY_CAST``).
"""

from __future__ import annotations

POS_RAW = """
raw AS (
  SELECT
    o_orderkey AS k,
    CASE o_orderkey % 6
      WHEN 0 THEN strftime(o_orderdate, '%y%m%d')
      WHEN 1 THEN strftime(o_orderdate, '%Y%m%d')
      WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      WHEN 4 THEN '  ' || strftime(o_orderdate, '%y%m%d') || ' '
      ELSE CASE WHEN o_orderkey % 12 = 5 THEN '000000' END
    END AS TRN_BGN_DATE,
    CASE WHEN o_orderkey % 6 = 5 THEN '' ELSE
      lpad((o_orderkey % 24)::VARCHAR, 2, '0') || lpad((o_orderkey % 60)::VARCHAR, 2, '0')
      || lpad((o_orderkey * 7 % 60)::VARCHAR, 2, '0') || lpad((o_orderkey % 100)::VARCHAR, 2, '0')
    END AS TRN_BGN_TIME,
    strftime(o_orderdate, '%Y%m%d') AS POST_DATE,
    strftime(o_orderdate, '%y%m%d') AS AINT_SETL_DATE,
    strftime(o_orderdate, '%Y-%m-%d') AS IINT_SETL_DATE,
    CASE o_orderkey % 10
      WHEN 2 THEN ' '
      WHEN 0 THEN '-' || round(o_totalprice * 100)::BIGINT::VARCHAR
      WHEN 1 THEN round(o_totalprice * 100)::BIGINT::VARCHAR || '.00'
      ELSE round(o_totalprice * 100)::BIGINT::VARCHAR
    END AS AMT_1,
    o_orderkey::VARCHAR AS AMT_2,
    '  ' || o_orderpriority || ' ' AS NOTE
  FROM orders
)"""

POS_DIRTY = POS_RAW.replace("raw AS", "clean AS", 1) + """,
raw AS (
  SELECT * REPLACE (
    CASE k % 100 WHEN 7 THEN '251301' WHEN 77 THEN '00000000' ELSE TRN_BGN_DATE END AS TRN_BGN_DATE,
    CASE k % 100 WHEN 17 THEN '25000000' WHEN 27 THEN '1234' ELSE TRN_BGN_TIME END AS TRN_BGN_TIME,
    CASE k % 100 WHEN 67 THEN '20250230' ELSE POST_DATE END AS POST_DATE,
    CASE k % 100 WHEN 37 THEN '12a' WHEN 47 THEN '12345678901234567890' WHEN 57 THEN '500.50' ELSE AMT_1 END AS AMT_1
  ) FROM clean
)"""

ATM_RAW = """
raw AS (
  SELECT
    event_id AS k,
    strftime(ts, '%y%m%d') AS DATE_TRN_BGN,
    strftime(ts, '%Y%m%d') AS POST_DATE,
    ts::VARCHAR AS ACQ_ICHG_SETL_DATE,
    CASE WHEN event_id % 7 = 0 THEN '000000' ELSE strftime(ts, '%Y-%m-%d') END AS ISS_ICHG_SETL_DATE,
    strftime(ts, '%H%M%S') || left(strftime(ts, '%f'), 2) AS TRN_ENTY_TIME,
    round(value * 100)::BIGINT::VARCHAR AS AMT_1,
    event_id::VARCHAR AS AMT_2,
    CASE WHEN event_type = 'purchase' THEN round(value * 100)::BIGINT::VARCHAR END AS AMT_3
  FROM events
)"""

ATM_DIRTY = ATM_RAW.replace("raw AS", "clean AS", 1) + """,
raw AS (
  SELECT * REPLACE (
    CASE k % 100 WHEN 7 THEN '251399' WHEN 17 THEN '2024-02-30' ELSE DATE_TRN_BGN END AS DATE_TRN_BGN,
    CASE k % 100 WHEN 27 THEN '24000000' WHEN 37 THEN '123456' ELSE TRN_ENTY_TIME END AS TRN_ENTY_TIME,
    CASE k % 100 WHEN 47 THEN '2024/01/02' ELSE ISS_ICHG_SETL_DATE END AS ISS_ICHG_SETL_DATE,
    CASE k % 100 WHEN 57 THEN '1e5' ELSE AMT_1 END AS AMT_1,
    CASE k % 100 WHEN 67 THEN '12a' WHEN 77 THEN '99999999999999999999' ELSE AMT_3 END AS AMT_3
  ) FROM clean
)"""

CODES_RAW = """
raw AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 7 = 0 THEN '  ' ELSE ' ' || (o_orderkey + 1)::VARCHAR || '00' END AS CODE
  FROM orders
)"""

CODES_DIRTY = CODES_RAW.replace("raw AS", "clean AS", 1) + """,
raw AS (
  SELECT k, CASE k % 100 WHEN 7 THEN '12301' WHEN 37 THEN '00' WHEN 47 THEN '12345678901234567800'
    WHEN 57 THEN '12a00' ELSE CODE END AS CODE
  FROM clean
)"""


def _date(name: str) -> str:
    x = f"trim({name})"
    return f"""(CASE
      WHEN {x} IN ('', '000000') THEN NULL
      WHEN regexp_full_match({x}, '[0-9]{{6}}')
        THEN try_strptime((CASE WHEN {x}[1:2] < '70' THEN '20' ELSE '19' END) || {x}, '%Y%m%d')
      WHEN regexp_full_match({x}, '[0-9]{{8}}') THEN try_strptime({x}, '%Y%m%d')
      WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}($|[ T])') THEN try_strptime({x}[1:10], '%Y-%m-%d')
    END)::DATE"""


def _date_text(name: str) -> str:
    return f"strftime({_date(name)}, '%d_%m-%Y')"


def _time_text(name: str, day: str) -> str:
    x = f"trim({name})"
    return f"""CASE WHEN regexp_matches({x}, '^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]')
      THEN {_date_text(day)} || ' ' || {x}[1:2] || ':' || {x}[3:4] || ':' || {x}[5:6] END"""


def _units(name: str) -> str:
    return f"regexp_replace(trim({name}), '\\.0+$', '')"


def _amount_text(name: str) -> str:
    value = f"TRY_CAST({_units(name)} AS DECIMAL(19,0))"
    return f"""CASE WHEN trim({name}) <> ''
      THEN ({value} * CAST(0.01 AS DECIMAL(3,2)))::DECIMAL(21,2)::VARCHAR END"""


POS_COLUMNS = {
    "TRN_BGN_DATE": _date_text("TRN_BGN_DATE"),
    "TRN_BGN_TIME": _time_text("TRN_BGN_TIME", "TRN_BGN_DATE"),
    "POST_DATE": _date_text("POST_DATE"),
    "AINT_SETL_DATE": _date_text("AINT_SETL_DATE"),
    "IINT_SETL_DATE": _date_text("IINT_SETL_DATE"),
    "AMT_1": _amount_text("AMT_1"),
    "AMT_2": _amount_text("AMT_2"),
}
ATM_COLUMNS = {
    "DATE_TRN_BGN": _date_text("DATE_TRN_BGN"),
    "POST_DATE": _date_text("POST_DATE"),
    "ACQ_ICHG_SETL_DATE": _date_text("ACQ_ICHG_SETL_DATE"),
    "ISS_ICHG_SETL_DATE": _date_text("ISS_ICHG_SETL_DATE"),
    "TRN_ENTY_TIME": _time_text("TRN_ENTY_TIME", "DATE_TRN_BGN"),
    "AMT_1": _amount_text("AMT_1"),
    "AMT_2": _amount_text("AMT_2"),
    "AMT_3": _amount_text("AMT_3"),
}


def _select(columns: dict[str, str]) -> str:
    return ",\n    ".join(f"{value} AS {name}" for name, value in columns.items())


def _bad_date(name: str) -> dict[str, str]:
    return {f"BAD_{name}": f"trim({name}) NOT IN ('', '000000') AND {_date(name)} IS NULL"}


def _bad_time(name: str, day: str) -> dict[str, str]:
    x = f"trim({name})"
    shape = "([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9][0-9][0-9]"
    return {
        f"BAD_{name}": f"{x} <> '' AND NOT regexp_full_match({x}, '{shape}')",
        f"NO_DATE_{name}": f"{x} <> '' AND {_date(day)} IS NULL",
    }


def _bad_amount(name: str) -> dict[str, str]:
    filled = f"trim({name}) <> ''"
    return {
        f"BAD_{name}": f"{filled} AND NOT regexp_full_match({_units(name)}, '-?[0-9]+')",
        f"OVERFLOW_{name}": f"{filled} AND TRY_CAST({_units(name)} AS DECIMAL(19,0)) IS NULL",
    }


POS_FAULTS = {
    **_bad_date("TRN_BGN_DATE"),
    **_bad_date("POST_DATE"),
    **_bad_date("AINT_SETL_DATE"),
    **_bad_date("IINT_SETL_DATE"),
    **_bad_time("TRN_BGN_TIME", "TRN_BGN_DATE"),
    **_bad_amount("AMT_1"),
    **_bad_amount("AMT_2"),
}
ATM_FAULTS = {
    **_bad_date("DATE_TRN_BGN"),
    **_bad_date("POST_DATE"),
    **_bad_date("ACQ_ICHG_SETL_DATE"),
    **_bad_date("ISS_ICHG_SETL_DATE"),
    **_bad_time("TRN_ENTY_TIME", "DATE_TRN_BGN"),
    **_bad_amount("AMT_1"),
    **_bad_amount("AMT_2"),
    **_bad_amount("AMT_3"),
}

_RAW_ORDER = ("TRN_BGN_DATE", "TRN_BGN_TIME", "POST_DATE", "AINT_SETL_DATE", "IINT_SETL_DATE", "AMT_1", "AMT_2")
#: The output widths of dates, timestamps and amounts.
_WIDTHS = {"dd": 10, "time": 19, "amount": 21}
_DATE_SHAPE = "[0-9]{2}_[0-9]{2}-[0-9]{4}"


def _shape(name: str) -> str:
    if name.startswith("AMT"):
        return "-?[0-9]+[.][0-9]{2}"
    return _DATE_SHAPE + (" [0-9]{2}:[0-9]{2}:[0-9]{2}" if name.endswith("TIME") else "")


def _misshapen(columns: dict[str, str], prefix: str) -> dict[str, str]:
    """Counters over the given expressions, by column name."""
    return {
        f"{prefix}BAD_{name}": f"({value}) <> '' AND NOT regexp_full_match({value}, '{_shape(name)}')"
        for name, value in columns.items()
    }


def _filled(columns: dict[str, str]) -> dict[str, str]:
    """Counters of the values that must not become null."""
    return {
        f"FILLED_{name}": f"trim({name}) <> ''" + (f" AND trim({name}) <> '000000'" if "dd" in _kind(name) else "")
        for name in columns
    }


def _kind(name: str) -> str:
    """What a mapped column of the presets holds, as a pattern of its normalised text."""
    return "amount" if name.startswith("AMT") else "time" if name.endswith("TIME") else "dd"


def _counts(faults: dict[str, str]) -> str:
    return _select({name: f"count(*) FILTER (WHERE {fault})" for name, fault in faults.items()})


POS_NORMALIZED = f"""WITH {POS_RAW}
  SELECT k,
    {_select(POS_COLUMNS)},
    trim(NOTE) AS NOTE
  FROM raw"""

_TRIMMED = _select({name: f"trim({name})" for name in (*POS_COLUMNS, "NOTE")})
_PREVIEW = f"WITH {POS_RAW} SELECT {_select(POS_COLUMNS)} FROM raw ORDER BY k LIMIT 20"

_PREVIEW_ATM = f"WITH {ATM_RAW} SELECT {_select(ATM_COLUMNS)} FROM raw ORDER BY k LIMIT 20"
_ATM_NORMALIZED = f"WITH {ATM_RAW} SELECT k, {_select(ATM_COLUMNS)} FROM raw"
_BAD_CODES = """count(*) FILTER (WHERE trim(CODE) <> '' AND NOT (regexp_full_match(trim(CODE), '[0-9]{3,19}')
        AND suffix(trim(CODE), '00'))) AS BAD_CODE"""
_PROFILES = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, column_name, row_number() OVER () AS ordinal, column_type FROM (DESCRIBE {table})"
    for table in ("customer", "lineitem", "orders", "part", "supplier")
)
#: Columns of the staged raw rows with the widths of their operations.
_STAGE_PROFILE = f"""SELECT unnest({["k", *_RAW_ORDER, "NOTE"]}) AS column_name, unnest(range(1, 10))::INTEGER AS ordinal,
  unnest({["bigint", *(f"varchar({_WIDTHS[_kind(name)]})" for name in _RAW_ORDER), "string"]}) AS data_type"""
_PARTITIONED = POS_NORMALIZED.replace(
    "trim(NOTE) AS NOTE",
    "trim(NOTE) AS NOTE, CASE k % 4 WHEN 0 THEN 'a b' WHEN 1 THEN '10:00' WHEN 2 THEN ' x ' END AS PLACE",
)
_SAME = ["k", *_RAW_ORDER, "NOTE"]
_COMPARED = f"""WITH {POS_RAW},
  changed AS (SELECT * REPLACE (CASE WHEN k % 5000 = 77 THEN '0' ELSE AMT_2 END AS AMT_2,
    CASE k WHEN 1 THEN '  5-LOW ' WHEN 2 THEN '  1-URGENT ' ELSE NOTE END AS NOTE) FROM raw),
  bags AS ({" UNION ALL ".join(f"SELECT '{name.upper()}' AS column_name, list_sort(list(coalesce(r.{name}::VARCHAR, chr(0)))) = "
    f"list_sort(list(coalesce(c.{name}::VARCHAR, chr(0)))) AS same FROM raw r JOIN changed c USING (k)" for name in _SAME)}
    UNION ALL SELECT 'ROW', NOT EXISTS (SELECT * FROM raw EXCEPT SELECT * FROM changed)),
  sized AS (SELECT count(*) AS n FROM raw)
  SELECT 'backup' AS "copy", column_name, n AS source_rows, n AS target_rows, true AS matched FROM bags, sized
  UNION ALL SELECT 'changed', column_name, n, n, same FROM bags, sized"""

_GROUPS = f"""WITH {POS_RAW}
SELECT CASE k % 4 WHEN 0 THEN 'a b' WHEN 1 THEN '10:00' WHEN 2 THEN ' x ' END AS PLACE, count(*) AS source_rows,
  CASE WHEN k % 4 <> 2 THEN count(*) END AS target_rows, k % 4 <> 2 AND count(*) FILTER (k % 8 = 1) = 0 AS matched
FROM raw GROUP BY k % 4"""

EXPECTED = {
    "parse_date": f"""WITH {POS_DIRTY}
      SELECT k, {_date('TRN_BGN_DATE')} AS begin_date, {_date('POST_DATE')} AS post_date FROM raw""",
    "date_text": f"""WITH {POS_DIRTY}
      SELECT k, {_date_text('TRN_BGN_DATE')} AS begin_date, {_date_text('POST_DATE')} AS post_date FROM raw""",
    "timestamp_text": f"""WITH {POS_DIRTY}
      SELECT k, {_time_text('TRN_BGN_TIME', 'TRN_BGN_DATE')} AS begin_time FROM raw""",
    "amount_text": f"""WITH {POS_DIRTY}
      SELECT k, {_amount_text('AMT_1')} AS amount_1, {_amount_text('AMT_2')} AS amount_2 FROM raw""",
    "truncate_last_2": """
      SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey + 1)::VARCHAR END AS code FROM orders""",
    "trim_strings": f"WITH {POS_RAW} SELECT k, {_TRIMMED} FROM raw",
    "normalize_pos": POS_NORMALIZED,
    "normalize_atm": f"WITH {ATM_RAW} SELECT k, {_select(ATM_COLUMNS)} FROM raw",
    "normalize_codes": """
      SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey + 1)::VARCHAR END AS CODE FROM orders""",
    "source_quality": f"WITH {POS_RAW} SELECT {_counts(POS_FAULTS)} FROM raw",
    "source_quality_dirty": f"WITH {POS_DIRTY} SELECT {_counts(POS_FAULTS)} FROM raw",
    "source_quality_dirty_atm": f"WITH {ATM_DIRTY} SELECT {_counts(ATM_FAULTS)} FROM raw",
    "source_quality_codes": f"WITH {CODES_RAW} SELECT {_BAD_CODES} FROM raw",
    "source_quality_dirty_codes": f"WITH {CODES_DIRTY} SELECT {_BAD_CODES} FROM raw",
    "output_quality_codes": f"""WITH {CODES_DIRTY}
      SELECT count(*) FILTER (WHERE code <> '' AND NOT regexp_full_match(code, '[0-9]{{1,17}}')) AS BAD_CODE
      FROM (SELECT left(trim(CODE), greatest(length(trim(CODE)) - 2, 0)::INT) AS code FROM raw)""",
    "output_quality": f"WITH {POS_RAW} SELECT {_counts(_misshapen(POS_COLUMNS, ''))} FROM raw",
    "output_quality_raw": f"""WITH {POS_RAW}
      SELECT {_counts(_misshapen({name: name for name in POS_COLUMNS}, ''))} FROM raw""",
    "quality_pass": f"""WITH {POS_DIRTY}
      SELECT count(*) AS ROWS, {_counts(POS_FAULTS)}, {_counts(_filled(POS_COLUMNS))},
        {_counts(_misshapen(POS_COLUMNS, 'OUTPUT_'))} FROM raw""",
    "quality_pass_atm": f"""WITH {ATM_RAW}
      SELECT count(*) AS ROWS, {_counts(ATM_FAULTS)}, {_counts(_filled(ATM_COLUMNS))},
        {_counts(_misshapen(ATM_COLUMNS, 'OUTPUT_'))} FROM raw""",
    "preview_mapped": _PREVIEW,
    "schema_profile": f"""
      SELECT table_name, column_name, ordinal::INTEGER AS ordinal,
        CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
          ELSE lower(column_type) END AS data_type,
        NULL::INTEGER AS length, NULL::INTEGER AS "precision", NULL::INTEGER AS scale
      FROM ({_PROFILES}) UNION ALL SELECT 'stage', column_name, ordinal, data_type,
        TRY_CAST(regexp_extract(data_type, '\\d+') AS INTEGER), NULL, NULL FROM ({_STAGE_PROFILE})""",
    "row_count_reconcile": "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS matched FROM orders",
    "copy_compare": _COMPARED,
    "compare_groups": _GROUPS,
    "backup_refresh": f"WITH {POS_RAW} SELECT * FROM raw",
    "stage_verified": POS_NORMALIZED,
    "publish_swap": POS_NORMALIZED,
    "run_job_dry": _PREVIEW,
    "run_job_publish": POS_NORMALIZED,
    "run_job_dry_atm": _PREVIEW_ATM,
    "run_job_publish_atm": _ATM_NORMALIZED,
    "publish_partitioned": _PARTITIONED,
    "publish_own_folders": _PARTITIONED,
    "publish_rebalanced": _PARTITIONED,
    "recover_killed_run": POS_NORMALIZED,
}
