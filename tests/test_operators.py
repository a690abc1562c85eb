"""Table-level operators: normalisation, quality reports, reconciliation, and their plans."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from fieldnorm import (
    ATM_SPECS,
    POS_SPECS,
    FieldSpec,
    QualityError,
    normalize,
    output_quality,
    output_widths,
    preview,
    quality_pass,
    reconcile,
    require_clean,
    source_quality,
    tune,
)
from fieldnorm.registered.raw_views import raw_atm, raw_pos, raw_pos_dirty
from fieldnorm.session import HUGE_METHOD_LIMIT, JIT_LIMIT

SMALL = "/root/testdata/sf0.001"


def test_specs_are_checked(spark):
    df = spark.createDataFrame([("1", "2")], "a string, A2 string")
    with pytest.raises(ValueError, match="unsupported operation 'UPPER'"):
        FieldSpec("a", "UPPER")
    with pytest.raises(ValueError, match="date_column"):
        FieldSpec("a", "TIMESTAMP")
    with pytest.raises(ValueError, match="date_column"):
        FieldSpec("a", "DATE", date_column="b")
    with pytest.raises(ValueError, match="empty"):
        normalize(df, [])
    with pytest.raises(ValueError, match=r"missing from the source: \['b', 'c'\]"):
        source_quality(df, [FieldSpec("c", "DATE"), FieldSpec("b", "AMOUNT"), FieldSpec("a", "DATE")])
    with pytest.raises(ValueError, match="a: linked date column d is missing"):
        source_quality(df, [FieldSpec("a", "TIMESTAMP", date_column="d")])
    with pytest.raises(ValueError, match="more than once"):
        normalize(df, [FieldSpec("a", "DATE"), FieldSpec("A", "AMOUNT")])
    twins = df.select("a", F.col("A2").alias("A"))
    with pytest.raises(ValueError, match="ambiguous"):
        normalize(twins, [FieldSpec("a", "DATE")])


def test_widths():
    assert output_widths(POS_SPECS) == {
        "TRN_BGN_DATE": 10,
        "POST_DATE": 10,
        "AINT_SETL_DATE": 10,
        "IINT_SETL_DATE": 10,
        "TRN_BGN_TIME": 19,
        "AMT_1": 21,
        "AMT_2": 21,
    }
    assert output_widths([FieldSpec("c", "TRUNCATE_LAST_2")]) == {"c": 19}


def test_order_case_and_other_columns_are_kept(spark):
    df = spark.createDataFrame(
        [(1, " x ", "250131", "12345678", 2.5, None)], "n int, s string, d string, t string, f double, e string"
    )
    out = normalize(df, [FieldSpec("T", "TIMESTAMP", date_column="D"), FieldSpec("D", "DATE")])
    assert out.columns == df.columns
    assert tuple(out.first()) == (1, "x", "31_01-2025", "31_01-2025 12:34:56", 2.5, None)
    assert [t for _, t in out.dtypes] == ["int", "string", "string", "string", "double", "string"]


def test_linked_date_need_not_be_normalised(spark):
    df = spark.createDataFrame([(" 250131 ", "12345678")], "d string, t string")
    out = normalize(df, [FieldSpec("t", "TIMESTAMP", date_column="d")]).first()
    assert (out.d, out.t) == ("250131", "31_01-2025 12:34:56")


def test_helper_names_do_not_collide(spark):
    df = spark.createDataFrame([("250131", "mine")], "d string, _field_text_d string")
    assert tuple(normalize(df, [FieldSpec("d", "DATE")]).first()) == ("31_01-2025", "mine")


def test_what_a_second_run_would_do(spark):
    df = spark.createDataFrame([("250131", "12345678", "501")], "d string, t string, a string")
    specs = [FieldSpec("d", "DATE"), FieldSpec("t", "TIMESTAMP", date_column="d"), FieldSpec("a", "AMOUNT")]
    report = source_quality(normalize(df, specs), specs).first()
    assert (report.BAD_d, report.BAD_t, report.NO_DATE_t, report.BAD_a) == (1, 1, 1, 1)
    whole = spark.createDataFrame([("5.00",)], "a string")
    assert source_quality(whole, specs[2:]).first().BAD_a == 0  # silently five minor units


def test_empty_table_is_clean(spark):
    empty = raw_pos(spark, SMALL).where("false")
    assert set(require_clean(source_quality(empty, POS_SPECS), "source")) == set(source_quality(empty, POS_SPECS).columns)
    assert quality_pass(empty, POS_SPECS).first().ROWS == 0


def test_one_pass_equals_the_separate_reports(spark):
    raw = raw_pos_dirty(spark, SMALL)
    both = quality_pass(raw, POS_SPECS).first().asDict()
    assert both.pop("ROWS") == raw.count()
    source = source_quality(raw, POS_SPECS).first().asDict()
    output = output_quality(normalize(raw, POS_SPECS), POS_SPECS).first().asDict()
    dates = [spec.column for spec in POS_SPECS if spec.op == "DATE"]
    blank = {spec.column: ["", "000000"] if spec.column in dates else [""] for spec in POS_SPECS}
    present = {f"FILLED_{name}": raw.where(~F.trim(name).isin(values)).count() for name, values in blank.items()}
    assert both == source | present | {f"OUTPUT_{name}": count for name, count in output.items()}


def test_output_shapes(spark):
    rows = [
        ("31_01-2025", "31_01-2025 12:34:56", "-0.05", "123"),
        (None, None, None, None),
        ("", "", "", ""),
        ("2025-01-31", "31_01-2025", "5", "1" * 18),
        ("31-01-2025", "31_01-2025 1:2:3", "1.234", "12a"),
    ]
    df = spark.createDataFrame(rows, "d string, t string, a string, c string")
    specs = [
        FieldSpec("d", "DATE"),
        FieldSpec("t", "TIMESTAMP", date_column="d"),
        FieldSpec("a", "AMOUNT"),
        FieldSpec("c", "TRUNCATE_LAST_2"),
    ]
    assert output_quality(df, specs).first().asDict() == {"BAD_d": 2, "BAD_t": 2, "BAD_a": 2, "BAD_c": 2}


def test_gate_names_every_counter(spark):
    report = quality_pass(raw_pos_dirty(spark, SMALL), POS_SPECS).first()
    with pytest.raises(QualityError, match="source check failed") as error:
        require_clean(report, "source check", prefix="")
    assert error.value.counts["BAD_POST_DATE"] == 15
    assert "ROWS" not in error.value.counts
    require_clean(report, "output check", prefix="OUTPUT_")


def test_reconcile(spark):
    ten, nine = spark.range(10), spark.range(9)
    assert tuple(reconcile(ten, ten).first()) == (10, 10, True)
    assert tuple(reconcile(ten, nine).first()) == (10, 9, False)
    assert tuple(reconcile(ten.where("false"), nine.where("false")).first()) == (0, 0, True)


def test_preview(spark):
    raw = raw_pos(spark, SMALL)
    shown = preview(raw, POS_SPECS, key="k")
    assert shown.columns == [spec.column for spec in POS_SPECS]
    assert shown.count() == 20
    assert [row.AMT_2 for row in shown.take(3)] == ["0.00", "0.01", "0.02"]
    assert preview(raw, POS_SPECS, rows=5).count() == 5


def test_round_trip(spark, ansi):
    """Encode random dates, times and cents, normalise, and read the text back."""
    dice = random.Random(7)
    rows = []
    for i in range(500):
        year, month, day = dice.randint(1970, 2069), dice.randint(1, 12), dice.randint(1, 28)
        hour, minute, second = dice.randint(0, 23), dice.randint(0, 59), dice.randint(0, 59)
        cents = dice.randint(-(10**19) + 1, 10**19 - 1) // 10 ** dice.randint(0, 18)
        styles = (
            f"{year % 100:02}{month:02}{day:02}",
            f"{year}{month:02}{day:02}",
            f"{year}-{month:02}-{day:02}",
            f"{year}-{month:02}-{day:02} 01:02:03.4",
        )
        encoded = styles[i % 4] if f"{year % 100:02}{month:02}{day:02}" != "000000" else styles[1]
        time = f"{hour:02}{minute:02}{second:02}{dice.randint(0, 99):02}"
        clock = f"{day:02}_{month:02}-{year}"
        amount = f"{'-' if cents < 0 else ''}{abs(cents) // 100}.{abs(cents) % 100:02}"
        rows.append((encoded, time, str(cents), clock, f"{clock} {hour:02}:{minute:02}:{second:02}", amount))
    df = spark.createDataFrame(rows, "d string, t string, a string, wd string, wt string, wa string")
    specs = [FieldSpec("d", "DATE"), FieldSpec("t", "TIMESTAMP", date_column="d"), FieldSpec("a", "AMOUNT")]
    require_clean(quality_pass(df, specs), "round trip")
    assert normalize(df, specs).where("not (d <=> wd and t <=> wt and a <=> wa)").count() == 0


def test_normalize_works_on_a_file_stream(spark, tmp_path):
    raw = raw_pos(spark, SMALL)
    raw.write.parquet(str(tmp_path / "in"))
    stream = normalize(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in")), POS_SPECS)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(normalize(raw, POS_SPECS)).count() == 0


def printed_plan(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_normalize_is_one_narrow_pass(spark):
    plan = printed_plan(normalize(raw_pos(spark, SMALL), POS_SPECS), "formatted")
    assert "Exchange" not in plan and "Python" not in plan
    scans = re.findall(r"ReadSchema: (.*)", plan)
    assert len(scans) == 1 and "o_custkey" not in scans[0]


def test_quality_pass_scans_once_and_reads_what_it_needs(spark):
    raw = raw_pos(spark, SMALL)
    plan = printed_plan(quality_pass(raw, POS_SPECS), "formatted")
    scans = re.findall(r"ReadSchema: (.*)", plan)
    assert len(scans) == 1 and "o_orderpriority" not in scans[0]
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1


def test_preview_converts_after_the_limit(spark):
    plan = printed_plan(preview(raw_pos(spark, SMALL), POS_SPECS, key="k"), "simple")
    assert "TakeOrderedAndProject(limit=20" in plan
    assert "Exchange" not in plan and "Sort" not in plan
    assert "RLIKE" not in plan[plan.index("TakeOrderedAndProject") :].split("\n", 1)[1]


@pytest.mark.parametrize("build", [normalize, quality_pass, source_quality])
@pytest.mark.parametrize("raw, specs", [(raw_pos, POS_SPECS), (raw_atm, ATM_SPECS)], ids=["pos", "atm"])
def test_presets_stay_compilable(spark, tmp_path, build, raw, specs):
    raw(spark, SMALL).write.parquet(str(tmp_path / "raw"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = printed_plan(build(spark.read.parquet(str(tmp_path / "raw")), specs), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < JIT_LIMIT


def test_tune_keeps_a_lower_limit(spark):
    before = spark.conf.get(HUGE_METHOD_LIMIT)
    try:
        spark.conf.set(HUGE_METHOD_LIMIT, "65535")
        tune(spark)
        assert spark.conf.get(HUGE_METHOD_LIMIT) == "8000"
        spark.conf.set(HUGE_METHOD_LIMIT, "4000")
        tune(spark)
        assert spark.conf.get(HUGE_METHOD_LIMIT) == "4000"
    finally:
        spark.conf.set(HUGE_METHOD_LIMIT, before)
