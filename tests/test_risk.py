import datetime as dt

from pyspark.sql import functions as F

from vigilo.functions import fixed
from vigilo.operators import risk
from vigilo.sources import exports, tables

C = F.col


def test_interval_clamps_and_squares(spark):
    df = spark.createDataFrame([(1.05, 0.1), (0.05, 0.1), (None, 0.1)], "p double, s double")
    rows = [tuple(round(v, 6) if v is not None else None for v in r[2:]) for r in risk.risk_interval(df, "p", "s").collect()]
    assert rows == [(1.0, 0.1, 0.95, 1.0), (0.05, 0.1, 0.0, 0.15), (None, 0.1, None, None)]
    wide = spark.createDataFrame([(0.5, 0.2), (0.5, 0.3)], "p double, s double")
    assert sorted(round(r["yhatError"], 6) for r in risk.risk_interval(wide, "p", "s").collect()) == [0.04, 0.09]


def test_flag_order_at_the_threshold(spark):
    rows = [(0.3, 0.2, 0.4), (0.4, 0.3, 0.5), (0.5, 0.4, 0.6), (0.9, 0.8, 1.0), (0.0, 0.5, 0.6), (None, 0.1, 0.2)]
    df = spark.createDataFrame(rows, "yhat double, flag_low double, flag_high double")
    got = [r["flag"] for r in risk.risk_flag(df, F.lit(0.4)).collect()]
    assert got == ["Low", "Moderate", "Moderate", "High", "None", "Missing"]


def test_attendance_days(spark):
    df = spark.createDataFrame([(1.02,), (0.9333,), (0.95,), (0.5,), (None,)], "ATT_RATE double")
    got = [(r["daysmissed"], r["attendance"]) for r in risk.attendance_band(df).collect()]
    assert got == [(0.0, "Low"), (12.0, "Low"), (9.0, "Low"), (90.0, "High"), (None, "Missing")]


def test_mobility_ladder(spark):
    df = spark.createDataFrame([(1, 5), (2, 1), (2, 2), (3, 3), (3, 2), (None, 2)], "SCHOOL_COUNT int, ENROLLMENTS_COUNT int")
    assert [r["mobility"] for r in risk.mobility_band(df).collect()] == ["Low", "Low", "Moderate", "High", "Moderate", "Low"]


def test_discipline_with_one_count_has_no_high(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0)], "incCount double, daysRemoved double")
    assert [r["discipline"] for r in risk.discipline_band(df).collect()] == ["Low", "Moderate"]
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 1.0)], "incCount double, daysRemoved double")
    assert [r["discipline"] for r in risk.discipline_band(df).collect()] == ["Low", "Moderate", "High"]


def test_assessment_bands_partition(spark):
    rows = [("Moderate", float(m), 10.0) for m in (1, 2, 3, 4)] + [("Low", 9.0, 10.0), ("High", 0.0, 5.0), ("Low", None, 1.0)]
    df = spark.createDataFrame(rows, "flag string, MATH_SS double, READ_SS double")
    got = [r["assessments"] for r in risk.assessment_band(df).collect()]
    assert got == ["High", "Moderate", "Moderate", "Low", "Low", "High", "Missing"]


def banded(spark):
    rows = [(k, f"w{k}", k / 10, 0.05, 10.0 * k, 5.0 * k, 0.9, -2.3, -4.6, 1 + k % 3, 1 + k % 3, 180) for k in range(1, 10)]
    df = spark.createDataFrame(rows, "STUDENT_KEY long, WSN string, pred double, se double, MATH_SS double, READ_SS double, ATT_RATE double, incCount double, daysRemoved double, SCHOOL_COUNT long, ENROLLMENTS_COUNT long, DAYS_POSS long")
    return risk.risk_bands(df, F.lit(0.5))


def test_export_layout_and_roundtrip(spark, tmp_path):
    out = risk.risk_export(
        banded(spark), grade=F.lit(7), year=F.lit("2013-2014"), prelim=True, run_time=F.lit("2014-05-31 10:00:00").cast("timestamp")
    )
    assert tuple(out.columns) == fixed.EXPORT_COLUMNS and len(out.columns) == 29
    first = out.where("X = 1").first()
    assert first["STUDENT_KEY"] == 1 and first["MODEL_NAME"] == "Grade 7 Preliminary"
    assert first["STUDENT_RISK_MEASURE_VALUE_Disc2"] is None
    out = out.withColumn("WSN", F.when(C("X") == 1, "a,b").when(C("X") > 2, C("WSN")))
    path = str(tmp_path / "out")
    exports.write_export(out, path, partition_by=["GRADE_LEVEL"])
    back = exports.read_export(spark, path, out.schema)
    assert back.columns == out.columns
    rows = {r["X"]: r for r in back.collect()}
    assert len(rows) == 9 and rows[1]["WSN"] == "a b" and rows[2]["WSN"] is None
    text = "".join(p.read_text() for p in (tmp_path / "out").rglob("*.csv"))
    assert '"' not in text


def test_lifecycle(spark):
    df = spark.createDataFrame([(1, "2012-2013"), (1, "2013-2014"), (2, "2012-2013")], "k int, y string")
    out = risk.risk_lifecycle(df, "k", year="y", run_date=F.lit(dt.date(2014, 5, 31)))
    assert {(r["k"], r["y"], r["status"]) for r in out.collect()} == {
        (1, "2012-2013", "Inactive"), (1, "2013-2014", "Active"), (2, "2012-2013", "Active")}
    assert out.first()["expires"] == dt.date(2015, 5, 31)


def test_table_columns_and_staging(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in tables.table_columns(df).collect()] == [(1, "a", "int", 2), (2, "b", "string", 1)]
    assert tables.stage(df, "t").exceptAll(df).count() == 0
