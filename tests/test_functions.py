from pyspark.sql import functions as F

from vigilo.functions import fixed, recode, schoolyear
from vigilo.functions.hashing import unit_hash

C = F.col


def one(spark, value, kind, col):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col.alias("y")).first()["y"]


def test_school_years(spark):
    assert one(spark, "2009-2010", "string", schoolyear.short_year(C("x"))) == "2009-10"
    assert one(spark, "2009-2010", "string", schoolyear.expected_grad(C("x"), F.lit("08"))) == "2013-2014"


def test_known_outcome_by_grade(spark):
    years = [(f"{y}-{y + 1}", g) for y in range(2005, 2011) for g in range(4, 11)]
    df = spark.createDataFrame(years, "y string, g int")
    got = {}
    for r in df.where(schoolyear.has_known_outcome(C("y"), C("g"))).collect():
        got.setdefault(r["g"], []).append(r["y"][:4])
    last = {g: max(v) for g, v in got.items()}
    assert last == {5: "2006", 6: "2007", 7: "2008", 8: "2009", 9: "2009", 10: "2009"}


def test_bands_are_ordered_and_keep_missing(spark):
    band = recode.band(C("x"), fixed.LANGUAGE_CUTS, fixed.LANGUAGE_LABELS)
    df = spark.createDataFrame([(v,) for v in (1, 3, 4, 5, 6, 7, 9, None)], "x int").select(band.alias("b"))
    assert [r["b"] for r in df.collect()] == ["Low", "Medium", "Medium", "High", "High", "Native", "Native", None]
    right = recode.band(C("x"), (12, 20), ("Low", "Moderate", "High"), closed="right")
    df = spark.createDataFrame([(12.0,), (12.1,), (20.0,), (20.1,)], "x double").select(right.alias("b"))
    assert [r["b"] for r in df.collect()] == ["Low", "Moderate", "Moderate", "High"]


def test_flags_maps_and_rates(spark):
    flag = recode.flag(C("x"), {"Yes": "Y", "@NR": "Unk"}, "N")
    df = spark.createDataFrame([("Yes",), ("@NR",), ("No",), (None,)], "x string").select(flag.alias("b"))
    assert [r["b"] for r in df.collect()] == ["Y", "Unk", "N", None]
    assert one(spark, "HG", "string", recode.recode_map(C("x"), fixed.INCIDENT_GROUPS)) == "Weapon"
    assert one(spark, "ZZ", "string", recode.recode_map(C("x"), fixed.INCIDENT_GROUPS)) == "ZZ"
    assert one(spark, 0, "int", recode.attendance_rate(F.lit(3), C("x"))) is None
    assert one(spark, 90, "int", recode.attendance_rate(F.lit(9), C("x"))) == 0.9


def test_contains_flags_keep_missing(spark):
    flags = recode.contains_flags(C("x"), fixed.INCIDENT_FLAGS)
    df = spark.createDataFrame([("Drug-Weapon",), ("None",), (None,)], "x string").select(
        *[c.alias(n) for n, c in flags.items()]
    )
    rows = [tuple(r) for r in df.collect()]
    assert rows == [(0, 1, 1, 0), (0, 0, 0, 0), (None,) * 4]


def test_shifted_log_round_trip(spark):
    back = recode.unshifted(recode.shifted_log(C("x"), 0.1), 0.1)
    assert abs(one(spark, 7.0, "double", back) - 7.0) < 1e-12


def test_unit_hash_is_uniform_and_stable(spark):
    df = spark.range(4000).select(unit_hash(C("id")).alias("u"))
    row = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] and row[1] < 1 and abs(row[2] - 0.5) < 0.02
    assert df.exceptAll(spark.range(4000).select(unit_hash(C("id")).alias("u"))).count() == 0


def test_row_wise_operators_run_on_streams(spark, tmp_path):
    from vigilo.operators import risk

    rows = spark.createDataFrame([(0.95,), (0.5,), (None,)], "ATT_RATE double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = risk.attendance_band(stream).writeStream.format("memory").queryName("bands").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["attendance"] for r in spark.table("bands").collect()) == ["High", "Low", "Missing"]


def test_task_functions_need_no_installed_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from vigilo.operators import nearest

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(nearest._coords))
    code = "from pyspark import cloudpickle; print(cloudpickle.load(open('f.pkl', 'rb')).__name__)"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin"}, capture_output=True, text=True)
    assert got.stdout.strip() == "_coords", got.stderr
