"""Risk categories, the export and its quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import base as b
from bindings import cohorts
from vigilo.functions import fixed, schoolyear
from vigilo.operators import cleaning, peers, quality, risk
from vigilo.plans import early_warning as run
from vigilo.plans.control import control
from vigilo.plans.methods import candidate_methods
from vigilo.sources import exports
from vigilo.sources.tables import load, stage, staging_path

C = F.col
QUERIES = {}
ORACLE = {}
THRESHOLD = 0.4
WHEN = "2014-05-31 12:00:00"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def scored(spark, d, *, keep=True):
    """Every student-year with a score and an error from fixed formulas; some scores are missing."""
    people = load(spark, d, "customer").select(
        C("c_custkey").alias("STUDENT_KEY"), C("c_name").alias("WSN"), C("c_acctbal").alias("bal")
    )
    cleaned = cleaning.clean_pool(b.scoring_cohort(spark, d, keep=keep))
    return cleaned.join(people, "STUDENT_KEY").withColumns({
        "pred": F.when(~C("bal").between(5000, 5100), F.round((C("bal") + 1000) / 10500, 4)),
        "se": F.round(C("ENROLLMENTS_COUNT") * 0.04 + C("SCHOOL_COUNT") * 0.01, 4),
    }).drop("bal")


SCORED = b.SCORING + "," + b.clean_sql("scoring") + """,
scored AS (
  SELECT cleaned.*, c_name AS WSN,
    CASE WHEN NOT c_acctbal BETWEEN 5000 AND 5100 THEN round((c_acctbal + 1000) / 10500, 4) END AS pred,
    round(ENROLLMENTS_COUNT * CAST(0.04 AS DOUBLE) + SCHOOL_COUNT * CAST(0.01 AS DOUBLE), 4) AS se
  FROM cleaned JOIN customer ON STUDENT_KEY = c_custkey),
interval AS (
  SELECT *, least(pred, 1) AS yhat, e AS yhatError, greatest(pred - e, 0) AS flag_low, least(pred + e, 1) AS flag_high FROM (
    SELECT *, CASE WHEN median(se) OVER (PARTITION BY GRADE_KEY, SCHOOL_YEAR) > 0.15 THEN se * se ELSE se END AS e FROM scored)),
flagged AS (
  SELECT *, CASE WHEN pred IS NULL THEN 'Missing' WHEN flag_high <= 0.4 THEN 'Low'
    WHEN flag_high >= 0.4 AND flag_low <= 0.4 THEN 'Moderate' WHEN yhat <> 0 AND flag_low >= 0.4 THEN 'High'
    ELSE 'None' END AS flag FROM interval)
"""
_KEY = ["SCHOOL_YEAR", "STUDENT_KEY"]
COHORT = ["GRADE_KEY", "SCHOOL_YEAR"]


def _interval(spark, d):
    return risk.risk_interval(scored(spark, d), "pred", "se", by=COHORT)


def _flagged(spark, d):
    return risk.risk_flag(_interval(spark, d), F.lit(THRESHOLD))


# The SQL engine's least and greatest skip missing values, so missing scores are put back.
_INTERVAL_SELECT = ", ".join(
    f"CASE WHEN pred IS NOT NULL THEN {b.r(c)} END AS {c}" for c in ("yhat", "flag_low", "flag_high")
) + f", {b.r('yhatError')} AS yhatError"


@query("risk_interval", "WITH " + SCORED + f"SELECT SCHOOL_YEAR, STUDENT_KEY, {_INTERVAL_SELECT} FROM interval")
def risk_interval(spark, d):
    return b.rounded(_interval(spark, d).select(*_KEY, "yhat", "flag_low", "flag_high", "yhatError"))


@query("risk_flag", "WITH " + SCORED + "SELECT SCHOOL_YEAR, STUDENT_KEY, flag FROM flagged")
def risk_flag(spark, d):
    return _flagged(spark, d).select(*_KEY, "flag")


ASSESSED = """,
ci AS (SELECT GRADE_KEY AS g, SCHOOL_YEAR AS y, avg(t) - 1.1503493803760079 * stddev_samp(t) / sqrt(count(t)) AS lo,
              avg(t) + 1.1503493803760079 * stddev_samp(t) / sqrt(count(t)) AS hi
       FROM (SELECT *, MATH_SS + READ_SS AS t FROM flagged WHERE flag = 'Moderate') GROUP BY ALL),
assessed AS (SELECT flagged.*, CASE WHEN MATH_SS IS NULL OR READ_SS IS NULL THEN 'Missing'
    WHEN MATH_SS + READ_SS < lo THEN 'High' WHEN MATH_SS + READ_SS <= hi THEN 'Moderate'
    WHEN MATH_SS + READ_SS > hi THEN 'Low' END AS assessments
  FROM flagged LEFT JOIN ci ON GRADE_KEY IS NOT DISTINCT FROM g AND SCHOOL_YEAR = y)
"""


@query("assessment_band", "WITH " + SCORED + ASSESSED + "SELECT SCHOOL_YEAR, STUDENT_KEY, assessments FROM assessed")
def assessment_band(spark, d):
    return risk.assessment_band(_flagged(spark, d), by=COHORT).select(*_KEY, "assessments")


_MISSED = "round_even(greatest(180 - round_even(180 * ATT_RATE, 1), 0), 1)"


def _attended(source):
    return f"""
attended AS (SELECT *, CASE WHEN daysmissed IS NULL THEN 'Missing' WHEN daysmissed <= 12 THEN 'Low'
    WHEN daysmissed <= 20 THEN 'Moderate' ELSE 'High' END AS attendance
  FROM (SELECT *, CASE WHEN ATT_RATE IS NOT NULL THEN {_MISSED} END AS daysmissed FROM {source}))"""


@query("attendance_band", "WITH " + b.SCORING + "," + b.clean_sql("scoring") + "," + _attended("cleaned") + """
SELECT SCHOOL_YEAR, STUDENT_KEY, daysmissed + 0.0 AS daysmissed, attendance FROM attended
""")
def attendance_band(spark, d):
    out = risk.attendance_band(cleaning.clean_pool(b.scoring_cohort(spark, d)))
    return b.rounded(out.select(*_KEY, "daysmissed", "attendance"))


_MOBILE = """CASE WHEN SCHOOL_COUNT >= 3 AND ENROLLMENTS_COUNT >= 3 THEN 'High'
  WHEN SCHOOL_COUNT >= 2 AND ENROLLMENTS_COUNT >= 2 THEN 'Moderate' ELSE 'Low' END AS mobility"""


@query("mobility_band", "WITH " + b.MOBILITY + f"SELECT SCHOOL_YEAR, STUDENT_KEY, {_MOBILE} FROM mobility")
def mobility_band(spark, d):
    return risk.mobility_band(b.mobility(spark, d)).select(*_KEY, "mobility")


@query("mobility_given", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Moderate' ELSE 'Low' END AS mobility FROM orders
""")
def mobility_given(spark, d):
    given = F.when(C("o_orderstatus") == "P", "Yes").when(C("o_orderstatus") == "O", "No")
    return risk.mobility_band(load(spark, d, "orders").select("o_orderkey", given.alias("moved")), given="moved")


def _disciplined(source):
    return f"""
lows AS (SELECT GRADE_KEY AS g1, SCHOOL_YEAR AS y1, min(incCount) AS c1, min(daysRemoved) AS d1 FROM {source} GROUP BY ALL),
second AS (SELECT g1 AS g2, y1 AS y2, min(incCount) AS c2
  FROM {source} JOIN lows ON GRADE_KEY IS NOT DISTINCT FROM g1 AND SCHOOL_YEAR = y1 WHERE incCount > c1 GROUP BY ALL),
disciplined AS (SELECT {source}.*, CASE WHEN incCount > c2 THEN 'High'
    WHEN incCount > c1 OR daysRemoved > d1 THEN 'Moderate' ELSE 'Low' END AS discipline
  FROM {source} JOIN lows ON GRADE_KEY IS NOT DISTINCT FROM g1 AND SCHOOL_YEAR = y1
  LEFT JOIN second ON GRADE_KEY IS NOT DISTINCT FROM g2 AND SCHOOL_YEAR = y2)"""


@query("discipline_band", "WITH " + b.SCORING + "," + b.clean_sql("scoring") + "," + _disciplined("cleaned") + """
SELECT SCHOOL_YEAR, STUDENT_KEY, discipline FROM disciplined
""")
def discipline_band(spark, d):
    return risk.discipline_band(cleaning.clean_pool(b.scoring_cohort(spark, d, keep=True)), by=COHORT).select(*_KEY, "discipline")


# ---------------------------------------------------------------- export

def _rank(col):
    return f"""CASE WHEN {col} IS NOT NULL THEN CAST(floor(count({col}) OVER (PARTITION BY GRADE_KEY, SCHOOL_YEAR ORDER BY {col} NULLS LAST
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / count({col}) OVER (PARTITION BY GRADE_KEY, SCHOOL_YEAR) * 100) AS BIGINT) END"""


_EXPORT_VALUES = {
    "X": "row_number() OVER (PARTITION BY GRADE_KEY, SCHOOL_YEAR ORDER BY STUDENT_KEY)",
    "WSN": "WSN", "STUDENT_KEY": "STUDENT_KEY", "DATE": f"TIMESTAMP '{WHEN}'", "MODEL": "'Full'",
    "MODEL_DATA": "'{kind}'", "MODEL_NAME": "'Grade ' || CAST(CAST(GRADE_KEY AS INT) AS VARCHAR) || ' {kind}'",
    "STUDENT_RISK_SEVERITY_SCORE": f"CASE WHEN pred IS NOT NULL THEN {b.r('yhat')} END",
    "STUDENT_RISK_SEVERITY_PRECISION": b.r("yhatError"), "STUDENT_RISK_OUTCOME": "flag",
    "STUDENT_RISK_MEASURE_VALUE_Att": "daysmissed + 0.0",
    "STUDENT_RISK_MEASURE_VALUE_Att2": _rank("ATT_RATE"),
    "STUDENT_RISK_MEASURE_VALUE_Att3": b.r("ATT_RATE * 100"),
    "STUDENT_RISK_MEASURE_VALUE_Att4": "DAYS_POSS", "STUDENT_RISK_REPORT_TEXTAtt": "attendance",
    "STUDENT_RISK_MEASURE_VALUE_Assess1": b.r("READ_SS"), "STUDENT_RISK_MEASURE_VALUE_Assess2": b.r("MATH_SS"),
    "STUDENT_RISK_MEASURE_VALUE_Assess3": _rank("MATH_SS"), "STUDENT_RISK_MEASURE_VALUE_Assess4": _rank("READ_SS"),
    "STUDENT_RISK_REPORT_TEXTAssess": "assessments",
    "STUDENT_RISK_MEASURE_VALUE_Disc": b.r("exp(daysRemoved) - 0.01"),
    "STUDENT_RISK_MEASURE_VALUE_Disc2": "{disc2}",
    "STUDENT_RISK_MEASURE_VALUE_Disc3": "CAST(NULL AS DOUBLE)", "STUDENT_RISK_REPORT_TEXTDisc": "discipline",
    "STUDENT_RISK_MEASURE_VALUE_Mob": "ENROLLMENTS_COUNT", "STUDENT_RISK_MEASURE_VALUE_Mob2": "SCHOOL_COUNT",
    "STUDENT_RISK_REPORT_TEXTMob": _MOBILE.removesuffix(" AS mobility"),
    "GRADE_LEVEL": "CAST(GRADE_KEY AS INT)", "SCHOOL_YEAR": "SCHOOL_YEAR",
}


def _export_sql(kind, disc2):
    values = ", ".join(
        f'{v} AS "{k}"' for k, v in _EXPORT_VALUES.items()
    ).replace("{kind}", kind).replace("{disc2}", disc2)
    return "WITH " + SCORED + ASSESSED + "," + _attended("assessed") + "," + _disciplined("attended") + f" SELECT {values} FROM disciplined"


def _export(spark, d, prelim=False):
    # The banded cohort is read by several passes, so it is written down once.
    base = stage(scored(spark, d, keep=False), "scored")
    banded = risk.risk_bands(base, F.lit(THRESHOLD), by=COHORT)
    return b.rounded(risk.risk_export(
        banded, grade=C("GRADE_KEY").cast("int"), year=C("SCHOOL_YEAR"), prelim=prelim,
        run_time=F.lit(WHEN).cast("timestamp_ntz"),
    ))


@query("risk_export", _export_sql("Final", b.r("exp(incCount) - 0.1")))
def risk_export(spark, d):
    return _export(spark, d)


@query("risk_export_preliminary", _export_sql("Preliminary", "CAST(NULL AS DOUBLE)"))
def risk_export_preliminary(spark, d):
    return _export(spark, d, prelim=True)


@query("export_roundtrip", _export_sql("Final", b.r("exp(incCount) - 0.1")))
def export_roundtrip(spark, d):
    """Write the export as CSV per year and grade, and read all its files back."""
    out = _export(spark, d)
    path = staging_path(spark, "export")
    exports.write_export(out, path, partition_by=["SCHOOL_YEAR", "GRADE_LEVEL"])
    return exports.read_export(spark, path, out.schema)


# What the export holds whatever the models say, and whether the scores are in range.
_FIXED_COLUMNS = ["X", "STUDENT_KEY", "GRADE_LEVEL", "SCHOOL_YEAR", "STUDENT_RISK_REPORT_TEXTAtt", "STUDENT_RISK_REPORT_TEXTMob", "STUDENT_RISK_REPORT_TEXTDisc"]


@query("early_warning", f"SELECT {', '.join(_FIXED_COLUMNS)}, true AS fine FROM ({_export_sql('Final', 'CAST(NULL AS DOUBLE)')})")
def early_warning(spark, d):
    """Pool to export: trains on cohorts with outcomes, scores every cohort, bands each grade and year."""
    pool = stage(cohorts.training_pool(spark, d), "pool")
    people = load(spark, d, "customer").select(C("c_custkey").alias("STUDENT_KEY"), C("c_name").alias("WSN"))
    cohort = cleaning.clean_pool(peers.peer_enriched(b.scoring_cohort(spark, d), b.PEERS, **b.MEASURES))
    cohort = stage(cohort.join(people, "STUDENT_KEY"), "cohort")
    exclude = [c for c in pool.columns if "KEY" in c] + ["SCHOOL_YEAR", "grad_ind"]
    out = run.early_warning(
        pool, cohort, target="ontime_grad", key="STUDENT_KEY", year="SCHOOL_YEAR", grade="GRADE_KEY", exclude=exclude, control=control("DEV"),
        methods=candidate_methods(), budget_grade=8, run_time=F.lit(WHEN).cast("timestamp_ntz"),
    )
    score, outcome = C("STUDENT_RISK_SEVERITY_SCORE"), C("STUDENT_RISK_OUTCOME")
    scored = score.between(0, 1) & outcome.isin("High", "Moderate", "Low", "None")
    return out.select(*_FIXED_COLUMNS, F.when(score.isNull(), outcome == "Missing").otherwise(scored).alias("fine"))


@query("risk_lifecycle", "WITH " + b.ANNUAL + """
SELECT STUDENT_KEY, SCHOOL_YEAR, make_date(y + 1, 5, 31) AS run_date, CAST(make_date(y + 1, 5, 31) + 365 AS DATE) AS expires,
  CASE WHEN y = max(y) OVER (PARTITION BY STUDENT_KEY) THEN 'Active' ELSE 'Inactive' END AS status FROM annual
""")
def risk_lifecycle(spark, d):
    run = F.make_date(schoolyear.start_year(C("SCHOOL_YEAR")) + 1, F.lit(5), F.lit(31))
    records = b.annual(spark, d).select("STUDENT_KEY", "SCHOOL_YEAR", run.alias("run_date"))
    return risk.risk_lifecycle(records, "STUDENT_KEY", year="SCHOOL_YEAR", run_date=C("run_date"))


# ---------------------------------------------------------------- quality

def _checks(df):
    s = "STUDENT_RISK_"
    v = f"{s}MEASURE_VALUE_"
    return [
        quality.columns_match(df, fixed.EXPORT_COLUMNS),
        quality.rows(1000),
        quality.rows(100, where=C("MODEL_NAME") == "Grade 8 Final", name="rows(Grade 8 Final)"),
        quality.category(f"{s}OUTCOME", "High", 100, 100000000),
        quality.category(f"{s}OUTCOME", "Low", 100, 200),
        quality.categories(f"{s}REPORT_TEXTMob", 3),
        quality.nulls(f"{s}SEVERITY_SCORE", 100),
        quality.statistic("max", f"{s}SEVERITY_SCORE", 0.9, None, True),
        quality.statistic("min", f"{s}SEVERITY_SCORE", None, 0.25, True),
        quality.statistic("median", f"{v}Att2", 50, 50),
        quality.statistic("max", f"{v}Assess3", 100, 100),
        quality.statistic("avg", f"{v}Mob", 1.0, None, True),
        quality.mean_above(f"{v}Mob", f"{v}Mob2"),
    ]


def _check_sql():
    s = "STUDENT_RISK_"
    v = f"{s}MEASURE_VALUE_"
    rows = [
        ("columns", "max(1)", "1", "1", "value >= 1 AND value <= 1"),
        ("rows", "count(*)", "1000", None, "value > 1000"),
        ("rows(Grade 8 Final)", "count(*) FILTER (MODEL_NAME = 'Grade 8 Final')", "100", None, "value > 100"),
        (f"{s}OUTCOME=High", f"count(*) FILTER ({s}OUTCOME = 'High')", "100", "100000000", "value > 100 AND value < 100000000"),
        (f"{s}OUTCOME=Low", f"count(*) FILTER ({s}OUTCOME = 'Low')", "100", "200", "value > 100 AND value < 200"),
        (f"categories({s}REPORT_TEXTMob)", f"count(DISTINCT {s}REPORT_TEXTMob)", "3", "3", "value = 3"),
        (f"nulls({s}SEVERITY_SCORE)", f"count(*) FILTER ({s}SEVERITY_SCORE IS NULL)", None, "100", "value < 100"),
        (f"max({s}SEVERITY_SCORE)", f"max({s}SEVERITY_SCORE)", "0.9", None, "value > 0.9"),
        (f"min({s}SEVERITY_SCORE)", f"min({s}SEVERITY_SCORE)", None, "0.25", "value < 0.25"),
        (f"median({v}Att2)", f"median({v}Att2)", "50", "50", "value = 50"),
        (f"max({v}Assess3)", f"max({v}Assess3)", "100", "100", "value = 100"),
        (f"avg({v}Mob)", f"avg({v}Mob)", "1", None, "value > 1"),
        (f"avg({v}Mob)>avg({v}Mob2)", f"avg({v}Mob) - avg({v}Mob2)", "0", None, "value > 0"),
    ]
    parts = [
        f"SELECT '{n}' AS \"check\", {b.r('value')} AS value, CAST({lo or 'NULL'} AS DOUBLE) AS lower, "
        f"CAST({hi or 'NULL'} AS DOUBLE) AS upper, {ok} AS passed FROM (SELECT CAST({e} AS DOUBLE) AS value FROM ex)"
        for n, e, lo, hi, ok in rows
    ]
    return f"WITH ex AS ({_export_sql('Final', b.r('exp(incCount) - 0.1'))}) " + " UNION ALL ".join(parts)


@query("quality_checks", _check_sql())
def quality_checks(spark, d):
    export = stage(_export(spark, d), "export")
    return b.rounded(quality.quality_checks(export, _checks(export)))
