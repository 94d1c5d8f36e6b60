"""The test tables in the roles of a school warehouse, as DataFrames and as SQL.

Student = customer, school = nation, district = region, enrolments and diplomas = orders,
test scores = lineitem by return flag, incidents = events. Missing codes are made on purpose from
extreme account balances, since the tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilo.functions import fixed, schoolyear
from vigilo.operators import cohort
from vigilo.sources.tables import load, stage

LAST_KNOWN = 2001
EXITS = {"2-HIGH": fixed.UNKNOWN_EXIT, "3-MEDIUM": fixed.LATE}
INCIDENTS = {"error": "Assault", "purchase": "Drug", "signup": "Weapon", "click": "SchoolRule"}
COHORT = ["SCHOOL_YEAR", "STUDENT_KEY"]
PEERS = ["SCHOOL_YEAR", "STUDENT_ANNUAL_GRADE_CODE", "SCHOOL_KEY"]
MEASURES = {"majority_race": "BUILDING"}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, so that the order of summation does not show."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n"


# ---------------------------------------------------------------- student-years

def annual(spark: SparkSession, d: str) -> DataFrame:
    """One row per student and school year."""
    orders = load(spark, d, "orders")
    per_year = orders.groupBy(F.col("o_custkey").alias("STUDENT_KEY"), F.year("o_orderdate").alias("y")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.dayofmonth("o_orderdate")).alias("dom"),
        F.bool_or(F.col("o_orderstatus") == "P").alias("again"),
        F.bool_or(F.col("o_orderpriority") == "5-LOW").alias("low"),
    )
    people = load(spark, d, "customer").select(
        F.col("c_custkey").alias("STUDENT_KEY"), "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    nation = load(spark, d, "nation").select("n_nationkey", "n_regionkey")
    joined = per_year.join(people, "STUDENT_KEY").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "STUDENT_KEY",
        "concat(y, '-', y + 1) AS SCHOOL_YEAR",
        "CAST(c_nationkey AS BIGINT) AS SCHOOL_KEY",
        "CAST(n_regionkey AS BIGINT) AS DISTRICT_CODE",
        "concat('0', 5 + c_nationkey % 4) AS STUDENT_ANNUAL_GRADE_CODE",
        "CASE WHEN c_acctbal >= -500 THEN c_mktsegment END AS STUDENT_RACE",
        "CASE WHEN c_acctbal < -800 THEN NULL WHEN c_acctbal < 4000 THEN 'F' ELSE 'N' END AS STUDENT_FOODSERVICE_ELIG_CODE",
        "CASE WHEN c_acctbal > 9700 THEN NULL WHEN c_acctbal < 600 THEN 'Yes' ELSE 'No' END AS STUDENT_SPECIAL_ED_INDICATOR",
        "CASE WHEN c_acctbal >= -700 THEN CAST(floor((c_acctbal + 1000) / 1200) AS INT) END AS STUDENT_ESL_CLASSIFICATION",
        "CASE WHEN low THEN 'Yes' ELSE 'No' END AS STUDENT_LEP_INDICATOR",
        "CASE WHEN again THEN 'Yes' WHEN n = 1 THEN '@NR' ELSE 'No' END AS STUDENT_REPEATER_INDICATOR",
        "CASE WHEN CAST(round(c_acctbal * 100) AS BIGINT) % 2 = 0 THEN 'F' ELSE 'M' END AS STUDENT_GENDER_CODE",
        "CASE WHEN c_acctbal > 9900 THEN NULL WHEN c_acctbal > 9850 THEN 0 ELSE n * 60 END AS STUDENT_ANNUAL_ENROLLMENT_DAYS",
        "dom div 4 AS STUDENT_ANNUAL_ABSENCES",
    )


ANNUAL = """
per_year AS (
  SELECT o_custkey AS STUDENT_KEY, year(o_orderdate) AS y, count(*) AS n,
         CAST(sum(day(o_orderdate)) AS BIGINT) AS dom,
         bool_or(o_orderstatus = 'P') AS again, bool_or(o_orderpriority = '5-LOW') AS low
  FROM orders GROUP BY 1, 2),
annual AS (
  SELECT STUDENT_KEY, y, CAST(y AS VARCHAR) || '-' || CAST(y + 1 AS VARCHAR) AS SCHOOL_YEAR,
    CAST(c_nationkey AS BIGINT) AS SCHOOL_KEY, CAST(n_regionkey AS BIGINT) AS DISTRICT_CODE,
    '0' || CAST(5 + c_nationkey % 4 AS VARCHAR) AS STUDENT_ANNUAL_GRADE_CODE,
    CASE WHEN c_acctbal >= -500 THEN c_mktsegment END AS STUDENT_RACE,
    CASE WHEN c_acctbal < -800 THEN NULL WHEN c_acctbal < 4000 THEN 'F' ELSE 'N' END AS STUDENT_FOODSERVICE_ELIG_CODE,
    CASE WHEN c_acctbal > 9700 THEN NULL WHEN c_acctbal < 600 THEN 'Yes' ELSE 'No' END AS STUDENT_SPECIAL_ED_INDICATOR,
    CASE WHEN c_acctbal >= -700 THEN CAST(floor((c_acctbal + 1000) / 1200) AS INT) END AS STUDENT_ESL_CLASSIFICATION,
    CASE WHEN low THEN 'Yes' ELSE 'No' END AS STUDENT_LEP_INDICATOR,
    CASE WHEN again THEN 'Yes' WHEN n = 1 THEN '@NR' ELSE 'No' END AS STUDENT_REPEATER_INDICATOR,
    CASE WHEN CAST(round(c_acctbal * 100) AS BIGINT) % 2 = 0 THEN 'F' ELSE 'M' END AS STUDENT_GENDER_CODE,
    CASE WHEN c_acctbal > 9900 THEN NULL WHEN c_acctbal > 9850 THEN 0 ELSE n * 60 END AS STUDENT_ANNUAL_ENROLLMENT_DAYS,
    dom // 4 AS STUDENT_ANNUAL_ABSENCES
  FROM per_year JOIN customer ON STUDENT_KEY = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


# ---------------------------------------------------------------- outcome

def members(people: DataFrame) -> DataFrame:
    """Student-years whose outcome is known, with the year in which they should finish."""
    year, grade = F.col("SCHOOL_YEAR"), F.col("STUDENT_ANNUAL_GRADE_CODE")
    return people.where(schoolyear.has_known_outcome(year, grade, LAST_KNOWN)).select(
        *COHORT, schoolyear.expected_grad_start(year, grade).alias("horizon")
    )


def enrolments(spark: SparkSession, d: str) -> DataFrame:
    open_end = (
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW") & (F.dayofmonth("o_orderdate") == 15)
    )
    return load(spark, d, "orders").select(
        F.col("o_custkey").alias("STUDENT_KEY"),
        F.when(~open_end, F.col("o_orderdate")).alias("END_ENROLLDATE"),
        F.year("o_orderdate").alias("withdraw_year"),
        F.col("o_orderpriority").alias("code"),
    )


def diplomas(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("STUDENT_KEY"), F.year("o_orderdate").alias("diploma_year")
    )


def outcome(spark: SparkSession, d: str, people: DataFrame) -> DataFrame:
    return cohort.outcome_label(
        members(people), diplomas(spark, d), enrolments(spark, d), key="STUDENT_KEY", horizon="horizon",
        diploma_year="diploma_year", end_date="END_ENROLLDATE", withdraw_year="withdraw_year", code="code",
        by=["SCHOOL_YEAR"], codes=EXITS,
    )


MEMBERS = """
members AS (
  SELECT SCHOOL_YEAR, STUDENT_KEY, y + 12 - CAST(STUDENT_ANNUAL_GRADE_CODE AS INT) AS horizon
  FROM annual
  WHERE y + 12 - least(CAST(STUDENT_ANNUAL_GRADE_CODE AS INT), 8) <= 2001)
"""

OUTCOME = MEMBERS + """,
graduates AS (
  SELECT m.SCHOOL_YEAR, m.STUDENT_KEY,
         CASE WHEN bool_or(year(o_orderdate) <= horizon) THEN 'on-time' ELSE 'Late' END AS label,
         CASE WHEN count(*) > 1 THEN 'Yes' ELSE 'No' END AS duplicated
  FROM orders JOIN members m ON o_custkey = m.STUDENT_KEY
  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY 1, 2),
ranked AS (
  SELECT m.SCHOOL_YEAR, m.STUDENT_KEY, horizon, year(o_orderdate) AS wy, o_orderpriority AS code,
         rank() OVER (PARTITION BY m.SCHOOL_YEAR, m.STUDENT_KEY ORDER BY
           CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND day(o_orderdate) = 15)
                THEN o_orderdate END DESC NULLS FIRST) AS rk
  FROM orders JOIN members m ON o_custkey = m.STUDENT_KEY),
judged AS (
  SELECT l.*, g.label, g.duplicated, bool_or(wy > horizon) OVER (PARTITION BY l.SCHOOL_YEAR, l.STUDENT_KEY) AS over
  FROM ranked l LEFT JOIN graduates g ON g.SCHOOL_YEAR = l.SCHOOL_YEAR AND g.STUDENT_KEY = l.STUDENT_KEY
  WHERE rk = 1),
outcome AS (
  SELECT SCHOOL_YEAR, STUDENT_KEY, duplicated,
         CASE WHEN label IS NOT NULL THEN label WHEN over THEN 'Non-grad'
              WHEN code = '2-HIGH' THEN 'exitWIpublicK12' WHEN code = '3-MEDIUM' THEN 'Late'
              ELSE 'Non-grad' END AS grad_ind
  FROM judged WHERE label IS NOT NULL OR NOT over OR wy > horizon)
"""


# ---------------------------------------------------------------- tests, incidents, mobility

def tests(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    scores = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.year("o_orderdate"), F.lit("-"), F.year("o_orderdate") + 1).alias("SCHOOL_YEAR"),
        F.col("o_custkey").alias("STUDENT_KEY"), "l_returnflag", F.col("l_quantity").alias("SS"),
    )
    return cohort.subject_wide(
        scores, COHORT, subject="l_returnflag", subjects={"R": "READ", "A": "MATH"}, measures=["SS"], combine="avg"
    )


TESTS = """
tests AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 1 AS VARCHAR) AS SCHOOL_YEAR,
         o_custkey AS STUDENT_KEY,
         avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS READ_SS,
         avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS MATH_SS
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag IN ('R', 'A')
  GROUP BY 1, 2
  HAVING count(*) FILTER (l_returnflag = 'R') > 0 AND count(*) FILTER (l_returnflag = 'A') > 0)
"""


def removals(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").select(
        F.col("user_id").alias("STUDENT_KEY"), F.to_date("ts").alias("day"), "event_type",
        F.when(F.col("value") >= 1, F.col("value")).alias("days"),
        F.expr(
            "CASE WHEN event_type = 'view' THEN 'IS' WHEN value BETWEEN 10 AND 11 THEN NULL "
            "WHEN value > 200 THEN 'EX' WHEN value > 190 THEN 'SP' ELSE 'OS' END"
        ).alias("removal"),
    )


def discipline(spark: SparkSession, d: str, key=("STUDENT_KEY",)) -> DataFrame:
    return cohort.incident_summary(
        removals(spark, d), key, type_col="event_type", days="days", removal="removal", groups=INCIDENTS
    )


REMOVALS = """
removals AS (
  SELECT user_id AS STUDENT_KEY, CAST(ts AS DATE) AS day,
    CASE event_type WHEN 'error' THEN 'Assault' WHEN 'purchase' THEN 'Drug' WHEN 'signup' THEN 'Weapon'
                    WHEN 'click' THEN 'SchoolRule' ELSE event_type END AS kind,
    CASE WHEN value >= 1 THEN value END AS days,
    CASE WHEN event_type = 'view' THEN 'IS' WHEN value BETWEEN 10 AND 11 THEN NULL
         WHEN value > 200 THEN 'EX' WHEN value > 190 THEN 'SP' ELSE 'OS' END AS removal
  FROM events)
"""


def summary_sql(key: str) -> str:
    return f"""
  SELECT {key}, count(*) AS incCount, string_agg(DISTINCT kind, '-' ORDER BY kind) AS incType,
         sum(days) AS daysRemoved, CASE WHEN bool_or(removal = 'EX') THEN 'EX' ELSE 'OS' END AS removalType
  FROM removals WHERE removal NOT IN ('IS', 'SP') GROUP BY {key}"""


DISCIPLINE = REMOVALS + ",\ndiscipline AS (" + summary_sql("STUDENT_KEY") + ")"


def mobility(spark: SparkSession, d: str) -> DataFrame:
    moves = load(spark, d, "orders").select(
        F.concat(F.year("o_orderdate"), F.lit("-"), F.year("o_orderdate") + 1).alias("SCHOOL_YEAR"),
        F.col("o_custkey").alias("STUDENT_KEY"), "o_orderstatus", "o_orderpriority",
    )
    return cohort.mobility_counts(moves, COHORT, district="o_orderstatus", school="o_orderpriority")


MOBILITY = """
mobility AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 1 AS VARCHAR) AS SCHOOL_YEAR,
         o_custkey AS STUDENT_KEY, count(DISTINCT o_orderstatus) AS DISTRICT_COUNT,
         count(DISTINCT o_orderpriority) AS SCHOOL_COUNT, count(*) AS ENROLLMENTS_COUNT
  FROM orders GROUP BY 1, 2)
"""


# ---------------------------------------------------------------- assembled cohorts

def _spread_discipline(people: DataFrame, incidents: DataFrame) -> DataFrame:
    """Incidents carry no school year here, so they count in each year of the student."""
    return people.select(*COHORT).join(incidents, "STUDENT_KEY")


def _pulled(spark, d, people, keep, **more):
    """With ``keep`` the cohort is written down: it is narrow, and several passes will read it."""
    out = cohort.assemble(
        people, COHORT, tests=tests(spark, d), mobility=mobility(spark, d),
        discipline=_spread_discipline(people, discipline(spark, d)), **more,
    )
    return stage(out, "cohort") if keep else out


def training_cohort(spark: SparkSession, d: str, *, keep: bool = False) -> DataFrame:
    everyone = annual(spark, d)
    year, grade = F.col("SCHOOL_YEAR"), F.col("STUDENT_ANNUAL_GRADE_CODE")
    people = everyone.where(schoolyear.has_known_outcome(year, grade, LAST_KNOWN))
    return _pulled(spark, d, people, keep, outcome=outcome(spark, d, people))


def scoring_cohort(spark: SparkSession, d: str, *, keep: bool = False) -> DataFrame:
    return _pulled(spark, d, annual(spark, d), keep)


PULLED = """
  coalesce(incCount, 0) AS incCount, coalesce(incType, 'None') AS incType,
  coalesce(daysRemoved, 0) AS daysRemoved, coalesce(removalType, 'None') AS removalType,
  READ_SS, MATH_SS, DISTRICT_COUNT, SCHOOL_COUNT, ENROLLMENTS_COUNT
"""

JOINS = """
  LEFT JOIN tests t ON t.SCHOOL_YEAR = a.SCHOOL_YEAR AND t.STUDENT_KEY = a.STUDENT_KEY
  LEFT JOIN discipline i ON i.STUDENT_KEY = a.STUDENT_KEY
  LEFT JOIN mobility m ON m.SCHOOL_YEAR = a.SCHOOL_YEAR AND m.STUDENT_KEY = a.STUDENT_KEY
"""

TRAINING = ",\n".join(s.strip() for s in (ANNUAL, OUTCOME, TESTS, DISCIPLINE, MOBILITY)) + f""",
training AS (
  SELECT a.* EXCLUDE (y), o.grad_ind, o.duplicated, {PULLED}
  FROM annual a
  LEFT JOIN outcome o ON o.SCHOOL_YEAR = a.SCHOOL_YEAR AND o.STUDENT_KEY = a.STUDENT_KEY
  {JOINS}
  WHERE a.y + 12 - least(CAST(a.STUDENT_ANNUAL_GRADE_CODE AS INT), 8) <= 2001)
"""

SCORING = ",\n".join(s.strip() for s in (ANNUAL, TESTS, DISCIPLINE, MOBILITY)) + f""",
scoring AS (SELECT a.* EXCLUDE (y), {PULLED} FROM annual a {JOINS})
"""

PEER_COLUMNS = """
  count(*) AS cohort_size, avg(READ_SS) AS cohort_mean_read, stddev_samp(READ_SS) AS cohort_sd_read,
  avg(MATH_SS) AS cohort_mean_math, stddev_samp(MATH_SS) AS cohort_sd_math,
  count(*) FILTER (incCount > 0) AS cohort_suspPeers,
  1 - sum(STUDENT_ANNUAL_ABSENCES) / nullif(sum(STUDENT_ANNUAL_ENROLLMENT_DAYS), 0) AS cohort_mean_attend,
  stddev_samp((STUDENT_ANNUAL_ENROLLMENT_DAYS - STUDENT_ANNUAL_ABSENCES)
              / nullif(STUDENT_ANNUAL_ENROLLMENT_DAYS, 0)) AS cohort_sd_attend,
  count(*) FILTER (coalesce(STUDENT_SPECIAL_ED_INDICATOR = 'Yes', true)) / count(*) AS cohort_SwDper,
  count(*) FILTER (coalesce(STUDENT_FOODSERVICE_ELIG_CODE <> 'N', true)) / count(*) AS cohort_FRLper,
  count(*) FILTER (coalesce(STUDENT_RACE <> 'BUILDING', true)) / count(*) AS cohort_nonWhitePer,
  count(*) FILTER (incCount > 0) / count(*) AS cohort_suspPeersPer
"""


def peers_sql(source: str) -> str:
    """The statistics of every (year, grade, school) group of ``source``."""
    return f"""peers AS (
  SELECT SCHOOL_YEAR, STUDENT_ANNUAL_GRADE_CODE, SCHOOL_KEY, {PEER_COLUMNS} FROM {source} GROUP BY 1, 2, 3)"""


COHORT_NAMES = [
    "cohort_size", "cohort_mean_read", "cohort_sd_read", "cohort_mean_math", "cohort_sd_math",
    "cohort_suspPeers", "cohort_mean_attend", "cohort_sd_attend", "cohort_SwDper", "cohort_FRLper",
    "cohort_nonWhitePer", "cohort_suspPeersPer",
]


def enriched_sql(source: str) -> str:
    names = ", ".join(f"p.{c}" for c in COHORT_NAMES)
    return peers_sql(source) + f""",
enriched AS (
  SELECT s.*, {names} FROM {source} s LEFT JOIN peers p
    ON p.SCHOOL_YEAR = s.SCHOOL_YEAR AND p.STUDENT_ANNUAL_GRADE_CODE = s.STUDENT_ANNUAL_GRADE_CODE
   AND p.SCHOOL_KEY = s.SCHOOL_KEY)"""


CLEAN_COLUMNS = """
  CASE WHEN STUDENT_ESL_CLASSIFICATION < 3 THEN 'Low' WHEN STUDENT_ESL_CLASSIFICATION < 5 THEN 'Medium'
       WHEN STUDENT_ESL_CLASSIFICATION < 7 THEN 'High' WHEN STUDENT_ESL_CLASSIFICATION >= 7 THEN 'Native' END AS ESL_LEV,
  CASE WHEN STUDENT_FOODSERVICE_ELIG_CODE IS NULL THEN NULL
       WHEN STUDENT_FOODSERVICE_ELIG_CODE = 'N' THEN 'N' ELSE 'Y' END AS FRL,
  CASE STUDENT_REPEATER_INDICATOR WHEN 'Yes' THEN 'Y' WHEN '@NR' THEN 'Unk' ELSE 'N' END AS EVER_RETAINED,
  CASE WHEN STUDENT_GENDER_CODE = 'F' THEN 'F' ELSE 'M' END AS GENDER,
  CASE WHEN STUDENT_SPECIAL_ED_INDICATOR IS NULL THEN NULL
       WHEN STUDENT_SPECIAL_ED_INDICATOR = 'Yes' THEN 'Yes' ELSE 'No' END AS SWD,
  CASE WHEN STUDENT_LEP_INDICATOR = 'Yes' THEN 'Yes' ELSE 'No' END AS LEP,
  1 - STUDENT_ANNUAL_ABSENCES / nullif(STUDENT_ANNUAL_ENROLLMENT_DAYS, 0) AS ATT_RATE,
  STUDENT_ANNUAL_ENROLLMENT_DAYS AS DAYS_POSS, DISTRICT_CODE AS DISTRICT_KEY,
  STUDENT_ANNUAL_GRADE_CODE AS GRADE_KEY,
  CAST(contains(incType, 'Assault') AS INT) AS Assault, CAST(contains(incType, 'Drug') AS INT) AS Drug,
  CAST(contains(incType, 'Weapon') AS INT) AS Weapon, CAST(contains(incType, 'SchoolRule') AS INT) AS SchoolRule,
  ln(daysRemoved + 0.01) AS daysRemoved, ln(incCount + 0.1) AS incCount
"""

REPLACED = (
    "STUDENT_ESL_CLASSIFICATION, STUDENT_FOODSERVICE_ELIG_CODE, STUDENT_REPEATER_INDICATOR, STUDENT_GENDER_CODE, "
    "STUDENT_SPECIAL_ED_INDICATOR, STUDENT_LEP_INDICATOR, STUDENT_ANNUAL_ABSENCES, STUDENT_ANNUAL_ENROLLMENT_DAYS, "
    "DISTRICT_CODE, STUDENT_ANNUAL_GRADE_CODE, incType, daysRemoved, incCount"
)


def clean_sql(source: str, also: str = "") -> str:
    return f"cleaned AS (SELECT * EXCLUDE ({REPLACED}{also}), {CLEAN_COLUMNS} FROM {source})"


# ---------------------------------------------------------------- customer features

FEATURES = ["acctbal", "n_orders", "total", "urgent", "recent", "flagged"]
CONTINUOUS = ["acctbal", "n_orders", "total", "urgent", "recent"]


def features(spark: SparkSession, d: str) -> DataFrame:
    """One numeric row per customer with a segment and a class that the features partly explain."""
    orders = load(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        F.sum(F.round(F.col("o_totalprice") / 1000, 0)).alias("total"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"),
        F.count_if(F.year("o_orderdate") >= 2000).cast("double").alias("recent"),
        F.count_if(F.col("o_orderstatus") == "P").alias("pending"),
    )
    people = load(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return people.join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"), "n_orders", "total", "urgent", "recent",
        (F.col("c_acctbal") < 0).cast("double").alias("flagged"),
        (F.col("urgent") + F.col("pending") >= 7).cast("int").alias("y"),
    )


FEAT = """
feat AS (
  SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal AS acctbal, n_orders, total, urgent, recent,
         CAST(c_acctbal < 0 AS DOUBLE) AS flagged, CAST(urgent + pending >= 7 AS INT) AS y
  FROM customer JOIN (
    SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n_orders, sum(round(o_totalprice / 1000, 0)) AS total,
           CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS urgent,
           CAST(count(*) FILTER (year(o_orderdate) >= 2000) AS DOUBLE) AS recent,
           count(*) FILTER (o_orderstatus = 'P') AS pending
    FROM orders GROUP BY 1) ON c_custkey = o_custkey)
"""

SPLIT_U = "CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"


# ---------------------------------------------------------------- document scores

MODELS = ["size_score", "lang_score", "ratio_score"]


def doc_scores(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with the scores of three fixed formulas; the texts are not read."""
    docs = load(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return load(spark, d, "labels").select("doc_id", "quality", "toxic").join(docs, "doc_id").select(
        "doc_id",
        (1 - F.col("quality")).alias("y"),
        "lang",
        F.round(F.lit(1.0) / (F.lit(1.0) + F.col("n_chars") / 1000.0), 2).alias("size_score"),
        F.expr("CASE lang WHEN 'en' THEN 0.3 WHEN 'de' THEN 0.6 ELSE 0.45 END").cast("double").alias("lang_score"),
        F.round((F.col("n_chars") % 97) / 97.0 * 0.7 + F.col("toxic") * 0.3, 2).alias("ratio_score"),
    )


DOCS = """
docs AS (
  SELECT doc_id, 1 - quality AS y, lang,
         round(1.0 / (1.0 + n_chars / 1000.0), 2) AS size_score,
         CAST(CASE lang WHEN 'en' THEN 0.3 WHEN 'de' THEN 0.6 ELSE 0.45 END AS DOUBLE) AS lang_score,
         round((n_chars % 97) / 97.0 * 0.7 + toxic * 0.3, 2) AS ratio_score
  FROM labels JOIN documents USING (doc_id))
"""


def long_scores(spark: SparkSession, d: str) -> DataFrame:
    """One row per document and model."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in MODELS])
    return doc_scores(spark, d).select("doc_id", "y", F.inline(rows))


LONG = DOCS + """,
long AS (
  SELECT doc_id, y, 'size_score' AS model, size_score AS score FROM docs UNION ALL
  SELECT doc_id, y, 'lang_score', lang_score FROM docs UNION ALL
  SELECT doc_id, y, 'ratio_score', ratio_score FROM docs)
"""
