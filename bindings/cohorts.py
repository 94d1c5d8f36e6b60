"""Scans, cohort building, joins, aggregates and peer statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import base as b
from vigilo.functions import recode, schoolyear
from vigilo.operators import cleaning, cohort, features, peers
from vigilo.plans import workflow
from vigilo.sources import tables
from vigilo.sources.tables import load, row_parts

C = F.col
QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


# ---------------------------------------------------------------- scans

@query("scan_cohort", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
""")
def scan_cohort(spark, d):
    start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (1996, 1997))
    return tables.scan_cohort(
        load(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
        where=(C("o_orderdate") >= start) & (C("o_orderdate") < end),
    )


@query("table_columns", """
SELECT CAST(1 AS BIGINT) AS pos, 'c_custkey' AS name, 'bigint' AS type, count(c_custkey) AS present FROM customer UNION ALL
SELECT 2, 'c_name', 'string', count(c_name) FROM customer UNION ALL
SELECT 3, 'c_nationkey', 'int', count(c_nationkey) FROM customer UNION ALL
SELECT 4, 'c_acctbal', 'double', count(c_acctbal) FROM customer UNION ALL
SELECT 5, 'c_mktsegment', 'string', count(c_mktsegment) FROM customer
""")
def table_columns(spark, d):
    return tables.table_columns(load(spark, d, "customer"))


# ---------------------------------------------------------------- school years

@query("school_year_short", "WITH " + b.ANNUAL + """
SELECT STUDENT_KEY, SCHOOL_YEAR, substr(SCHOOL_YEAR, 1, 4) || '-' || substr(SCHOOL_YEAR, 8, 2) AS short FROM annual
""")
def school_year_short(spark, d):
    return b.annual(spark, d).select(*["STUDENT_KEY", "SCHOOL_YEAR"], schoolyear.short_year(C("SCHOOL_YEAR")).alias("short"))


@query("expected_grad", "WITH " + b.ANNUAL + """
SELECT STUDENT_KEY, SCHOOL_YEAR, CAST(y + 12 - CAST(STUDENT_ANNUAL_GRADE_CODE AS INT) AS VARCHAR) || '-' ||
       CAST(y + 13 - CAST(STUDENT_ANNUAL_GRADE_CODE AS INT) AS VARCHAR) AS expected FROM annual
""")
def expected_grad(spark, d):
    expected = schoolyear.expected_grad(C("SCHOOL_YEAR"), C("STUDENT_ANNUAL_GRADE_CODE"))
    return b.annual(spark, d).select("STUDENT_KEY", "SCHOOL_YEAR", expected.alias("expected"))


@query("known_outcome_cohorts", "WITH " + b.ANNUAL + """
SELECT SCHOOL_YEAR, STUDENT_ANNUAL_GRADE_CODE, count(*) AS members FROM annual
WHERE y + 12 - least(CAST(STUDENT_ANNUAL_GRADE_CODE AS INT), 8) <= 2001 GROUP BY 1, 2
""")
def known_outcome_cohorts(spark, d):
    known = schoolyear.has_known_outcome(C("SCHOOL_YEAR"), C("STUDENT_ANNUAL_GRADE_CODE"), b.LAST_KNOWN)
    return b.annual(spark, d).where(known).groupBy("SCHOOL_YEAR", "STUDENT_ANNUAL_GRADE_CODE").agg(
        F.count(F.lit(1)).alias("members")
    )


# ---------------------------------------------------------------- recodes

@query("recode_map", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'Assault' WHEN 'purchase' THEN 'Drug' WHEN 'signup' THEN 'Weapon'
  WHEN 'click' THEN 'SchoolRule' ELSE event_type END AS kind FROM events
""")
def recode_map(spark, d):
    return load(spark, d, "events").select("event_id", recode.recode_map(C("event_type"), b.INCIDENTS).alias("kind"))


@query("band_code", """
SELECT p_partkey, CASE WHEN p_size < 15 THEN 'Low' WHEN p_size < 30 THEN 'Medium' WHEN p_size < 45 THEN 'High'
  WHEN p_size >= 45 THEN 'Native' END AS band
FROM (SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_size END AS p_size FROM part)
""")
def band_code(spark, d):
    size = F.when(C("p_type") != "PROMO", C("p_size"))
    return load(spark, d, "part").select(
        "p_partkey", recode.band(size, (15, 30, 45), ("Low", "Medium", "High", "Native")).alias("band")
    )


@query("flag_recode", """
SELECT o_orderkey, CASE WHEN s IS NULL THEN NULL WHEN s = 'F' THEN 'Y' WHEN s = 'P' THEN 'Unk' ELSE 'N' END AS retained
FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS s FROM orders)
""")
def flag_recode(spark, d):
    status = F.when(C("o_orderpriority") != "5-LOW", C("o_orderstatus"))
    return load(spark, d, "orders").select(
        "o_orderkey", recode.flag(status, {"F": "Y", "P": "Unk"}, "N").alias("retained")
    )


@query("attendance_rate", "WITH " + b.ANNUAL + f"""
SELECT STUDENT_KEY, SCHOOL_YEAR,
       {b.r("1 - STUDENT_ANNUAL_ABSENCES / nullif(STUDENT_ANNUAL_ENROLLMENT_DAYS, 0)")} AS ATT_RATE FROM annual
""")
def attendance_rate(spark, d):
    rate = recode.attendance_rate(C("STUDENT_ANNUAL_ABSENCES"), C("STUDENT_ANNUAL_ENROLLMENT_DAYS"))
    return b.rounded(b.annual(spark, d).select("STUDENT_KEY", "SCHOOL_YEAR", rate.alias("ATT_RATE")))


@query("shifted_log", f"""
SELECT event_id, {b.r("ln(value + 0.01)")} AS log_days, {b.r("exp(ln(value + 0.01)) - 0.01")} AS days FROM events
""")
def shifted_log(spark, d):
    logged = recode.shifted_log(C("value"), 0.01)
    return b.rounded(
        load(spark, d, "events").select("event_id", logged.alias("log_days"), recode.unshifted(logged, 0.01).alias("days"))
    )


@query("contains_flags", "WITH " + b.REMOVALS + ", s AS (" + b.summary_sql("STUDENT_KEY, day") + """)
SELECT STUDENT_KEY, day, CAST(contains(incType, 'Assault') AS INT) AS Assault, CAST(contains(incType, 'Drug') AS INT) AS Drug,
  CAST(contains(incType, 'Weapon') AS INT) AS Weapon, CAST(contains(incType, 'SchoolRule') AS INT) AS SchoolRule FROM s
""")
def contains_flags(spark, d):
    flags = recode.contains_flags(C("incType"), ("Assault", "Drug", "Weapon", "SchoolRule"))
    return b.discipline(spark, d, ["STUDENT_KEY", "day"]).select(
        "STUDENT_KEY", "day", *[c.alias(n) for n, c in flags.items()]
    )


# ---------------------------------------------------------------- joins

@query("cohort_members", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996)
""")
def cohort_members(spark, d):
    orders = load(spark, d, "orders")
    in_cohort = orders.where(F.year("o_orderdate") == 1996).select("o_custkey")
    return cohort.cohort_members(orders.select("o_orderkey", "o_custkey", "o_orderpriority"), in_cohort, "o_custkey")


@query("anti_resolved", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) > 2000)
""")
def anti_resolved(spark, d):
    orders = load(spark, d, "orders")
    later = orders.where(F.year("o_orderdate") > 2000).select("o_custkey")
    return cohort.without_keys(orders.select("o_orderkey", "o_custkey", "o_orderpriority"), later, "o_custkey")


@query("demographics", """
SELECT c_custkey, c_nationkey, c_mktsegment, n_name, n_regionkey, r_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def demographics(spark, d):
    people = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    schools = load(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    districts = load(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    with_school = cohort.demographics(people, schools, "c_nationkey")
    return cohort.demographics(with_school, districts, "n_regionkey").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "n_name", "n_regionkey", "r_name"
    )


@query("role_dates", """
WITH dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS v, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS k FROM orders),
f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS bk,
             CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS ek FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, s.v AS BEGIN_ENROLLDATE, e.v AS END_ENROLLDATE
FROM f JOIN dates s ON bk = s.k JOIN dates e ON ek = e.k
""")
def role_dates(spark, d):
    key = lambda c: F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
    orders = load(spark, d, "orders")
    dates = orders.select(F.to_date("o_orderdate").alias("v")).distinct().select("v", key("v").alias("k"))
    fact = load(spark, d, "lineitem").join(orders, C("l_orderkey") == C("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        key("o_orderdate").alias("bk"), key("l_shipdate").alias("ek"),
    )
    return cohort.role_dates(
        fact, dates, date_key="k", date_value="v", roles={"bk": "BEGIN_ENROLLDATE", "ek": "END_ENROLLDATE"}
    ).drop("bk", "ek")


@query("subject_wide", f"""
SELECT l_partkey, {b.r("avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END)")} AS READ_SS,
  {b.r("avg(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END)")} AS READ_RAW,
  {b.r("avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END)")} AS MATH_SS,
  {b.r("avg(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END)")} AS MATH_RAW
FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'R') > 0 AND count(*) FILTER (l_returnflag = 'A') > 0
""")
def subject_wide(spark, d):
    scores = load(spark, d, "lineitem").select(
        "l_partkey", "l_returnflag", C("l_quantity").alias("SS"), C("l_extendedprice").alias("RAW")
    )
    return b.rounded(cohort.subject_wide(
        scores, ["l_partkey"], subject="l_returnflag", subjects={"R": "READ", "A": "MATH"},
        measures=["SS", "RAW"], combine="avg",
    ))


@query("subject_join", """
SELECT a.l_orderkey, a.l_quantity AS READ_SS, b.l_quantity AS MATH_SS FROM lineitem a JOIN lineitem b
ON a.l_orderkey = b.l_orderkey WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'A'
""")
def subject_join(spark, d):
    scores = load(spark, d, "lineitem").select("l_orderkey", "l_returnflag", C("l_quantity").alias("SS"))
    return cohort.subject_wide(
        scores, ["l_orderkey"], subject="l_returnflag", subjects={"R": "READ", "A": "MATH"}, measures=["SS"]
    )


_CROSSWALK = """
WITH persons AS (SELECT c_custkey AS STUDENT_KEY, CASE WHEN c_acctbal < 0 THEN 'Deleted' ELSE 'Active' END AS st FROM customer),
keymap AS (SELECT c_custkey AS STUDENT_KEY, c_name AS WSN FROM customer),
xref AS (SELECT o_orderkey AS LDS, c_name AS WSN, CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS cur
         FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _crosswalk_inputs(spark, d):
    customer = load(spark, d, "customer")
    keymap = customer.select(C("c_custkey").alias("STUDENT_KEY"), C("c_name").alias("WSN"))
    persons = customer.select(
        C("c_custkey").alias("STUDENT_KEY"), F.when(C("c_acctbal") < 0, "Deleted").otherwise("Active").alias("st")
    )
    xref = load(spark, d, "orders").join(customer, C("o_custkey") == C("c_custkey")).select(
        C("o_orderkey").alias("LDS"), C("c_name").alias("WSN"),
        F.when(C("o_orderstatus") == "F", "N").otherwise("Y").alias("cur"),
    )
    return keymap, xref, persons


@query("crosswalk", _CROSSWALK + """
SELECT DISTINCT LDS, CASE WHEN st = 'Deleted' THEN -2 ELSE k.STUDENT_KEY END AS STUDENT_KEY, k.WSN
FROM keymap k JOIN xref x ON k.WSN = x.WSN JOIN persons p ON p.STUDENT_KEY = k.STUDENT_KEY
JOIN lineitem ON l_orderkey = LDS WHERE cur = 'Y'
""")
def crosswalk(spark, d):
    keymap, xref, persons = _crosswalk_inputs(spark, d)
    seen = load(spark, d, "lineitem").select(C("l_orderkey").alias("LDS"))
    return cohort.crosswalk(
        keymap, xref, persons, shared_id="WSN", key="STUDENT_KEY", local_id="LDS", status="st",
        current=C("cur") == "Y", seen=seen,
    )


@query("crosswalk_lookup", _CROSSWALK + """
SELECT LDS, CASE WHEN st = 'Deleted' THEN -2 ELSE k.STUDENT_KEY END AS STUDENT_KEY, k.WSN
FROM keymap k JOIN xref x ON k.WSN = x.WSN JOIN persons p ON p.STUDENT_KEY = k.STUDENT_KEY
""")
def crosswalk_lookup(spark, d):
    keymap, xref, persons = _crosswalk_inputs(spark, d)
    return cohort.crosswalk(
        keymap, xref, persons, shared_id="WSN", key="STUDENT_KEY", local_id="LDS", status="st", distinct=False
    )


# ---------------------------------------------------------------- aggregates

@query("mobility_counts", """
SELECT CAST(year(o_orderdate) AS INT) AS year, o_custkey AS STUDENT_KEY, count(DISTINCT l_suppkey) AS DISTRICT_COUNT,
  count(DISTINCT l_partkey) AS SCHOOL_COUNT, count(*) AS ENROLLMENTS_COUNT
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
""")
def mobility_counts(spark, d):
    lines, orders = load(spark, d, "lineitem"), load(spark, d, "orders")
    n = row_parts(lines)  # the join's tasks hold a set number of rows, as each counts its own places before the shuffle
    joined = lines.repartition(n, "l_orderkey").join(orders.repartition(n, "o_orderkey"), C("l_orderkey") == C("o_orderkey"))
    moves = joined.select(F.year("o_orderdate").alias("year"), C("o_custkey").alias("STUDENT_KEY"), "l_suppkey", "l_partkey")
    return cohort.mobility_counts(moves, ["year", "STUDENT_KEY"], district="l_suppkey", school="l_partkey")


@query("incident_removals", """
SELECT o_orderkey AS incident, o_custkey, o_orderstatus, l_quantity AS days, l_returnflag AS removal
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def incident_removals(spark, d):
    incidents = load(spark, d, "orders").select(C("o_orderkey").alias("incident"), "o_custkey", "o_orderstatus")
    removals = load(spark, d, "lineitem").select(
        C("l_orderkey").alias("incident"), C("l_quantity").alias("days"), C("l_returnflag").alias("removal")
    )
    return cohort.incident_removals(incidents, removals, "incident")


@query("incident_summary", "WITH " + b.REMOVALS + ", s AS (" + b.summary_sql("STUDENT_KEY, day") + f""")
SELECT STUDENT_KEY, day, incCount, incType, {b.r("daysRemoved", 4)} AS daysRemoved, removalType FROM s
""")
def incident_summary(spark, d):
    return b.rounded(b.discipline(spark, d, ["STUDENT_KEY", "day"]), 4)


@query("incident_summary_strict", "WITH " + b.REMOVALS + f"""
SELECT STUDENT_KEY, day, count(*) AS incCount, string_agg(DISTINCT kind, '-' ORDER BY kind) AS incType,
  {b.r("CASE WHEN count(days) = count(*) THEN sum(days) END", 4)} AS daysRemoved,
  CASE WHEN bool_or(removal = 'EX') THEN 'EX' ELSE 'OS' END AS removalType
FROM removals WHERE removal NOT IN ('IS', 'SP') GROUP BY 1, 2
""")
def incident_summary_strict(spark, d):
    return b.rounded(cohort.incident_summary(
        b.removals(spark, d), ["STUDENT_KEY", "day"], type_col="event_type", days="days", removal="removal",
        groups=b.INCIDENTS, missing_days_poison=True,
    ), 4)


@query("dedupe_outcome", """
WITH g AS (SELECT o_custkey AS STUDENT_KEY, CAST(year(o_orderdate) AS INT) AS yr FROM orders
           WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
c AS (SELECT STUDENT_KEY, yr, count(*) AS n FROM g GROUP BY 1, 2),
m AS (SELECT STUDENT_KEY, yr, row_number() OVER (PARTITION BY STUDENT_KEY ORDER BY n DESC, yr) AS rn FROM c)
SELECT g.STUDENT_KEY, max(m.yr) AS GradYear, max(g.yr) AS yearNum,
  CASE WHEN bool_or(g.yr <= 1998) THEN 'on-time' ELSE 'Late' END AS grad_ind,
  CASE WHEN count(*) > 1 THEN 'Yes' ELSE 'No' END AS duplicated
FROM g JOIN m ON m.STUDENT_KEY = g.STUDENT_KEY AND rn = 1 GROUP BY 1
""")
def dedupe_outcome(spark, d):
    return cohort.dedupe_outcome(
        b.diplomas(spark, d), ["STUDENT_KEY"], year="diploma_year", on_time=C("diploma_year") <= 1998
    )


@query("latest_enrolment", """
WITH e AS (SELECT o_orderkey, o_custkey, CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND
             day(o_orderdate) = 15) THEN o_orderdate END AS ended FROM orders)
SELECT o_orderkey, o_custkey, ended, CASE WHEN rank() OVER (PARTITION BY o_custkey ORDER BY ended DESC NULLS FIRST) = 1
  THEN 'Yes' ELSE 'No' END AS maxObsFlag FROM e
""")
def latest_enrolment(spark, d):
    open_end = (C("o_orderstatus") == "P") & (C("o_orderpriority") == "5-LOW") & (F.dayofmonth("o_orderdate") == 15)
    enrolled = load(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.when(~open_end, C("o_orderdate")).alias("ended")
    )
    return cohort.latest_rows(enrolled, ["o_custkey"], "ended")


@query("outcome_label", "WITH " + b.ANNUAL + "," + b.OUTCOME + """
SELECT SCHOOL_YEAR, STUDENT_KEY, grad_ind, duplicated FROM outcome
""")
def outcome_label(spark, d):
    return b.outcome(spark, d, b.annual(spark, d))


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return cohort.duplicate_keys(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, d):
    return cohort.distinct_rows(load(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


# ---------------------------------------------------------------- assembled cohorts

_TRAIN_KEEP = [
    "SCHOOL_YEAR", "STUDENT_KEY", "SCHOOL_KEY", "STUDENT_ANNUAL_GRADE_CODE", "grad_ind", "duplicated", "READ_SS",
    "MATH_SS", "incCount", "incType", "daysRemoved", "removalType", "DISTRICT_COUNT", "SCHOOL_COUNT", "ENROLLMENTS_COUNT",
]
_ROUND = {"READ_SS", "MATH_SS", "daysRemoved"}
_TRAIN_SELECT = ", ".join(f"{b.r(c, 4)} AS {c}" if c in _ROUND else c for c in _TRAIN_KEEP)


@query("cohort_assemble", "WITH " + b.TRAINING + f"SELECT {_TRAIN_SELECT} FROM training")
def cohort_assemble(spark, d):
    return b.rounded(b.training_cohort(spark, d).select(*_TRAIN_KEEP), 4)


@query("cohort_without_incidents", "WITH " + ",\n".join(s.strip() for s in (b.ANNUAL, b.TESTS, b.MOBILITY)) + f"""
SELECT a.SCHOOL_YEAR, a.STUDENT_KEY, {b.r("READ_SS", 4)} AS READ_SS, ENROLLMENTS_COUNT,
  CAST(NULL AS VARCHAR) AS incType, CAST(NULL AS DOUBLE) AS daysRemoved
FROM annual a LEFT JOIN tests t ON t.SCHOOL_YEAR = a.SCHOOL_YEAR AND t.STUDENT_KEY = a.STUDENT_KEY
LEFT JOIN mobility m ON m.SCHOOL_YEAR = a.SCHOOL_YEAR AND m.STUDENT_KEY = a.STUDENT_KEY
""")
def cohort_without_incidents(spark, d):
    out = cohort.assemble(
        b.annual(spark, d), b.COHORT, tests=b.tests(spark, d), mobility=b.mobility(spark, d), discipline=None
    )
    return b.rounded(out.select("SCHOOL_YEAR", "STUDENT_KEY", "READ_SS", "ENROLLMENTS_COUNT", "incType", "daysRemoved"), 4)


_PEER_SELECT = ", ".join(
    c if c in ("cohort_size", "cohort_suspPeers") else f"{b.r(c)} AS {c}" for c in b.COHORT_NAMES
)


@query("peer_stats", "WITH " + b.SCORING + "," + b.peers_sql("scoring") + f"""
SELECT SCHOOL_YEAR AS cohort_SCHOOL_YEAR, STUDENT_ANNUAL_GRADE_CODE AS cohort_STUDENT_ANNUAL_GRADE_CODE,
  SCHOOL_KEY AS cohort_SCHOOL_KEY, {_PEER_SELECT} FROM peers
""")
def peer_stats(spark, d):
    return b.rounded(peers.peer_stats(b.scoring_cohort(spark, d), b.PEERS, **b.MEASURES))


@query("peer_enriched", "WITH " + b.SCORING + "," + b.enriched_sql("scoring") + f"""
SELECT SCHOOL_YEAR, STUDENT_KEY, {_PEER_SELECT} FROM enriched
""")
def peer_enriched(spark, d):
    enriched = peers.peer_enriched(b.scoring_cohort(spark, d, keep=True), b.PEERS, **b.MEASURES)
    return b.rounded(enriched.select("SCHOOL_YEAR", "STUDENT_KEY", *b.COHORT_NAMES))


@query("union_fill", """
SELECT o_orderkey AS id, o_totalprice AS amount, o_orderpriority AS priority, CAST(NULL AS DOUBLE) AS discount FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice, NULL, l_discount FROM lineitem
""")
def union_fill(spark, d):
    orders = load(spark, d, "orders").select(
        C("o_orderkey").alias("id"), C("o_totalprice").alias("amount"), C("o_orderpriority").alias("priority")
    )
    lines = load(spark, d, "lineitem").select(
        C("l_orderkey").alias("id"), C("l_extendedprice").alias("amount"), C("l_discount").alias("discount")
    )
    return cohort.pool([orders, lines])


@query("binary_outcome", "WITH " + b.ANNUAL + "," + b.OUTCOME + """
SELECT SCHOOL_YEAR, STUDENT_KEY, grad_ind, CAST(grad_ind = 'on-time' AS INT) AS ontime_grad
FROM outcome WHERE grad_ind <> 'exitWIpublicK12'
""")
def binary_outcome(spark, d):
    labels = b.outcome(spark, d, b.annual(spark, d))
    return cleaning.binary_outcome(labels.select("SCHOOL_YEAR", "STUDENT_KEY", "grad_ind"))


_CLEAN_KEEP = ["STUDENT_KEY", "SCHOOL_YEAR", "ESL_LEV", "FRL", "EVER_RETAINED", "GENDER", "SWD", "LEP", "ATT_RATE",
               "DAYS_POSS", "DISTRICT_KEY", "GRADE_KEY", "Assault", "Drug", "Weapon", "SchoolRule", "daysRemoved", "incCount"]
_CLEAN_ROUND = {"ATT_RATE", "daysRemoved", "incCount"}
_CLEAN_SELECT = ", ".join(f"{b.r(c)} AS {c}" if c in _CLEAN_ROUND else c for c in _CLEAN_KEEP)


@query("clean_pool", "WITH " + b.SCORING + "," + b.clean_sql("scoring") + f"SELECT {_CLEAN_SELECT} FROM cleaned")
def clean_pool(spark, d):
    return b.rounded(cleaning.clean_pool(b.scoring_cohort(spark, d)).select(*_CLEAN_KEEP))


@query("complete_cases", "WITH " + b.SCORING + "," + b.clean_sql("scoring") + f"""
SELECT {_CLEAN_SELECT} FROM cleaned WHERE STUDENT_RACE IS NOT NULL AND ESL_LEV IS NOT NULL AND FRL IS NOT NULL
  AND SWD IS NOT NULL AND ATT_RATE IS NOT NULL AND DAYS_POSS IS NOT NULL AND READ_SS IS NOT NULL AND MATH_SS IS NOT NULL
""")
def complete_cases(spark, d):
    return b.rounded(cleaning.complete_cases(cleaning.clean_pool(b.scoring_cohort(spark, d))).select(*_CLEAN_KEEP))


@query("complete_case_counts", "WITH " + b.SCORING + "," + b.clean_sql("scoring") + """
SELECT SCHOOL_YEAR, count(*) AS total, count(*) FILTER (STUDENT_RACE IS NOT NULL AND ESL_LEV IS NOT NULL AND FRL IS NOT NULL
  AND SWD IS NOT NULL AND ATT_RATE IS NOT NULL AND DAYS_POSS IS NOT NULL AND READ_SS IS NOT NULL AND MATH_SS IS NOT NULL)
  AS complete FROM cleaned GROUP BY 1
""")
def complete_case_counts(spark, d):
    return cleaning.complete_case_counts(cleaning.clean_pool(b.scoring_cohort(spark, d)), ["SCHOOL_YEAR"])


_POOL_KEEP = [*_CLEAN_KEEP, "READ_SS", "MATH_SS", "STUDENT_RACE", *b.COHORT_NAMES, "ontime_grad"]
_POOL_EXACT = {"cohort_size", "cohort_suspPeers", "STUDENT_RACE", "ontime_grad"} | (set(_CLEAN_KEEP) - _CLEAN_ROUND)
_POOL_SELECT = ", ".join(c if c in _POOL_EXACT else f"{b.r(c)} AS {c}" for c in _POOL_KEEP)


_PREPARED = "WITH " + b.TRAINING + "," + b.enriched_sql("training") + "," + b.clean_sql("enriched", ", duplicated") + """,
prepared AS (
  SELECT *, CAST(grad_ind = 'on-time' AS INT) AS ontime_grad FROM cleaned
  WHERE grad_ind <> 'exitWIpublicK12' AND STUDENT_RACE IS NOT NULL AND ESL_LEV IS NOT NULL AND FRL IS NOT NULL
    AND SWD IS NOT NULL AND ATT_RATE IS NOT NULL AND DAYS_POSS IS NOT NULL AND READ_SS IS NOT NULL AND MATH_SS IS NOT NULL
    AND cohort_sd_read IS NOT NULL AND cohort_sd_math IS NOT NULL AND cohort_sd_attend IS NOT NULL)
"""


@query("training_pool", _PREPARED + f"SELECT {_POOL_SELECT} FROM prepared")
def training_pool(spark, d):
    """The whole preparation: assemble, compare with peers, recode, complete cases, target."""
    pool = workflow.prepare_pool(b.training_cohort(spark, d, keep=True), b.PEERS, **b.MEASURES)
    return b.rounded(pool.select(*_POOL_KEEP))


# Text columns of the pool and their levels; the first sorted level is the baseline.
_LEVELS = {
    "STUDENT_RACE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "removalType": ["EX", "None", "OS"], "ESL_LEV": ["High", "Low", "Medium", "Native"], "FRL": ["N", "Y"],
    "EVER_RETAINED": ["N", "Unk", "Y"], "GENDER": ["F", "M"], "SWD": ["No", "Yes"], "LEP": ["No", "Yes"],
}
_NUMBERS = ["READ_SS", "MATH_SS", "incCount", "daysRemoved", "DISTRICT_COUNT", "SCHOOL_COUNT", "ENROLLMENTS_COUNT",
            "ATT_RATE", "DAYS_POSS", "Assault", "Drug", "Weapon", "SchoolRule", *b.COHORT_NAMES]


@query("training_matrix", _PREPARED + "SELECT STUDENT_KEY, SCHOOL_YEAR, CAST(ontime_grad AS DOUBLE) AS ontime_grad, " + ", ".join(
    [f"CAST({c} = '{v}' AS DOUBLE) AS {c}{v}" for c, levels in _LEVELS.items() for v in levels[1:]]
    + [f"{b.r(f'CAST({c} AS DOUBLE)')} AS {c}" for c in _NUMBERS]
) + " FROM prepared")
def training_matrix(spark, d):
    """The pool as numbers: keys and the outcome label leave, text becomes 0/1 columns."""
    pool = workflow.prepare_pool(b.training_cohort(spark, d, keep=True), b.PEERS, **b.MEASURES)
    matrix = features.model_matrix(
        pool, target="ontime_grad", keep=["STUDENT_KEY", "SCHOOL_YEAR"],
        exclude=[*features.key_columns(pool), "grad_ind"], known_levels=_LEVELS,
    )
    return b.rounded(matrix)
