"""Feature preparation, class balance, evaluation and ranking of results."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import base as b
from vigilo.operators import balance, cleaning, evaluate, features, ranking, robust
from vigilo.sources.tables import load, stage

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


def _rounded_list(columns, digits=6):
    return ", ".join(f"{b.r(c, digits)} AS {c}" for c in columns)


# ---------------------------------------------------------------- matrix and splits

_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_DUMMIES = ", ".join(f"CAST(segment = '{s}' AS DOUBLE) AS segment{s}" for s in _SEGMENTS)


@query("find_binary", "WITH " + b.FEAT + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) < 3 AS is_binary FROM feat" for c in [*b.FEATURES, "segment", "y"]
))
def find_binary(spark, d):
    return features.find_binary(b.features(spark, d), [*b.FEATURES, "segment", "y"])


@query("class_balance", "WITH " + b.FEAT + """
SELECT segment, y, count(*) AS n, row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, y) AS size_rank
FROM feat GROUP BY 1, 2
""")
def class_balance(spark, d):
    return features.class_balance(b.features(spark, d), "y", by=["segment"])


@query("class_labels", "WITH " + b.FEAT + """,
big AS (SELECT y FROM feat WHERE total > 1000 GROUP BY 1 ORDER BY count(*) DESC, y LIMIT 1)
SELECT id, CASE WHEN y = (SELECT y FROM big) THEN 'Grad' ELSE 'Non.Grad' END AS class FROM feat
""")
def class_labels(spark, d):
    return features.class_labels(b.features(spark, d), "y", train=C("total") > 1000).select("id", "class")


@query("model_matrix", "WITH " + b.FEAT + f"""
SELECT id, CAST(y AS DOUBLE) AS y, {_DUMMIES}, {", ".join(b.FEATURES)} FROM feat
""")
def model_matrix(spark, d):
    return features.model_matrix(b.features(spark, d), target="y", keep=["id"])


@query("score_matrix", "WITH " + b.FEAT + f"""
SELECT id, {_DUMMIES}, {", ".join(b.FEATURES)} FROM feat
""")
def score_matrix(spark, d):
    """Levels are those of the training rows; everybody is scored."""
    everyone = b.features(spark, d)
    train = features.three_way_split(everyone, ["id"], mode="PROD").where("split = 'traindata'")
    return features.model_matrix(everyone.drop("y"), keep=["id"], known_levels=features.levels(train, ["segment"]))


@query("three_way_split", "WITH " + b.FEAT + f""",
p AS (SELECT 0.45 AS t, 0.25 AS v)
SELECT id, CASE WHEN u < t THEN 'traindata' WHEN u < t + v THEN 'validdata' ELSE 'testdata' END AS split
FROM (SELECT id, {b.SPLIT_U} AS u FROM feat), p
""")
def three_way_split(spark, d):
    return features.three_way_split(b.features(spark, d), ["id"], mode="PROD").select("id", "split")


_SPLIT = b.FEAT + f""",
sp AS (SELECT *, CASE WHEN u < 0.45 THEN 'traindata' WHEN u < 0.7 THEN 'validdata' ELSE 'testdata' END AS split
       FROM (SELECT *, {b.SPLIT_U} AS u FROM feat))
"""


def _split(spark, d):
    return features.three_way_split(b.features(spark, d), ["id"], shares=(0.45, 0.25))


_SCALED = ", ".join(
    f"{b.r(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in b.CONTINUOUS
)
_STATS = "st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in [*b.CONTINUOUS, "flagged"]
) + " FROM sp WHERE split = '{}')"


@query("fit_scaler", "WITH " + _SPLIT + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{'continuous' if c != 'flagged' else 'binary'}' AS kind, {b.r(f'avg({c})')} AS mean, "
    + (b.r(f"stddev_samp({c})") if c != "flagged" else "CAST(1 AS DOUBLE)") + " AS std FROM sp WHERE split = 'traindata'"
    for c in b.FEATURES
))
def fit_scaler(spark, d):
    return b.rounded(features.fit_scaler(_split(spark, d), b.CONTINUOUS, ["flagged"], split="split"))


@query("standardize", "WITH " + _SPLIT + "," + _STATS.format("traindata") + f"""
SELECT id, split, {_SCALED}, {b.r("flagged - m_flagged")} AS flagged FROM sp, st
""")
def standardize(spark, d):
    rows = _split(spark, d)
    scaler = features.fit_scaler(rows, b.CONTINUOUS, ["flagged"], split="split")
    out = features.standardize(rows, scaler, b.CONTINUOUS, binary=["flagged"])
    return b.rounded(out.select("id", "split", *b.FEATURES))


@query("standardize_per_split", "WITH " + _SPLIT + "," + _STATS.format("testdata") + f"""
SELECT id, split, {_SCALED}, {b.r("flagged - avg(flagged) OVER (PARTITION BY split)")} AS flagged FROM sp, st
""")
def standardize_per_split(spark, d):
    rows = _split(spark, d)
    scaler = features.fit_scaler(rows, b.CONTINUOUS, split="split", fit_on="testdata")
    out = features.standardize(rows, scaler, b.CONTINUOUS, binary=["flagged"], per_split="split")
    return b.rounded(out.select("id", "split", *b.FEATURES))


@query("unstandardize", "WITH " + b.FEAT + f"SELECT id, {_rounded_list(b.FEATURES, 4)} FROM feat")
def unstandardize(spark, d):
    rows = _split(spark, d)
    scaler = features.fit_scaler(rows, b.CONTINUOUS, ["flagged"], split="split")
    scaled = features.standardize(rows, scaler, b.CONTINUOUS, binary=["flagged"])
    back = features.unstandardize(scaled, scaler, b.CONTINUOUS, binary=["flagged"])
    return b.rounded(back.select("id", *b.FEATURES), 4)


@query("uncenter", "WITH " + b.FEAT + f"SELECT id, {b.r('flagged')} AS flagged FROM feat")
def uncenter(spark, d):
    rows = b.features(spark, d)
    scaler = features.fit_scaler(rows, [], ["flagged"])
    centred = features.standardize(rows, scaler, [], binary=["flagged"])
    return b.rounded(features.uncenter(centred, ["flagged"]).select("id", "flagged"))


@query("align_columns", "WITH " + b.FEAT + """
SELECT id, total, CAST(0 AS DOUBLE) AS absent, acctbal, CAST(0 AS DOUBLE) AS gone FROM feat
""")
def align_columns(spark, d):
    return features.align_columns(b.features(spark, d), ["total", "absent", "acctbal", "gone"], keep=["id"])


@query("poly_terms", "WITH " + b.FEAT + f"""
SELECT id, {b.r("pow(urgent, 2)")} AS urgent_2, {b.r("pow(urgent, 3)")} AS urgent_3, {b.r("pow(recent, 2)")} AS recent_2,
  {b.r("recent * flagged")} AS recent_x_flagged FROM feat
""")
def poly_terms(spark, d):
    out = features.poly_terms(b.features(spark, d), {"urgent": 3, "recent": 2}, [("recent", "flagged")])
    return b.rounded(out.select("id", "urgent_2", "urgent_3", "recent_2", "recent_x_flagged"))


@query("known_levels", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size > 47 THEN NULL ELSE p_type END AS kind, p_size FROM part),
seen AS (SELECT kind, count(*) AS n FROM p WHERE p_size < 25 AND kind <> 'PROMO' GROUP BY 1),
best AS (SELECT kind FROM seen ORDER BY n DESC, kind LIMIT 1)
SELECT p_partkey, CASE WHEN kind IN (SELECT kind FROM seen) THEN kind ELSE (SELECT kind FROM best) END AS kind FROM p
""")
def known_levels(spark, d):
    parts = load(spark, d, "part").select(
        "p_partkey", F.when(C("p_size") <= 47, C("p_type")).alias("kind"), "p_size"
    )
    train = parts.where("p_size < 25 AND kind <> 'PROMO'")
    return features.known_levels(parts, train, "kind").select("p_partkey", "kind")


@query("drop_collinear", "SELECT vec_id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)
) + " FROM embeddings")
def drop_collinear(spark, d):
    """Embedding coordinates with two columns that others determine, which must be found."""
    wide = load(spark, d, "embeddings").select(
        "vec_id", *[C("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)]
    )
    wide = wide.withColumns({"sum01": C("e0") + C("e1"), "twice": C("e5") * 2})
    return features.drop_collinear(wide, [c for c in wide.columns if c != "vec_id"])


# ---------------------------------------------------------------- class balance

_RANKED = b.FEAT + """,
rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(id AS VARCHAR)), id) AS rk,
              count(*) OVER (PARTITION BY y) AS n FROM feat),
sz AS (SELECT max(n) AS top, min(n) AS low FROM rk)
"""


@query("upsample", "WITH " + _RANKED + """
SELECT id, y, copy FROM (
  SELECT id, y, unnest(range(top // n + CASE WHEN rk <= top % n THEN 1 ELSE 0 END)) AS copy FROM rk, sz)
""")
def upsample(spark, d):
    return balance.upsample(b.features(spark, d), "y", "id").select("id", "y", "copy")


@query("downsample", "WITH " + _RANKED + """
SELECT id, CASE WHEN y > 0 THEN 'Move' ELSE 'NoMove' END AS class FROM rk, sz WHERE rk <= low
""")
def downsample(spark, d):
    moved = balance.move_class(b.features(spark, d), "y", above=0)
    return balance.downsample(moved, "class", "id").select("id", "class")


@query("smote")
def smote(spark, d):
    rows = stage(b.features(spark, d), "features")
    return balance.smote(rows, b.CONTINUOUS, "y", "id", minority=1)


# ---------------------------------------------------------------- evaluation

_CURVE = """
sc AS (SELECT {by}score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM {src} GROUP BY ALL),
cu AS (SELECT *, sum(pos) OVER w AS pu, sum(neg) OVER w AS nu, lag(score) OVER w AS below,
              sum(pos) OVER (PARTITION BY {part}) AS P, sum(neg) OVER (PARTITION BY {part}) AS N FROM sc
       WINDOW w AS (PARTITION BY {part} ORDER BY score)),
pt AS (SELECT {by}CASE WHEN below IS NULL THEN CAST('-inf' AS DOUBLE) ELSE (below + score) / 2 END AS threshold,
              (P - pu + pos) / P AS sensitivity, (nu - neg) / N AS specificity, P, N FROM cu
       UNION ALL SELECT DISTINCT {by}CAST('inf' AS DOUBLE), CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), P, N FROM cu)
"""
_BY_MODEL = b.LONG + "," + _CURVE.format(by="model, ", src="long", part="model")


@query("roc_curve", "WITH " + _BY_MODEL + f"""
SELECT model, {b.r("threshold")} AS threshold, {b.r("sensitivity")} AS sensitivity, {b.r("specificity")} AS specificity FROM pt
""")
def roc_curve(spark, d):
    return b.rounded(evaluate.roc_curve(b.long_scores(spark, d), "score", "y", by=["model"]))


@query("roc_auc", "WITH " + _BY_MODEL + f"""
SELECT model, {b.r("sum(CAST(neg AS DOUBLE) * (P - pu + pos / 2)) / max(P * N)")} AS auc,
  CAST(max(P) AS BIGINT) AS positives, CAST(max(N) AS BIGINT) AS negatives FROM cu GROUP BY 1
""")
def roc_auc(spark, d):
    return b.rounded(evaluate.roc_auc(b.long_scores(spark, d), "score", "y", by=["model"]))


_DIST = "pow(1 - sensitivity, 2) + ((1 - P / (P + N)) / (P / (P + N))) * pow(1 - specificity, 2)"


@query("best_threshold", "WITH " + _BY_MODEL + f""",
ds AS (SELECT *, {_DIST} AS distance FROM pt)
SELECT model, {b.r("threshold")} AS threshold, {b.r("sensitivity")} AS sensitivity, {b.r("specificity")} AS specificity,
  {b.r("distance")} AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY distance, threshold) AS rn FROM ds) WHERE rn = 1
""")
def best_threshold(spark, d):
    return b.rounded(evaluate.best_threshold(b.long_scores(spark, d), "score", "y", by=["model"]))


@query("best_model", "WITH " + _BY_MODEL + f"""
SELECT model, {b.r("auc")} AS auc FROM (
  SELECT model, sum(CAST(neg AS DOUBLE) * (P - pu + pos / 2)) / max(P * N) AS auc FROM cu GROUP BY 1)
ORDER BY auc DESC, model LIMIT 1
""")
def best_model(spark, d):
    return b.rounded(evaluate.best_model(b.long_scores(spark, d), "score", "y", model="model"))


@query("confusion", "WITH " + b.LONG + f""",
k AS (SELECT model, count(*) FILTER (score >= 0.4 AND y = 1) AS tp, count(*) FILTER (score >= 0.4 AND y = 0) AS fp,
             count(*) FILTER (score < 0.4 AND y = 1) AS fn, count(*) FILTER (score < 0.4 AND y = 0) AS tn FROM long GROUP BY 1),
e AS (SELECT *, (tp + tn) / (tp + fp + fn + tn) AS acc,
             ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / pow(tp + fp + fn + tn, 2) AS ch FROM k)
SELECT model, tp, fp, fn, tn, {b.r("acc")} AS accuracy, {b.r("(acc - ch) / nullif(1 - ch, 0)")} AS kappa,
  {b.r("tp / nullif(tp + fn, 0)")} AS sensitivity, {b.r("tn / nullif(tn + fp, 0)")} AS specificity,
  {b.r("tp / nullif(tp + fp, 0)")} AS precision, {b.r("tn / nullif(tn + fn, 0)")} AS negative_value FROM e
""")
def confusion(spark, d):
    return b.rounded(evaluate.confusion(b.long_scores(spark, d), "score", "y", F.lit(0.4), by=["model"]))


@query("ecdf_rank", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
                  CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  CAST(floor(cume_dist() OVER (ORDER BY l_extendedprice) * 100) AS BIGINT) AS price_rank,
  CASE WHEN q IS NULL THEN NULL ELSE
    CAST(floor(count(q) OVER (ORDER BY q NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         / (SELECT count(q) FROM p) * 100) AS BIGINT) END AS quantity_rank FROM p
""")
def ecdf_rank(spark, d):
    rows = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.when(C("l_returnflag") != "N", C("l_quantity")).alias("q"),
    )
    return evaluate.ecdf_rank(rows, {"l_extendedprice": "price_rank", "q": "quantity_rank"}).drop("q")


@query("group_ci", f"""
SELECT l_returnflag, {b.r("avg(l_quantity) - 1.1503493803760079 * stddev_samp(l_quantity) / sqrt(count(*))")} AS lower,
  {b.r("avg(l_quantity)")} AS mean,
  {b.r("avg(l_quantity) + 1.1503493803760079 * stddev_samp(l_quantity) / sqrt(count(*))")} AS upper
FROM lineitem GROUP BY 1
""")
def group_ci(spark, d):
    return b.rounded(evaluate.group_ci(load(spark, d, "lineitem"), "l_returnflag", "l_quantity"))


@query("simple_regression", f"""
SELECT l_returnflag, {b.r("regr_slope(l_extendedprice, l_quantity)", 4)} AS slope,
  {b.r("regr_intercept(l_extendedprice, l_quantity)", 4)} AS intercept,
  {b.r("regr_r2(l_extendedprice, l_quantity)", 4)} AS r2,
  CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1
""")
def simple_regression(spark, d):
    return b.rounded(evaluate.simple_regression(
        load(spark, d, "lineitem"), "l_extendedprice", "l_quantity", by=["l_returnflag"]
    ), 4)


@query("error_quantiles", f"""
SELECT l_returnflag, {b.r("quantile_cont(l_extendedprice - 1500 * l_quantity, 0.1) / (max(l_extendedprice) - min(l_extendedprice))")} AS q10,
  {b.r("quantile_cont(l_extendedprice - 1500 * l_quantity, 0.9) / (max(l_extendedprice) - min(l_extendedprice))")} AS q90
FROM lineitem GROUP BY 1
""")
def error_quantiles(spark, d):
    rows = load(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", (C("l_quantity") * 1500).alias("estimate"))
    return b.rounded(evaluate.error_quantiles(rows, "l_extendedprice", "estimate", by=["l_returnflag"]))


_VCOV = [[0.5, 0.01, -0.02], [0.01, 0.003, 0.001], [-0.02, 0.001, 0.004]]


@query("prediction_variance", "WITH " + b.FEAT + f"""
SELECT id, {b.r("1.5 + 0.2 * urgent - 0.1 * recent")} AS fit,
  {b.r("0.5 + 2 * 0.01 * urgent - 2 * 0.02 * recent + 0.003 * urgent * urgent + 2 * 0.001 * urgent * recent + 0.004 * recent * recent")} AS se_fit
FROM feat
""")
def prediction_variance(spark, d):
    out = robust.prediction_variance(
        b.features(spark, d), ["urgent", "recent"], _VCOV, coefficients=[0.2, -0.1], intercept=1.5
    )
    return b.rounded(out.select("id", "fit", "se_fit"))


# ---------------------------------------------------------------- ranking

_RESULTS = "res AS (SELECT p_name AS method, p_type AS grp, CASE WHEN p_brand <> 'Brand#1' THEN p_size / 50 END AS auc, p_retailprice AS elapsed FROM part)"


def _results(spark, d):
    return load(spark, d, "part").select(
        C("p_name").alias("method"), C("p_type").alias("grp"),
        F.when(C("p_brand") != "Brand#1", C("p_size") / 50).alias("auc"), C("p_retailprice").alias("elapsed"),
    )


@query("topk_distinct", "WITH " + _RESULTS + """,
s AS (SELECT DISTINCT auc FROM res WHERE auc IS NOT NULL),
t AS (SELECT 'top' AS "end", auc FROM (SELECT auc FROM s ORDER BY auc DESC LIMIT 5) UNION ALL
      SELECT 'bottom', auc FROM (SELECT auc FROM s ORDER BY auc LIMIT 5))
SELECT DISTINCT "end", method, res.auc AS auc FROM res JOIN t ON res.auc = t.auc
""")
def topk_distinct(spark, d):
    return ranking.topk_distinct(_results(spark, d), "auc", "method")


@query("efficiency_topn", "WITH " + _RESULTS + f"""
SELECT method, grp, auc, elapsed, {b.r("auc / sqrt(elapsed) * 1000")} AS efficiency FROM (SELECT DISTINCT * FROM res)
ORDER BY auc / sqrt(elapsed) * 1000 DESC NULLS LAST, method LIMIT 8
""")
def efficiency_topn(spark, d):
    out = ranking.efficiency_topn(
        _results(spark, d), "method", efficiency_col=ranking.efficiency(C("auc"), C("elapsed"))
    )
    return b.rounded(out)


@query("error_efficiency_topn", "WITH " + _RESULTS + """
SELECT method, grp, auc, elapsed, round_even(10 / (elapsed / 1000 + auc * auc), 2) AS efficiency
FROM (SELECT DISTINCT * FROM res) ORDER BY efficiency DESC NULLS LAST, method, elapsed LIMIT 8
""")
def error_efficiency_topn(spark, d):
    efficiency = ranking.error_efficiency(C("auc"), C("elapsed") / 1000)
    return ranking.efficiency_topn(_results(spark, d), "method", efficiency_col=efficiency, ties=["elapsed"])


@query("budget_topn", "WITH " + _RESULTS + f"""
SELECT method, grp, auc, elapsed, {b.r("auc / sqrt(elapsed) * 1000")} AS efficiency FROM (SELECT DISTINCT * FROM res)
WHERE elapsed < 12 * 85 ORDER BY auc / sqrt(elapsed) * 1000 DESC NULLS LAST, method LIMIT 8
""")
def budget_topn(spark, d):
    return b.rounded(ranking.budget_topn(
        _results(spark, d), "method", elapsed="elapsed",
        efficiency_col=ranking.efficiency(C("auc"), C("elapsed")), grade=12,
    ))


@query("search_summary", "WITH " + _RESULTS + """
SELECT method, max(auc) AS auc, bool_or(auc IS NOT NULL) AS succeeded FROM res GROUP BY 1
""")
def search_summary(spark, d):
    return ranking.search_summary(_results(spark, d), "method", "auc")


# ---------------------------------------------------------------- preliminary scoring

@query("prelim_fill", """
WITH y AS (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INT) AS year, count(*) AS moves,
                  CASE WHEN count(*) < 5 THEN CAST(count(*) AS DOUBLE) * 2 END AS estimate,
                  CAST(count(DISTINCT o_orderstatus) AS DOUBLE) AS att FROM orders GROUP BY 1, 2)
SELECT y.k, y.year, y.att AS "att.ACT", y.estimate AS att, p.moves AS moves
FROM y LEFT JOIN y p ON p.k = y.k AND p.year = y.year - 1 WHERE y.estimate IS NOT NULL
""")
def prelim_fill(spark, d):
    n = F.count(F.lit(1))
    years = load(spark, d, "orders").groupBy(C("o_custkey").alias("k"), F.year("o_orderdate").alias("year")).agg(
        n.alias("moves"), F.when(n < 5, n.cast("double") * 2).alias("estimate"),
        F.count_distinct(C("o_orderstatus")).cast("double").alias("att"),
    )
    return cleaning.prelim_fill(
        years, estimates={"att": "estimate"}, carried={"moves": "moves"}, history=years, key=["k"], year="year"
    )
