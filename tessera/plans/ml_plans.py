"""Feature, model, evaluation, tuning and pipeline queries.

Where a model has a closed form on the chosen inputs the oracle states it in
SQL: least squares on one feature is ``regr_slope``/``regr_intercept``; a
logistic regression on one binary feature predicts the mean label of each
feature value; a decision tree on it predicts the majority label of each
value; ROC and PR areas are rank sums over the distinct scores.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import evaluation as EV
from ..ml import features as FE
from ..ml import models as MO
from ..ml import pipelines as PL
from ..ml import tuning as TU
from ..ml.experiments import run_experiments
from ..ml.forests import CountedForestClassifier
from ..operators.sampling import hash_split
from ..operators.stats import typed_crosstab
from ..session import scratch_path
from .frames import RATED_SQL, rated
from .registry import query, round_doubles, table

_HASH = "('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT"
_CUT_70 = int(0.7 * 2 ** 32)


# ---- inputs ---------------------------------------------------------------

def _five_star(spark, d):
    """Non-cancelled rated orders with the binary label and the review flag."""
    r = rated(spark, d).where(F.col("cancelled") == 0)
    r = FE.binarize(r, "star_rating", "five_star_rating", 4.5)
    return r.withColumn("reviewed", F.col("review").isNotNull())


_FIVE_STAR_SQL = f"""(SELECT id, CASE WHEN CAST(star_rating AS DOUBLE) > 4.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y,
    review IS NOT NULL AS reviewed, CAST(star_rating AS DOUBLE) AS star_rating_double,
    {_HASH} < {_CUT_70} AS is_train
  FROM {RATED_SQL} WHERE cancelled = 0)"""


def _rated_customers(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"),
                                           F.col("c_mktsegment").alias("segment"),
                                           F.col("c_acctbal").alias("acctbal"))
    return rated(spark, d).join(c, "custkey").withColumn("reviewed", F.col("review").isNotNull())


_SEG_INDEX_SQL = """(SELECT c_mktsegment AS segment,
    CAST(row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS DOUBLE) AS idx
  FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment))"""


def _segment_features(df):
    idx_model, df = FE.index_categories(df, "segment", "segment_index")
    _, df = FE.one_hot(df, "segment_index", "segment_encoded")
    return idx_model, df


# ---- features --------------------------------------------------------------

@query("m1_binarizer", f"SELECT id, y AS five_star_rating FROM {_FIVE_STAR_SQL}", "M1")
def m1_binarizer(spark, d):
    return _five_star(spark, d).select("id", "five_star_rating")


@query("m2_string_indexer", f"""
SELECT c.c_custkey, c.c_mktsegment, s.idx AS segment_index
FROM customer c JOIN {_SEG_INDEX_SQL} s ON c.c_mktsegment = s.segment""", "M2")
def m2_string_indexer(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    _, out = FE.index_categories(c, "c_mktsegment", "segment_index")
    return out


@query("m3_one_hot_encoder", f"""
SELECT c.c_custkey, {", ".join(f"CASE WHEN s.idx = {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS oh_{k}" for k in range(4))}
FROM customer c JOIN {_SEG_INDEX_SQL} s ON c.c_mktsegment = s.segment""", "M3")
def m3_one_hot_encoder(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    _, out = _segment_features(c)
    return out.select("c_custkey", *FE.vector_columns(out, "segment_encoded", 4, "oh"))


_SEG_INDEX_JOINED_SQL = f"""(SELECT c_mktsegment AS segment,
    CAST(row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS DOUBLE) AS idx
  FROM (SELECT c.c_mktsegment, count(*) AS n FROM {RATED_SQL} r JOIN customer c ON r.custkey = c.c_custkey
        GROUP BY c.c_mktsegment))"""

_ASSEMBLED_SQL = f"""
SELECT r.id, CAST(r.review IS NOT NULL AS DOUBLE) AS f_0, r.totalprice AS f_1,
       {", ".join(f"CASE WHEN s.idx = {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f_{k + 2}" for k in range(4))}
FROM {RATED_SQL} r JOIN customer c ON r.custkey = c.c_custkey
JOIN {_SEG_INDEX_JOINED_SQL} s ON c.c_mktsegment = s.segment"""


def _assembled(spark, d):
    _, df = _segment_features(_rated_customers(spark, d))
    return FE.assemble(df, ["reviewed", "totalprice", "segment_encoded"], "features")


@query("m4_vector_assembler", _ASSEMBLED_SQL, "M4")
def m4_vector_assembler(spark, d):
    out = _assembled(spark, d)
    return out.select("id", *FE.vector_columns(out, "features", 6, "f"))


@query("m5_feature_table_roundtrip", _ASSEMBLED_SQL, "M5 S13 S5")
def m5_feature_table_roundtrip(spark, d):
    path = scratch_path(spark, "features")
    _assembled(spark, d).select("id", "features").write.parquet(path)
    back = spark.read.parquet(path)
    return back.select("id", *FE.vector_columns(back, "features", 6, "f"))


@query("m6_feature_metadata", f"""
SELECT 0 AS idx, 'reviewed' AS name, 'numeric' AS kind
UNION ALL SELECT 1, 'totalprice', 'numeric'
UNION ALL SELECT CAST(idx AS INTEGER) + 2, 'segment_encoded_' || segment, 'binary' FROM {_SEG_INDEX_JOINED_SQL}
WHERE idx < 4""", "M6")
def m6_feature_metadata(spark, d):
    return FE.feature_metadata(_assembled(spark, d), "features")


# ---- linear models ---------------------------------------------------------

def _line_data(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("label"))
    return FE.assemble(li, ["x"], "features")


_FIT_SQL = """WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
c AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b, regr_r2(y, x) AS r2 FROM t)"""


@query("m7_linear_regression", f"""{_FIT_SQL}
SELECT round(a, 4) AS intercept, round(b, 4) AS slope, round(r2, 6) AS r2,
       round(sqrt(avg(power(y - (a + b * x), 2))), 2) AS rmse, count(*) AS n
FROM t, c GROUP BY a, b, r2""", "M7 M13")
def m7_linear_regression(spark, d):
    model = MO.linear_regression(solver="normal").fit(_line_data(spark, d))
    s = model.summary
    return spark.createDataFrame(
        [(round(float(model.intercept), 4), round(float(model.coefficients[0]), 4), round(float(s.r2), 6),
          round(float(s.rootMeanSquaredError), 2), int(s.numInstances))],
        "intercept double, slope double, r2 double, rmse double, n long")


@query("m7_least_squares_aggregate", f"""{_FIT_SQL}
SELECT round(a, 4) AS intercept, round(b, 4) AS slope, round(r2, 6) AS r2,
       round(sqrt(avg(power(y - (a + b * x), 2))), 2) AS rmse, count(*) AS n
FROM t, c GROUP BY a, b, r2""", "M7 V6")
def m7_least_squares_aggregate(spark, d):
    li = table(spark, d, "lineitem")
    out = MO.least_squares_one_feature(li, "l_quantity", "l_extendedprice")
    return out.select(F.round("intercept", 4).alias("intercept"), F.round("slope", 4).alias("slope"),
                      F.round("r2", 6).alias("r2"), F.round("rmse", 2).alias("rmse"), "n")


@query("m8_no_intercept_regression", """
WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
c AS (SELECT sum(x * y) / sum(x * x) AS b, avg(y) AS ybar FROM t)
SELECT round(b, 4) AS slope,
       round(1 - sum(power(y - b * x, 2)) / sum(power(y - ybar, 2)), 6) AS r2_evaluator,
       round(1 - sum(power(y - b * x, 2)) / sum(y * y), 6) AS r2_summary
FROM t, c GROUP BY b, ybar""", "M8 M18")
def m8_no_intercept_regression(spark, d):
    data = _line_data(spark, d)
    model = MO.linear_regression(fit_intercept=False, solver="normal").fit(data)
    r2_eval = RegressionEvaluator(metricName="r2").evaluate(model.transform(data))
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 4), round(float(r2_eval), 6), round(float(model.summary.r2), 6))],
        "slope double, r2_evaluator double, r2_summary double")


@query("m18_regression_evaluator", f"""{_FIT_SQL}
SELECT round(sqrt(avg(power(y - (a + b * x), 2))), 2) AS rmse,
       round(1 - sum(power(y - (a + b * x), 2)) / (var_pop(y) * count(*)), 6) AS r2,
       round(avg(abs(y - (a + b * x))), 2) AS mae
FROM t, c GROUP BY a, b""", "M18 M16")
def m18_regression_evaluator(spark, d):
    data = _line_data(spark, d)
    scored = MO.linear_regression(solver="normal").fit(data).transform(data)
    m = EV.regression_metrics(scored)
    return spark.createDataFrame([(round(m["rmse"], 2), round(m["r2"], 6), round(m["mae"], 2))],
                                 "rmse double, r2 double, mae double")


@query("m9_lasso", None, "M9")
def m9_lasso(spark, d):
    _, df = _segment_features(_rated_customers(spark, d))
    data = FE.assemble(df, ["totalprice", "acctbal", "segment_encoded"], "features") \
        .withColumn("label", F.col("star_rating").cast("double"))
    model = MO.linear_regression(reg_param=0.01, elastic_net=1.0).fit(data)
    return MO.coefficient_table(spark, model, ["totalprice", "acctbal", "seg_0", "seg_1", "seg_2", "seg_3"])


_LASSO_PENALTY = 1000.0


@query("m9_lasso_one_feature", f"""
WITH m AS (SELECT corr(l_quantity, l_extendedprice) AS r, stddev_samp(l_extendedprice) AS sy, stddev_samp(l_quantity) AS sx,
                  avg(l_extendedprice) AS my, avg(l_quantity) AS mx, count(*) AS n FROM lineitem),
b AS (SELECT *, sign(r) * greatest(abs(r) - {_LASSO_PENALTY} / sy * n / (n - 1), 0) * sy / sx AS slope FROM m)
SELECT round(my - slope * mx, 2) AS intercept, round(slope, 3) AS slope FROM b""", "M9")
def m9_lasso_one_feature(spark, d):
    """With one feature the lasso is a soft threshold of the correlation."""
    model = MO.linear_regression(reg_param=_LASSO_PENALTY, elastic_net=1.0, tol=1e-12, maxIter=500).fit(_line_data(spark, d))
    return spark.createDataFrame([(round(float(model.intercept), 2), round(float(model.coefficients[0]), 3))],
                                 "intercept double, slope double")


# ---- classification --------------------------------------------------------

def _binary_data(spark, d):
    r = _five_star(spark, d)
    return FE.assemble(r, ["reviewed"], "features").withColumnRenamed("five_star_rating", "label")


def _fit_logistic(train):
    return MO.logistic_regression(regParam=0.0, tol=1e-10, maxIter=200).fit(train)


@query("m10_logistic_regression", f"""
SELECT reviewed, round(avg(y), 6) AS probability FROM {_FIVE_STAR_SQL} GROUP BY reviewed""", "M10 M16")
def m10_logistic_regression(spark, d):
    data = _binary_data(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = _fit_logistic(data)
    finally:
        data.unpersist()
    scored = model.transform(data)
    return round_doubles(scored.groupBy("reviewed")
                         .agg(F.first(vector_to_array("probability")[1]).alias("probability")))


@query("m11_decision_tree", f"""
SELECT reviewed, CASE WHEN avg(y) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM {_FIVE_STAR_SQL} GROUP BY reviewed""", "M11")
def m11_decision_tree(spark, d):
    data = _binary_data(spark, d)
    model = MO.fit_classifier("tree", data)
    return model.transform(data).groupBy("reviewed").agg(F.first("prediction").alias("prediction"))


@query("m11_tree_rules_text", None, "M11")
def m11_tree_rules_text(spark, d):
    model = MO.fit_classifier("tree", _binary_data(spark, d))
    lines = model.toDebugString.splitlines()
    return spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "line int, text string")


_SCORES_SQL = f"""WITH t AS {_FIVE_STAR_SQL},
s AS (SELECT reviewed, avg(y) AS score FROM t WHERE is_train GROUP BY reviewed),
te AS (SELECT t.id, t.y, s.score FROM t JOIN s ON t.reviewed = s.reviewed WHERE NOT t.is_train),
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM te GROUP BY score),
c AS (SELECT score, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
             sum(pos) OVER (ORDER BY score DESC) AS ctp, sum(neg) OVER (ORDER BY score DESC) AS cfp
      FROM g),
pr AS (SELECT score, ctp / (SELECT sum(pos) FROM g) AS recall, ctp / (ctp + cfp) AS prec FROM c),
pr2 AS (SELECT recall, prec, coalesce(lag(recall) OVER (ORDER BY score DESC), 0) AS prev_recall,
               coalesce(lag(prec) OVER (ORDER BY score DESC), prec) AS prev_prec FROM pr)"""


def _holdout_scored(spark, d):
    data = _binary_data(spark, d)
    train, test = hash_split(data, ["id"], 0.7)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_logistic(train), test
    finally:
        train.unpersist()


@query("m15_holdout_area_under_roc", f"""{_SCORES_SQL}
SELECT round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS area_under_roc FROM c""",
       "M15 M14 K5")
def m15_holdout_area_under_roc(spark, d):
    model, test = _holdout_scored(spark, d)
    auc = EV.binary_metrics(model.transform(test))["areaUnderROC"]
    return spark.createDataFrame([(round(float(auc), 9),)], "area_under_roc double")


@query("m16_predict_holdout", f"""{_SCORES_SQL}
SELECT id, CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(score, 6) AS probability FROM te""",
       "M16")
def m16_predict_holdout(spark, d):
    model, test = _holdout_scored(spark, d)
    scored = model.transform(test)
    return round_doubles(scored.select("id", "prediction", vector_to_array("probability")[1].alias("probability")))


@query("m17_evaluator_roc_pr", f"""{_SCORES_SQL}
SELECT (SELECT round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) FROM c) AS area_under_roc,
       (SELECT round(sum((recall - prev_recall) * (prec + prev_prec) / 2), 9) FROM pr2) AS area_under_pr""",
       "M17 M15")
def m17_evaluator_roc_pr(spark, d):
    model, test = _holdout_scored(spark, d)
    return _areas(spark, model.transform(test))


def _areas(spark, scored, **columns):
    m = EV.binary_metrics(scored, **columns)
    return spark.createDataFrame([(round(float(m["areaUnderROC"]), 9), round(float(m["areaUnderPR"]), 9))],
                                 "area_under_roc double, area_under_pr double")


@query("m17_many_scores_roc_pr", f"""
WITH te AS (SELECT totalprice AS score, CASE WHEN CAST(star_rating AS DOUBLE) > 4.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y
            FROM {RATED_SQL} WHERE cancelled = 0),
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM te GROUP BY score),
c AS (SELECT score, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
             sum(pos) OVER (ORDER BY score DESC) AS ctp, sum(neg) OVER (ORDER BY score DESC) AS cfp FROM g),
pr AS (SELECT score, ctp / (SELECT sum(pos) FROM g) AS recall, ctp / (ctp + cfp) AS prec FROM c),
pr2 AS (SELECT recall, prec, coalesce(lag(recall) OVER (ORDER BY score DESC), 0) AS prev_recall,
               coalesce(lag(prec) OVER (ORDER BY score DESC), prec) AS prev_prec FROM pr)
SELECT (SELECT round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) FROM c) AS area_under_roc,
       (SELECT round(sum((recall - prev_recall) * (prec + prev_prec) / 2), 9) FROM pr2) AS area_under_pr""", "M17")
def m17_many_scores_roc_pr(spark, d):
    """Areas over nearly as many scores as rows: the price as a score of a top rating."""
    return _areas(spark, _five_star(spark, d).select("totalprice", "five_star_rating"),
                  label_col="five_star_rating", raw_col="totalprice")


@query("m19_accuracy_vs_constant_baseline", f"""
WITH t AS {_FIVE_STAR_SQL},
f AS (SELECT reviewed, star_rating_double AS r, count(*) AS n FROM t GROUP BY 1, 2),
m AS (SELECT reviewed, arg_max(r, n * 10 - r) AS mode FROM f GROUP BY reviewed)
SELECT round(avg(CASE WHEN t.star_rating_double = m.mode THEN 1.0 ELSE 0.0 END), 9) AS accuracy_model,
       round(avg(CASE WHEN t.star_rating_double = 5.0 THEN 1.0 ELSE 0.0 END), 9) AS accuracy_baseline
FROM t JOIN m ON t.reviewed = m.reviewed""", "M19 P7 A17")
def m19_accuracy_vs_constant_baseline(spark, d):
    data = FE.assemble(_five_star(spark, d), ["reviewed"], "features") \
        .withColumn("star_rating_double", F.col("star_rating").cast("double"))
    model = MO.fit_classifier("tree", data, label_col="star_rating_double")
    scored = model.transform(data).withColumn("prediction_baseline", F.lit(5.0))
    return round_doubles(EV.accuracy_aggregate(scored, "star_rating_double", accuracy_model="prediction",
                                               accuracy_baseline="prediction_baseline"), 9)


@query("m12_forest_of_one_full_tree", f"""
SELECT reviewed, CASE WHEN avg(y) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM {_FIVE_STAR_SQL} GROUP BY reviewed""", "M12")
def m12_forest_of_one_full_tree(spark, d):
    """One tree on all features and all rows predicts what a single tree does."""
    data = _binary_data(spark, d)
    model = MO.fit_classifier("forest", data, numTrees=1, featureSubsetStrategy="all", bootstrap=False, seed=1)
    return model.transform(data).groupBy("reviewed").agg(F.first("prediction").alias("prediction"))


@query("m12_random_forest_multiclass", None, "M12 A15")
def m12_random_forest_multiclass(spark, d):
    _, df = _segment_features(_rated_customers(spark, d).where(F.col("cancelled") == 0))
    data = FE.assemble(df, ["reviewed", "totalprice", "acctbal", "segment_encoded"], "features") \
        .withColumn("star_rating", F.col("star_rating").cast("double"))
    model = MO.fit_classifier("forest", data, label_col="star_rating", numTrees=20, maxDepth=5, seed=12345)
    return typed_crosstab(model.transform(data), "prediction", "star_rating", [1.0, 2.0, 3.0, 4.0, 5.0])


@query("m14_training_area_under_roc", f"""
WITH t AS {_FIVE_STAR_SQL},
s AS (SELECT reviewed, avg(y) AS score FROM t GROUP BY reviewed),
g AS (SELECT s.score, sum(t.y) AS pos, sum(1 - t.y) AS neg FROM t JOIN s ON t.reviewed = s.reviewed
      GROUP BY s.score),
c AS (SELECT pos, neg,
             coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS area_under_roc FROM c""", "M14")
def m14_training_area_under_roc(spark, d):
    data = _binary_data(spark, d)
    auc = EV.binary_metrics(_fit_logistic(data).transform(data))["areaUnderROC"]
    return spark.createDataFrame([(round(float(auc), 9),)], "area_under_roc double")


@query("m13_model_parameters", None, "M13")
def m13_model_parameters(spark, d):
    return MO.model_parameters(spark, _fit_logistic(_binary_data(spark, d)))


@query("m13_training_summary", f"""
WITH t AS {_FIVE_STAR_SQL},
p AS (SELECT reviewed, avg(y) AS p, count(*) AS n FROM t GROUP BY reviewed),
a AS (SELECT avg(y) AS p FROM t)
SELECT true AS iterations_counted, (SELECT round(-(p * ln(p) + (1 - p) * ln(1 - p)), 6) FROM a) AS first_objective,
       round(-sum(n * (p * ln(p) + (1 - p) * ln(1 - p))) / sum(n), 6) AS last_objective FROM p""", "M13")
def m13_training_summary(spark, d):
    """An unpenalised logistic fit starts at the entropy of the label and ends at that given the feature."""
    out = MO.training_summary(spark, _fit_logistic(_binary_data(spark, d)))
    return out.select((F.col("total_iterations") > 0).alias("iterations_counted"), F.round("first_objective", 6).alias("first_objective"),
                      F.round("last_objective", 6).alias("last_objective"))


@query("m13_objective_history", None, "M13")
def m13_objective_history(spark, d):
    return MO.objective_history(spark, _fit_logistic(_binary_data(spark, d)))


@query("m14_training_roc_curve", f"""
WITH t AS {_FIVE_STAR_SQL},
s AS (SELECT reviewed, avg(y) AS score FROM t GROUP BY reviewed),
g AS (SELECT s.score, sum(t.y) AS pos, sum(1 - t.y) AS neg FROM t JOIN s ON t.reviewed = s.reviewed
      GROUP BY s.score),
c AS (SELECT sum(neg) OVER (ORDER BY score DESC) / (SELECT sum(neg) FROM g) AS FPR,
             sum(pos) OVER (ORDER BY score DESC) / (SELECT sum(pos) FROM g) AS TPR FROM g)
SELECT round(FPR, 9) AS FPR, round(TPR, 9) AS TPR FROM c
UNION ALL SELECT 0.0, 0.0 UNION ALL SELECT 1.0, 1.0""", "M14")
def m14_training_roc_curve(spark, d):
    return round_doubles(MO.roc_curve(_fit_logistic(_binary_data(spark, d))), 9)


@query("m10_other_classifiers", None, "M10 M19")
def m10_other_classifiers(spark, d):
    _, df = _segment_features(_rated_customers(spark, d).where(F.col("cancelled") == 0))
    data = FE.assemble(df.withColumn("star_rating_double", F.col("star_rating").cast("double")),
                       ["reviewed", "segment_encoded"], "features")
    data = FE.binarize(data, "star_rating", "label", 4.5).persist(StorageLevel.MEMORY_AND_DISK)
    kinds = {"gbt": dict(maxIter=10, seed=1), "svc": dict(maxIter=20), "naive_bayes": {},
             "mlp": dict(layers=[5, 4, 2], maxIter=50, seed=1), "ovr": dict(maxIter=20),
             "forest": dict(numTrees=10, seed=1)}
    rows = []
    try:
        for kind, kw in kinds.items():
            scored = MO.fit_classifier(kind, data, **kw).transform(data)
            rows.append((kind, float(EV.accuracy(scored))))
    finally:
        data.unpersist()
    return spark.createDataFrame(rows, "kind string, accuracy double")


# ---- tuning and pipelines --------------------------------------------------

def _lasso_data(spark, d):
    _, df = _segment_features(_rated_customers(spark, d))
    return FE.assemble(df, ["totalprice", "acctbal", "segment_encoded"], "features") \
        .withColumn("label", F.col("star_rating").cast("double"))


REG_PARAMS = [0.0, 0.02, 0.04, 0.06, 0.08, 0.1]


@query("m21_m23_holdout_tuning", None, "M20 M21 M23")
def m21_m23_holdout_tuning(spark, d):
    est = MO.linear_regression(elastic_net=1.0)
    maps = TU.param_grid({est.regParam: REG_PARAMS}, base={est.elasticNetParam: 1.0})
    _, metrics = TU.holdout(est, maps, RegressionEvaluator(metricName="rmse"), _lasso_data(spark, d))
    return metrics


@query("m22_m23_kfold_tuning", None, "M20 M22 M23")
def m22_m23_kfold_tuning(spark, d):
    est = MO.linear_regression(elastic_net=1.0)
    maps = TU.param_grid({est.regParam: REG_PARAMS})
    _, metrics = TU.kfold(est, maps, RegressionEvaluator(metricName="r2"), _lasso_data(spark, d), folds=3)
    return metrics


def rating_pipeline():
    """A tree that tells top ratings of kept rows from whether there is a review."""
    from pyspark.ml.classification import DecisionTreeClassifier

    return PL.staged_pipeline(
        keep="NOT boolean(cancelled)", derived={"rating": "double(star_rating)", "reviewed": "isnotnull(review)"},
        thresholds={"five_star_rating": ("rating", 4.5)}, features=["reviewed"],
        estimator=DecisionTreeClassifier(labelCol="five_star_rating"))


@query("m24_m25_staged_model_save_load", f"""
WITH t AS {_FIVE_STAR_SQL},
m AS (SELECT reviewed, CASE WHEN avg(y) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM t GROUP BY reviewed)
SELECT m.prediction AS prediction_five_star_rating,
       count(*) FILTER (WHERE t.y = 0.0) AS "0.0", count(*) FILTER (WHERE t.y = 1.0) AS "1.0"
FROM t JOIN m ON t.reviewed = m.reviewed GROUP BY m.prediction""", "M24 M25 F11 P8 M1 A15")
def m24_m25_staged_model_save_load(spark, d):
    data = rated(spark, d)
    pipe_path, model_path = scratch_path(spark, "pipeline"), scratch_path(spark, "pipeline-model")
    PL.save_pipeline(rating_pipeline(), pipe_path)
    model = PL.load_pipeline(pipe_path).fit(data)
    model.write().overwrite().save(model_path)
    loaded = PL.load_pipeline_model(model_path)
    return typed_crosstab(loaded.transform(data), "prediction", "five_star_rating", [0.0, 1.0])


#: the reference's 18 points
FOREST_GRID = {"maxDepth": [5, 10, 20], "numTrees": [20, 50, 100], "subsamplingRate": [0.5, 1.0]}


@query("m24_validator_as_last_stage", None, "M24 M12 M20 M21")
def m24_validator_as_last_stage(spark, d, forest_grid=FOREST_GRID):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.tuning import TrainValidationSplit

    data = _rated_customers(spark, d).drop("reviewed").withColumn("star_rating", F.col("star_rating").cast("double"))
    train, test = hash_split(data, ["id"], 0.7)
    clf = CountedForestClassifier(featuresCol="features", labelCol="star_rating", seed=12345)
    grid = TU.param_grid({clf.getParam(name): values for name, values in forest_grid.items()})
    stages = [PL.prepared_rows("NOT boolean(cancelled)", {"reviewed": "isnotnull(review)"}),
              StringIndexer(inputCol="segment", outputCol="segment_index"),
              OneHotEncoder(inputCol="segment_index", outputCol="segment_encoded"),
              VectorAssembler(inputCols=["reviewed", "totalprice", "segment_encoded", "acctbal"],
                              outputCol="features"),
              TrainValidationSplit(estimator=clf, estimatorParamMaps=grid, seed=54321, parallelism=4,
                                   evaluator=MulticlassClassificationEvaluator(labelCol="star_rating",
                                                                               metricName="accuracy"))]
    train = TU.spread_rows(train, "id").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=stages).fit(train)
    finally:
        train.unpersist()
    best = model.stages[-1].bestModel
    scored = model.transform(TU.spread_rows(test, "id")).withColumn("prediction_baseline", F.lit(5.0))
    acc = EV.accuracy_aggregate(scored, "star_rating", accuracy_model="prediction",
                                accuracy_baseline="prediction_baseline").first()
    return spark.createDataFrame(
        [(int(best.getMaxDepth()), int(best.getNumTrees), float(best.getSubsamplingRate()),
          float(acc["accuracy_model"]), float(acc["accuracy_baseline"]))],
        "max_depth int, num_trees int, subsampling_rate double, accuracy_model double, accuracy_baseline double")


@query("m26_feature_importances_top10", None, "M26 M6 M12")
def m26_feature_importances_top10(spark, d):
    _, df = _segment_features(_rated_customers(spark, d).where(F.col("cancelled") == 0))
    data = FE.assemble(df, ["reviewed", "totalprice", "acctbal", "segment_encoded"], "features") \
        .withColumn("star_rating", F.col("star_rating").cast("double"))
    model = MO.fit_classifier("forest", data, label_col="star_rating", numTrees=20, maxDepth=5, seed=12345)
    return MO.feature_importances(model, model.transform(data), "features", top=10)


_RUNS = [{"fit_intercept": True, "train_fraction": 0.7}, {"fit_intercept": False, "train_fraction": 0.7},
         {"fit_intercept": True, "train_fraction": 0.5}]


def _runs_values_sql() -> str:
    import json

    rows = [f"('{json.dumps(p, sort_keys=True)}', {str(p['fit_intercept']).lower()}, {p['train_fraction']})"
            for p in _RUNS]
    return ", ".join(rows)


_M28_SQL = f"""
WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y,
                  ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT
                  AS h FROM lineitem),
runs AS (SELECT substr(md5(settings), 1, 16) AS run_id, fit_intercept, CAST(train_fraction AS DOUBLE) AS train_fraction,
                CAST(floor(train_fraction * 4294967296) AS BIGINT) AS cut
         FROM (VALUES {_runs_values_sql()}) v(settings, fit_intercept, train_fraction)),
fit AS (SELECT r.run_id,
               CASE WHEN r.fit_intercept THEN regr_intercept(t.y, t.x) ELSE 0.0 END AS a,
               CASE WHEN r.fit_intercept THEN regr_slope(t.y, t.x) ELSE sum(t.x * t.y) / sum(t.x * t.x) END AS b,
               count(*) AS n_train, regr_r2(t.y, t.x) AS r2_int, sum(t.y * t.y) AS syy0
        FROM runs r JOIN t ON t.h < r.cut GROUP BY r.run_id, r.fit_intercept),
tr AS (SELECT f.run_id, sum(power(t.y - f.b * t.x, 2)) AS sse0
       FROM fit f JOIN runs r ON f.run_id = r.run_id JOIN t ON t.h < r.cut GROUP BY f.run_id),
te AS (SELECT r.run_id, count(*) AS n_test, sum(power(t.y - (f.a + f.b * t.x), 2)) AS sse,
              var_pop(t.y) * count(*) AS sst, power(corr(t.y, f.a + f.b * t.x), 2) AS c2
       FROM runs r JOIN fit f ON f.run_id = r.run_id JOIN t ON t.h >= r.cut GROUP BY r.run_id)
SELECT r.run_id, r.fit_intercept, r.train_fraction, f.n_train, te.n_test,
       round(1 - te.sse / te.sst, 6) AS r2,
       round(CASE WHEN r.fit_intercept THEN f.r2_int ELSE 1 - tr.sse0 / f.syy0 END, 9) AS r2_summary,
       round(te.c2, 9) AS r_squared_corr, round(sqrt(te.sse / te.n_test), 2) AS rmse
FROM runs r JOIN fit f ON r.run_id = f.run_id JOIN tr ON r.run_id = tr.run_id JOIN te ON r.run_id = te.run_id"""


@query("m28_experiment_runs", _M28_SQL, "M28 M8 A18 K5")
def m28_experiment_runs(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                            F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("label"))
    data = FE.assemble(li, ["x"], "features")
    runs = run_experiments(data, _RUNS, scratch_path(spark, "experiments"), ["l_orderkey", "l_linenumber"])
    return runs.select("run_id", "fit_intercept", "train_fraction", "n_train", "n_test",
                       F.round("r2", 6).alias("r2"), F.round("r2_summary", 9).alias("r2_summary"),
                       F.round("r_squared_corr", 9).alias("r_squared_corr"), F.round("rmse", 2).alias("rmse"))
