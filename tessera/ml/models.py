"""Estimators and what is read off fitted models, as DataFrames."""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import feature_metadata


def linear_regression(features_col="features", label_col="label", fit_intercept=True,
                      reg_param=0.0, elastic_net=0.0, **kw) -> LinearRegression:
    """Least squares; ``elastic_net=1.0`` with ``reg_param > 0`` is the lasso."""
    return LinearRegression(featuresCol=features_col, labelCol=label_col, fitIntercept=fit_intercept,
                            regParam=reg_param, elasticNetParam=elastic_net, **kw)


def logistic_regression(features_col="features", label_col="label", **kw) -> LogisticRegression:
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, **kw)


def fit_classifier(kind: str, train: DataFrame, features_col="features", label_col="label", **kw):
    """One entry point for the MLlib classifiers: tree, forest, gbt, logistic,
    svc, naive_bayes, mlp (``layers=`` required), ovr (one-vs-rest logistic)."""
    common = dict(featuresCol=features_col, labelCol=label_col)
    if kind == "tree":
        est = DecisionTreeClassifier(**common, **kw)
    elif kind == "forest":
        est = RandomForestClassifier(**common, **kw)
    elif kind == "gbt":
        est = GBTClassifier(**common, **kw)
    elif kind == "logistic":
        est = LogisticRegression(**common, **kw)
    elif kind == "svc":
        est = LinearSVC(**common, **kw)
    elif kind == "naive_bayes":
        est = NaiveBayes(**common, **kw)
    elif kind == "mlp":
        est = MultilayerPerceptronClassifier(**common, **kw)
    elif kind == "ovr":
        est = OneVsRest(classifier=LogisticRegression(maxIter=kw.pop("maxIter", 50)), **common, **kw)
    else:
        raise ValueError(f"unknown classifier kind {kind!r}")
    return est.fit(train)


def model_parameters(spark: SparkSession, model) -> DataFrame:
    """Every parameter of a fitted model with its value and description, as strings."""
    rows = [(p.name, str(model.getOrDefault(p)), p.doc) for p in model.params if model.hasDefault(p) or model.isSet(p)]
    return spark.createDataFrame(sorted(rows), "param string, value string, description string")


def training_summary(spark: SparkSession, model) -> DataFrame:
    """(total_iterations, first_objective, last_objective) of an iterative fit."""
    s = model.summary
    history = list(s.objectiveHistory)
    return spark.createDataFrame([(int(s.totalIterations), float(history[0]), float(history[-1]))],
                                 "total_iterations int, first_objective double, last_objective double")


def coefficient_table(spark: SparkSession, model, names=None) -> DataFrame:
    """Intercept and coefficients of a linear model: (term, value)."""
    coefs = model.coefficients.toArray().tolist()
    names = names or [f"x{i}" for i in range(len(coefs))]
    rows = [("intercept", float(model.intercept))] + [(n, float(c)) for n, c in zip(names, coefs)]
    return spark.createDataFrame(rows, "term string, value double")


def objective_history(spark: SparkSession, model) -> DataFrame:
    """Training objective per iteration (iteration 0 is the start)."""
    hist = model.summary.objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, objective double")


def roc_curve(model) -> DataFrame:
    """Training ROC curve (FPR, TPR) of a binary logistic model: a DataFrame
    MLlib computes distributed from the scored training data."""
    return model.summary.roc


def feature_importances(model, scored: DataFrame, features_col: str = "features",
                        top: int | None = 10) -> DataFrame:
    """Tree-ensemble importances by feature name, highest first."""
    meta = feature_metadata(scored, features_col)
    imp = model.featureImportances.toArray().tolist()
    scores = scored.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(imp)],
                                                 "idx int, score double")
    out = meta.join(scores, "idx").orderBy(F.desc("score"), F.asc("idx"))
    return out.limit(top) if top else out


def least_squares_one_feature(df: DataFrame, x: str, y: str) -> DataFrame:
    """Intercept, slope, R², RMSE and n of ``y ~ x`` in one aggregate pass.

    The closed form of a one-feature linear regression: the residual sum of
    squares is ``Syy − Sxy²/Sxx`` on centred sums, so no second pass over
    the residuals is needed.  Equal to ``LinearRegression`` with an
    intercept and no regularisation.
    """
    agg = df.agg(F.regr_intercept(y, x).alias("intercept"), F.regr_slope(y, x).alias("slope"),
                 F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"),
                 F.regr_sxy(y, x).alias("sxy"), F.regr_count(y, x).alias("n"))
    sse = F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")
    return agg.select("intercept", "slope", "r2",
                      F.sqrt(F.greatest(sse, F.lit(0.0)) / F.col("n")).alias("rmse"), "n")
