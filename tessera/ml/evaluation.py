"""Metrics: MLlib evaluators, and the same numbers as plain aggregates."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import share_true


def binary_metrics(scored: DataFrame, label_col="label", raw_col="rawPrediction") -> dict[str, float]:
    """Areas under the ROC and PR curves over every distinct score (no thinning)."""
    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol=raw_col, numBins=0)
    return {"areaUnderROC": ev.setMetricName("areaUnderROC").evaluate(scored),
            "areaUnderPR": ev.setMetricName("areaUnderPR").evaluate(scored)}


def regression_sums(label_col="label", prediction_col="prediction") -> list:
    """Aggregates n, sse, sae, sst, syy, covariance and the predictions' spread over the rows with label and prediction."""
    both = F.col(label_col).isNotNull() & F.col(prediction_col).isNotNull()
    y, p = (F.when(both, F.col(c).cast("double")) for c in (label_col, prediction_col))
    n = F.count(y)
    return [n.alias("n"), F.sum((y - p) * (y - p)).alias("sse"), F.sum(F.abs(y - p)).alias("sae"),
            (F.var_pop(y) * n).alias("sst"), F.sum(y * y).alias("syy"), F.covar_pop(y, p).alias("covariance"), F.var_pop(F.when(both, p)).alias("spread")]


def regression_metrics(scored: DataFrame, label_col="label", prediction_col="prediction") -> dict[str, float]:
    """rmse, r2 (1 - SSE/SST) and mae in one pass; NaN without rows, r2 NaN without spread."""
    r = scored.agg(*regression_sums(label_col, prediction_col)).first()
    nan = float("nan")
    if not r["n"]:
        return {"rmse": nan, "r2": nan, "mae": nan}
    return {"rmse": (r["sse"] / r["n"]) ** 0.5, "r2": 1 - r["sse"] / r["sst"] if r["sst"] else nan,
            "mae": r["sae"] / r["n"]}


def accuracy(scored: DataFrame, label_col="label", prediction_col="prediction") -> float:
    return accuracy_aggregate(scored, label_col, accuracy=prediction_col).first()["accuracy"]


def accuracy_aggregate(scored: DataFrame, label_col="label", **predictions) -> DataFrame:
    """Accuracy of several prediction columns in one pass (null = wrong)."""
    return scored.agg(*[share_true(F.col(c) == F.col(label_col)).alias(name)
                        for name, c in predictions.items()])


def drop_prediction_columns(df: DataFrame) -> DataFrame:
    """``evaluate`` refuses frames that already carry prediction columns."""
    return df.drop("prediction", "rawPrediction", "probability")
