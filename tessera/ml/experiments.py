"""Parameterised model runs recorded as rows of a Parquet table.

Each run fits a linear regression with one setting (intercept or not,
training share), scores the held-out part, and appends one row
``(run_id, fit_intercept, train_fraction, n_train, n_test, r2, r2_summary,
r_squared_corr, rmse)`` to the table at ``table_path``.  ``r2`` is
``1 - SSE/SST`` on the test part; ``r2_summary`` is the training summary's
value, which without an intercept is measured against zero and so is not
comparable across the two settings; ``r_squared_corr`` is the squared
correlation of label and prediction.

Each run is written to its own folder ``run_id=<id>`` with mode overwrite,
and the id is a hash of the run's settings: a run that is retried after a
failure replaces its own row instead of adding a second one.  A run reads the
data twice: the fit, and one aggregate over both parts.  A figure that is not
defined (no test row, no spread) is null.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sampling import HASH_SPACE, hash_unit
from .evaluation import regression_sums
from .models import linear_regression

RUN_SCHEMA = ("fit_intercept boolean, train_fraction double, n_train long, n_test long, "
              "r2 double, r2_summary double, r_squared_corr double, rmse double")


def _r2(sums, against: str) -> float | None:
    return 1 - sums["sse"] / sums[against] if sums and sums[against] else None


def _squared_correlation(sums) -> float | None:
    if not sums or not sums["sst"] or not sums["spread"]:
        return None
    return sums["covariance"] ** 2 / (sums["sst"] / sums["n"] * sums["spread"])


def run_experiments(data: DataFrame, params: list[dict], table_path: str, key_cols: list[str],
                    features_col="features", label_col="label") -> DataFrame:
    spark = data.sparkSession
    for p in params:
        frac, intercept = float(p.get("train_fraction", 0.7)), bool(p.get("fit_intercept", True))
        in_train = hash_unit(*key_cols) < F.lit(int(frac * HASH_SPACE))
        model = linear_regression(features_col, label_col, fit_intercept=intercept,
                                  solver="normal").fit(data.where(in_train))
        # one pass gives the figures of both parts
        parts = {r["in_train"]: r for r in model.transform(data).groupBy(in_train.alias("in_train"))
                 .agg(*regression_sums(label_col)).collect()}
        train, test = parts[True], parts.get(False)
        run_id = hashlib.md5(json.dumps(p, sort_keys=True).encode()).hexdigest()[:16]
        row = (intercept, frac, train["n"], test["n"] if test else 0, _r2(test, "sst"),
               _r2(train, "sst" if intercept else "syy"),
               _squared_correlation(test),
               math.sqrt(test["sse"] / test["n"]) if test and test["n"] else None)
        spark.createDataFrame([row], RUN_SCHEMA).write.mode("overwrite").parquet(
            f"{table_path.rstrip('/')}/run_id={run_id}")
    # the partition column is read as declared: a hex id must not be inferred as a number
    return spark.read.schema(f"{RUN_SCHEMA}, run_id string").parquet(table_path)
