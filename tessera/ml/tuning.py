"""Parameter grids, holdout and k-fold validation; metrics per grid point."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame


def param_grid(grid: dict, base: dict | None = None) -> list:
    """``ParamGridBuilder().baseOn(base).addGrid(p, values)...build()``."""
    b = ParamGridBuilder()
    if base:
        b = b.baseOn(base)
    for param, values in grid.items():
        b = b.addGrid(param, list(values))
    return b.build()


LEAST_ROWS, MOST_ROWS = 5_000, 200_000


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt by ``key`` over as many partitions as there are cores,
    ``LEAST_ROWS`` to ``MOST_ROWS`` in each, and in order of it.

    Joins leave small rows in a few partitions (one up to some megabytes), but
    a fit passes over them hundreds of times: its time follows the fullest
    partition, not their size.  The order makes seeded samples of the rows the
    same in every run.
    """
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, rows // LEAST_ROWS), rows // MOST_ROWS)
    return df.repartition(parts, key).sortWithinPartitions(key)


def _metric_rows(spark, maps, metrics, names) -> DataFrame:
    rows = []
    for m, value in zip(maps, metrics):
        by_name = {p.name: v for p, v in m.items()}
        rows.append(tuple(float(by_name[n]) for n in names) + (float(value),))
    schema = ", ".join(f"{n} double" for n in names) + ", metric double"
    return spark.createDataFrame(rows, schema)


def holdout(estimator, maps, evaluator, train: DataFrame, train_ratio=0.75, seed=54321,
            parallelism=4):
    """TrainValidationSplit; the training frame is persisted because every grid
    point reads it.  Returns (fitted validator, DataFrame of metric per grid
    point).  ``bestModel`` is refitted on all of ``train``."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                               trainRatio=train_ratio, seed=seed, parallelism=parallelism)
    try:
        model = tvs.fit(train)
    finally:
        train.unpersist()
    names = sorted({p.name for m in maps for p in m})
    return model, _metric_rows(train.sparkSession, maps, model.validationMetrics, names)


def kfold(estimator, maps, evaluator, train: DataFrame, folds=3, seed=54321, parallelism=4):
    """CrossValidator; returns (fitted validator, DataFrame of mean metric per grid point)."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=folds, seed=seed, parallelism=parallelism)
    try:
        model = cv.fit(train)
    finally:
        train.unpersist()
    names = sorted({p.name for m in maps for p in m})
    return model, _metric_rows(train.sparkSession, maps, model.avgMetrics, names)
