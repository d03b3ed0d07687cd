"""Pipelines of SQL steps, feature steps and an estimator; save and load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import Binarizer, SQLTransformer, VectorAssembler


def prepared_rows(keep: str, derived: Mapping[str, str]) -> SQLTransformer:
    """One SQL stage: rows for which ``keep`` holds, with the ``derived`` columns (name: expression) added."""
    added = "".join(f", {expression} AS {name}" for name, expression in derived.items())
    return SQLTransformer(statement=f"SELECT *{added} FROM __THIS__ WHERE {keep}")


def staged_pipeline(keep: str, derived: Mapping[str, str], thresholds: Mapping[str, tuple[str, float]],
                    features: Sequence[str], estimator: Estimator) -> Pipeline:
    """Row filter and derived columns, 0/1 labels (name: column, threshold), feature vector, estimator."""
    labels = [Binarizer(inputCol=column, outputCol=name, threshold=cut) for name, (column, cut) in thresholds.items()]
    vector = VectorAssembler(inputCols=list(features), outputCol=estimator.getFeaturesCol())
    return Pipeline(stages=[prepared_rows(keep, derived), *labels, vector, estimator])


def save_pipeline(pipeline, path: str) -> None:
    pipeline.write().overwrite().save(path)


def load_pipeline(path: str) -> Pipeline:
    return Pipeline.read().load(path)


def load_pipeline_model(path: str) -> PipelineModel:
    return PipelineModel.read().load(path)
