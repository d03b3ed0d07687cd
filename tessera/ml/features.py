"""Feature steps on MLlib: binarise, index, one-hot, assemble, metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Binarizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def binarize(df: DataFrame, input_col: str, output_col: str, threshold: float) -> DataFrame:
    """1.0 above the threshold, else 0.0.  Binarizer needs a double input, so
    the column is cast first; rows with a null input should be filtered
    before (Binarizer turns null into 0.0)."""
    tmp = f"{input_col}__double"
    out = Binarizer(inputCol=tmp, outputCol=output_col, threshold=threshold).transform(
        df.withColumn(tmp, F.col(input_col).cast("double")))
    return out.drop(tmp)


def index_categories(df: DataFrame, input_col: str, output_col: str,
                     handle_invalid: str = "error"):
    """StringIndexer by descending frequency (ties alphabetical).  Returns
    ``(model, transformed)``; ``model.labels`` lists labels by index.  With
    ``keep`` a null or unseen value gets an extra last index instead of
    failing (and a later one-hot vector gets one more slot)."""
    model = StringIndexer(inputCol=input_col, outputCol=output_col, handleInvalid=handle_invalid,
                          stringOrderType="frequencyDesc").fit(df)
    return model, model.transform(df)


def one_hot(df: DataFrame, input_col: str, output_col: str, drop_last: bool = True):
    """OneHotEncoder is an estimator in Spark 3+: fit then transform."""
    model = OneHotEncoder(inputCol=input_col, outputCol=output_col, dropLast=drop_last).fit(df)
    return model, model.transform(df)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Numeric, boolean and vector columns into one vector column."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def vector_columns(df: DataFrame, vector_col: str, size: int, prefix: str) -> list:
    """Columns ``prefix_0 .. prefix_{size-1}`` holding the vector's entries."""
    arr = vector_to_array(F.col(vector_col))
    return [arr[i].alias(f"{prefix}_{i}") for i in range(size)]


def feature_metadata(df: DataFrame, features_col: str = "features") -> DataFrame:
    """Feature index → name and kind, from the assembled column's ``ml_attr``
    metadata (what a feature importance is reported against)."""
    attrs = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    rows = [(int(a["idx"]), str(a["name"]), kind) for kind, items in attrs.items() for a in items]
    return df.sparkSession.createDataFrame(sorted(rows), "idx int, name string, kind string")


def feature_count(df: DataFrame, features_col: str = "features") -> int:
    return int(df.schema[features_col].metadata.get("ml_attr", {}).get("num_attrs", 0)) or \
        len(df.select(features_col).first()[0])
