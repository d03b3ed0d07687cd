"""Indexing and one-hot encoding of columns with very many categories.

``StringIndexer`` brings every label to the driver and sends the list to all
tasks.  Here the dictionary is a table: counts by value, numbered by
descending count and then by value in range partitions.  Rows get their index
by a join, which splits values that hold a large share of the rows.  One-hot
vectors are sparse: their size and the place of the one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_splitting_hot_keys
from ..operators.ranking import numbered
from ..session import stored


class UnseenCategory(ValueError):
    """A value that the dictionary lacks, where that is an error."""


def category_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, n, index) of every non-null value; index 0 has the most rows, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counts, [F.desc("n"), F.asc("value")], "index")


def index_with(df: DataFrame, dictionary: DataFrame, column: str, output: str, handle_invalid: str = "error",
               min_share: float = 0.01) -> DataFrame:
    """``df`` with the index (a double, as the indexer gives) of ``column``.

    Null and unseen values: an error before anything is returned, their rows
    skipped, or kept with one index beyond the last.
    """
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(f"handle_invalid must be error, skip or keep, not {handle_invalid!r}")
    words = dictionary.select(F.col("value").alias("__value"), F.col("index").cast("double").alias(output))
    how = "inner" if handle_invalid == "skip" else "left"
    out = join_splitting_hot_keys(df, words, column, "__value", how, min_share).drop("__value")
    if handle_invalid == "keep":
        size = float(dictionary.count())
        return out.withColumn(output, F.coalesce(output, F.lit(size)))
    if handle_invalid == "error":
        out = stored(out, "indexed")
        if not out.where(F.col(output).isNull()).isEmpty():
            raise UnseenCategory(f"column {column!r} has nulls or values that the dictionary lacks")
    return out


def one_hot_sparse(df: DataFrame, index: str, size: int, output: str, drop_last: bool = True) -> DataFrame:
    """``index`` as a sparse 0/1 vector: struct of size, indices and values.

    With ``drop_last`` the last category is the vector without a one, as in the
    dense encoder; an index that is null or out of range has none either.
    """
    width = size - 1 if drop_last else size
    one = F.col(index).isNotNull() & (F.col(index) >= 0) & (F.col(index) < F.lit(width))
    at = F.when(one, F.array(F.col(index).cast("int"))).otherwise(F.array().cast("array<int>"))
    value = F.when(one, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>"))
    return df.withColumn(output, F.struct(F.lit(width).alias("size"), at.alias("indices"), value.alias("values")))
