"""Impurity gain of every candidate split, from one grouped count.

A tree's first split, and the importance it gives to a feature, follow from
the numbers of rows by feature value and label.  One job counts these for all
features at once; tasks add up theirs first, so the shuffle carries one row a
distinct (feature, value, label).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts_by_label(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, value, label, n); values as strings, nulls in a value or label left out."""
    named = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features])
    return (df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.explode(named).alias("f"))
            .where("f.value is not null").groupBy("f.feature", "f.value", "label").agg(F.count(F.lit(1)).alias("n")))


def _impurity(labels: Column, total: Column, kind: str) -> Column:
    share = F.transform(labels, lambda n: F.try_divide(n, total))
    if kind == "gini":
        return 1 - F.aggregate(share, F.lit(0.0), lambda a, p: a + p * p)
    if kind == "entropy":
        return -F.aggregate(share, F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    raise ValueError(f"impurity must be gini or entropy, not {kind!r}")


def split_gains(df: DataFrame, features: Sequence[str], label: str, impurity: str = "gini") -> DataFrame:
    """(feature, value, n_left, n_right, gain) of every split of one value against all others.

    For a column of two values both rows describe the same split.  A column of
    one value has none, and its gain is 0.  Columns of very many values should
    be binned first.
    """
    counts = value_counts_by_label(df, features, label)
    classes = [r["label"] for r in df.select(F.col(label).alias("label")).where("label is not null").distinct()
               .orderBy("label").collect()]  # the label's classes
    per_class = [F.coalesce(F.sum(F.when(F.col("label") == c, F.col("n"))), F.lit(0)).cast("double").alias(f"k{i}")
                 for i, c in enumerate(classes)]
    if not classes:
        return df.sparkSession.createDataFrame([], "feature string, value string, n_left double, n_right double, gain double")
    inside = counts.groupBy("feature", "value").agg(*per_class)
    whole = counts.groupBy("feature").agg(*[c.alias(f"t{i}") for i, c in enumerate(per_class)])
    k = range(len(classes))
    left, every = F.array(*[F.col(f"k{i}") for i in k]), F.array(*[F.col(f"t{i}") for i in k])
    right = F.array(*[F.col(f"t{i}") - F.col(f"k{i}") for i in k])

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    n, n_left, n_right = total(every), total(left), total(right)
    after = (n_left * _impurity(left, n_left, impurity) + n_right * _impurity(right, n_right, impurity)) / n
    gain = F.when(n_right > 0, _impurity(every, n, impurity) - after).otherwise(0.0)
    # one row a feature on one side: the planner may broadcast it by its size
    return (inside.join(whole, "feature")
            .select("feature", "value", n_left.alias("n_left"), n_right.alias("n_right"), gain.alias("gain")))
