"""Grouped summaries, frequency tables and one-pass shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import share_true


def grouped_count_mean(df: DataFrame, key: str | Column, value: str,
                       count_name: str = "n", mean_name: str = "avg_value",
                       sum_name: str | None = None) -> DataFrame:
    """``groupBy(key).agg(count(*), avg(value))``: partial then final aggregate."""
    aggs = [F.count(F.lit(1)).alias(count_name), F.avg(value).alias(mean_name)]
    if sum_name:
        aggs.append(F.sum(value).alias(sum_name))
    return df.groupBy(key).agg(*aggs)


def frequency(df: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    """Frequency table of one or more keys, null as its own group, sorted by key."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(*[F.col(k) if isinstance(k, str) else k for k in out.columns[:len(keys)]])


def label_by_feature(df: DataFrame, feature: str, label: str) -> DataFrame:
    """Count and mean label per feature value, sorted by feature.

    The mean of a 0/1 label is the observed share of positives.
    """
    return (df.groupBy(feature)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("mean_label"))
            .orderBy(feature))


def shares(df: DataFrame, **predicates: Column) -> DataFrame:
    """Several ``filter(p).count() / count()`` ratios in one aggregate pass."""
    return df.agg(*[share_true(p).alias(name) for name, p in predicates.items()])


def group_by_expression(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Count rows per value of an expression (null is its own group)."""
    return df.groupBy(expr.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def sort_splittable(df: DataFrame, cols: list[str], tiebreak: str | list[str],
                    ascending: bool = True) -> DataFrame:
    """Global sort whose range partitions can split a hot key.

    A global sort range-partitions on the sort key; when one key value holds
    a large share of rows, all of them land in one partition.  Appending a
    unique column refines the order without changing it (ties were in no
    defined order anyway) and lets the range bounds cut through the hot key.
    """
    extra = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    keys = [F.col(c).asc() if ascending else F.col(c).desc() for c in cols]
    return df.orderBy(*keys, *[F.col(c).asc() for c in extra])
