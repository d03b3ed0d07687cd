"""Exploratory statistics computed in single aggregate passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .quantiles import exact_quantiles


def describe_typed(df: DataFrame, *cols: str) -> DataFrame:
    """``describe(cols)`` as typed long-form rows, all columns in one pass.

    Columns: column, count of non-null values (bigint), mean, stddev (sample),
    min, max (double) of those that are numbers.
    ``DataFrame.describe`` returns every statistic as a string; this keeps
    numbers numeric.
    """
    aggs = []
    for c in cols:
        x = F.col(c).try_cast("double")  # non-numeric text gives null, not an ANSI error
        aggs += [F.count(F.col(c)).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                     F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__stddev").alias("stddev"),
                     F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def shape_moments(df: DataFrame, col: str) -> DataFrame:
    """Population skewness and excess kurtosis."""
    return df.agg(F.skewness(col).alias("skewness"), F.kurtosis(col).alias("kurtosis"))


def pair_moments(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(x, y).alias("corr"), F.covar_samp(x, y).alias("covar_samp"),
                  F.covar_pop(x, y).alias("covar_pop"))


def approx_quantiles(df: DataFrame, col: str, probabilities: Sequence[float],
                     relative_error: float) -> DataFrame:
    """Approximate quantiles as ``(p, value)`` rows.

    ``percentile_approx`` with accuracy ``1/relative_error`` is the
    aggregate-expression form of ``approxQuantile``: it merges per-partition
    sketches, so only sketches move.  With relative error 0 the exact
    distributed operator is used instead.
    """
    if relative_error <= 0:
        return exact_quantiles(df, col, probabilities)
    accuracy = max(1, int(round(1.0 / relative_error)))
    probs = [float(p) for p in probabilities]
    arr = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, accuracy).alias("q"))
    return arr.select(F.posexplode("q").alias("i", "value")).select(
        F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("i") + 1).alias("p"), "value")


def crosstab_counts(df: DataFrame, row_key: str, col_key: str) -> DataFrame:
    """Contingency table in long form, for keys of any width: (row, column, n)."""
    return df.groupBy(row_key, col_key).agg(F.count(F.lit(1)).alias("n"))


def typed_crosstab(df: DataFrame, row_key: str, col_key: str,
                   col_values: Sequence | None = None) -> DataFrame:
    """Contingency table with typed keys: ``crosstab`` without string keys.

    One row per ``row_key`` value (first column named ``{row}_{col}`` like
    ``crosstab``), one bigint count column per ``col_key`` value, 0 where
    absent.  Values are taken from ``col_values`` or read off the
    pre-aggregated counts.  The null column is named ``null``, or
    ``null (missing)`` beside a value of that text.  Every value is a column of
    the plan; :func:`crosstab_counts` is the form for wide keys.
    """
    pairs = crosstab_counts(df, row_key, col_key)
    if col_values is None:
        # one pass over the data: the (row, col) counts are written to the
        # shared checkpoint folder and both the value list and the table are
        # read from there
        ensure_checkpoint_dir(df.sparkSession)
        pairs = pairs.checkpoint(eager=True)
        found = pairs.select(col_key).distinct().collect()
        col_values = sorted((r[0] for r in found), key=lambda v: (v is not None, v))
    values = list(col_values)
    texts = [str(v) for v in values if v is not None]
    names = [("null (missing)" if "null" in texts else "null") if v is None else str(v) for v in values]
    key = f"{row_key}_{col_key}"
    if not values:
        return pairs.select(F.col(row_key).alias(key)).distinct()
    # a position, not the value, is pivoted: a null value has one too
    position = F.coalesce(*[F.when(F.col(col_key).eqNullSafe(F.lit(v)), F.lit(i)) for i, v in enumerate(values)]) \
        if None in values else F.array_position(F.array(*[F.lit(v) for v in values]), F.col(col_key)).cast("int") - 1
    wide = pairs.withColumn("__at", position).groupBy(row_key).pivot("__at", list(range(len(values)))).sum("n")
    wide = wide.toDF(key, *[f"__c{i}" for i in range(len(values))])
    return wide.select(key, *[F.coalesce(F.col(f"__c{i}"), F.lit(0)).cast("long").alias(n) for i, n in enumerate(names)])


def squared_correlation(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.agg(F.pow(F.corr(y, yhat), 2).alias("r_squared"))


def all_pair_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form, one aggregate pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{a}__{b}").alias("corr"))
            for a, b in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
