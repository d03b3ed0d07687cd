"""Exact (discrete) quantiles, computed distributed.

The value at rank ``ceil(p * n)`` (1-based, at least 1) of the non-null
values, the definition of ``percentile_disc`` and of ``approxQuantile`` with
relative error 0.  Spark's exact forms keep every value of a group in one
task; this operator instead:

1. (numeric columns) one KLL sketch a task gives the values near ``p ± 2ε``,
   between which the exact answer almost surely lies: a bracket.  The
   sketches are merged in three levels (``SKETCH_GROUPS`` groups of tasks,
   then one), so no task merges more than a small share of them;
2. one more scan counts, per distinct value, only the values inside a
   bracket (about 4εn rows per probability; map-side combined, so a hot
   value becomes one row); all other rows collapse into at most k+1 groups
   by the number of lower bounds they reach.  The result is
   range-partitioned, sorted within partitions and checkpointed to the
   shared checkpoint folder (reliable, so the layout the offsets refer to
   is fixed and survives executor loss);
3. the rows below each bracket are summed from that small table;
4. one row per partition (in-bracket totals) goes to the driver to place
   each partition on each bracket's rank axis;
5. each partition walks its cumulative counts and emits the value of every
   target rank that falls inside it.

Every bracket is verified (rows below < target rank ≤ rows below + rows
inside); a bracket that fails, or a non-numeric column, falls back to the
unbracketed form (all distinct values), so the result is always exact.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Rank error of the sketches; about 0.2 MB a sketch.
DEFAULT_BRACKET_ERROR = 4e-4
SKETCH_GROUPS = (4096, 64)


def target_ranks(probabilities: Sequence[float], n: int) -> list[int]:
    return [min(n, max(1, math.ceil(p * n))) for p in probabilities]


def _inside(v: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (v >= F.lit(lo))
    if hi is not None:
        cond = cond & (v <= F.lit(hi))
    return cond


def _as_type(bound: float, value_type: T.DataType, up: bool):
    """A bound in the column's own type, rounded outwards, so that Spark and pandas compare alike.

    Values that a double cannot hold were rounded for the sketch: one more step outwards.
    """
    if isinstance(value_type, T.DecimalType) or abs(bound) >= 2**53:
        bound = math.nextafter(bound, math.inf if up else -math.inf)
    if isinstance(value_type, T.IntegralType):
        whole = math.ceil(bound) if up else math.floor(bound)
        return max(-2**63, min(2**63 - 1, whole))
    if isinstance(value_type, T.DecimalType):
        with decimal.localcontext(prec=80):
            return decimal.Decimal(bound).quantize(decimal.Decimal(1).scaleb(-value_type.scale),
                                                   decimal.ROUND_CEILING if up else decimal.ROUND_FLOOR)
    return bound


def sketch_quantiles(vals: DataFrame, column: str, probabilities: Sequence[float], error: float) -> list[float] | None:
    """Values at about these ranks, from KLL sketches merged level by level; None without a value.

    Nulls and NaN are left out.  The sketch size follows from the wanted rank error.
    """
    k = min(65535, max(8, math.ceil((2.296 / error) ** (1 / 0.9723))))
    first, *further = SKETCH_GROUPS
    merged = (vals.select(F.col(column).cast("double").alias("v"), (F.spark_partition_id() % first).alias("g"))
              .groupBy("g").agg(F.kll_sketch_agg_double("v", k).alias("s")))
    for groups in further:
        merged = merged.groupBy((F.col("g") % groups).alias("g")).agg(F.kll_merge_agg_double("s", k).alias("s"))
    merged = merged.agg(F.kll_merge_agg_double("s", k).alias("s"))
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    return merged.select(F.when(F.kll_sketch_get_n_double("s") > 0, F.kll_sketch_get_quantile_double("s", ranks))
                         .alias("q")).first()["q"]


def _brackets(vals: DataFrame, probs: list[float], eps: float, value_type: T.DataType) -> list[tuple]:
    """[(lo, hi)] by probability, None meaning unbounded."""
    if not isinstance(value_type, T.NumericType) or eps <= 0:
        return [(None, None)] * len(probs)
    qs = sorted({min(1.0, max(0.0, p + s * 2 * eps)) for p in probs for s in (-1, 1)})
    approx = dict(zip(qs, sketch_quantiles(vals, "v", qs, eps) or []))
    out = []
    for p in probs:
        lo = None if p - 2 * eps <= 0 else approx.get(max(0.0, p - 2 * eps))
        hi = None if p + 2 * eps >= 1 else approx.get(min(1.0, p + 2 * eps))
        out.append((None if lo is None else _as_type(lo, value_type, False),
                    None if hi is None else _as_type(hi, value_type, True)))
    return out


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float],
                    num_partitions: int | None = None,
                    bracket_error: float = DEFAULT_BRACKET_ERROR) -> DataFrame:
    """DataFrame ``(p double, value <type of column>)``, one row per probability."""
    return _exact_quantiles(df, column, probabilities, num_partitions, bracket_error, unbracketed=False)


def _exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float],
                     num_partitions: int | None, bracket_error: float, unbracketed: bool) -> DataFrame:
    spark = df.sparkSession
    value_type = df.schema[column].dataType
    out_schema = T.StructType([T.StructField("p", T.DoubleType()),
                               T.StructField("value", value_type)])
    probs = [float(p) for p in probabilities]
    vals = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    brackets = [(None, None)] * len(probs) if unbracketed else _brackets(vals, probs, bracket_error, value_type)
    v = F.col("v")
    k = len(probs)
    inside = [_inside(v, lo, hi) for lo, hi in brackets]
    is_candidate = reduce(lambda a, b: a | b, inside, F.lit(False))

    # One scan: candidate values keep their own group; every other row is
    # grouped under a null value and the number of lower bounds it reaches
    # (bounds in ascending order, so that number tells which it lies below).
    # Rows below each bracket are summed from both kinds afterwards.
    lows = sorted(((i, lo) for i, (lo, _) in enumerate(brackets) if lo is not None), key=lambda x: x[1])
    reached = reduce(lambda a, b: a + b, [(v >= F.lit(lo)).cast("int") for _, lo in lows], F.lit(0))
    keyed = vals.select(F.when(is_candidate, v).alias("kv"),
                        F.when(is_candidate, F.lit(0)).otherwise(reached).alias("reached"))
    counts = keyed.groupBy("kv", "reached").agg(F.count(F.lit(1)).alias("c")).withColumnRenamed("kv", "v")
    ensure_checkpoint_dir(spark)
    # Without an explicit count adaptive execution may merge adjacent ranges;
    # the checkpoint fixes whatever layout ran, and pids below refer to it.
    ranged = counts.repartitionByRange(num_partitions, "v") if num_partitions \
        else counts.repartitionByRange("v")
    ranged = (ranged.sortWithinPartitions("v")
              .withColumn("pid", F.spark_partition_id()).checkpoint(eager=True))
    present = v.isNotNull()
    c = F.col("c")
    per_pid = ranged.groupBy("pid").agg(
        F.sum("c").alias("n"),
        *[F.sum(F.when(present & inside[i], c).otherwise(0)).alias(f"t{i}") for i in range(k)],
        *[F.sum(F.when((~present & (F.col("reached") <= at)) | (present & (v < F.lit(lo))), c).otherwise(0))
          .alias(f"b{i}") for at, (i, lo) in enumerate(lows)]
    ).collect()
    n = sum(row["n"] for row in per_pid)
    if n == 0:
        return spark.createDataFrame([(p, None) for p in probs], out_schema)
    ranks = target_ranks(probs, n)
    totals = {row["pid"]: [row[f"t{i}"] for i in range(k)] for row in per_pid}
    below = [0] * k
    for i, _ in lows:
        below[i] = sum(row[f"b{i}"] or 0 for row in per_pid)

    # verify every bracket; failures fall back to the unbracketed form
    failed = [i for i in range(k)
              if not (below[i] < ranks[i] <= below[i] + sum(t[i] or 0 for t in totals.values()))]
    keep = [i for i in range(k) if i not in failed]
    offsets: dict[int, list[int]] = {}
    running = list(below)
    for pid in sorted(totals):
        offsets[pid] = list(running)
        running = [running[i] + (totals[pid][i] or 0) for i in range(k)]
    wanted = [(i, probs[i], ranks[i], brackets[i][0], brackets[i][1]) for i in keep]

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = None
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["pid"].iloc[0])
            if seen is None:
                seen = list(offsets.get(pid, below))
            values, counts_ = pdf["v"], pdf["c"].to_numpy()
            rows = []
            for i, p, r, lo, hi in wanted:
                mask = np.ones(len(pdf), dtype=bool)
                if lo is not None:
                    mask &= ((values >= lo) | values.isna()).to_numpy()  # NaN is above all, as in Spark
                if hi is not None:
                    mask &= (values <= hi).to_numpy()
                cum = seen[i] + np.cumsum(np.where(mask, counts_, 0))
                if seen[i] < r <= cum[-1]:
                    rows.append((p, values.iloc[int(np.searchsorted(cum, r, side="left"))]))
                seen[i] = int(cum[-1])
            if rows:
                yield pd.DataFrame(rows, columns=["p", "value"])

    # the grouped rows outside every bracket are dropped by a narrow filter,
    # which keeps each partition's order (and keeps integer columns integral)
    result = ranged.where(F.col("v").isNotNull()).mapInPandas(pick, schema=out_schema)
    if isinstance(value_type, (T.DoubleType, T.FloatType)):  # pandas hands NaN back as null
        result = result.withColumn("value", F.coalesce("value", F.lit(math.nan).cast(value_type)))
    if failed:
        if unbracketed:
            raise RuntimeError("exact quantile ranks inconsistent with the counted values")
        rest = _exact_quantiles(df, column, [probs[i] for i in failed], num_partitions, 0.0, unbracketed=True)
        result = result.unionByName(rest)
    return result


def quantile_row(quantiles: DataFrame, names: dict[float, str]) -> DataFrame:
    """Turn ``(p, value)`` rows into one row with a named column per probability."""
    return quantiles.agg(*[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(n)
                           for p, n in names.items()])
