"""The numbers behind exploratory charts, computed over all rows on Spark.

Drawing is left to the caller; every function returns a small DataFrame
whose size is bounded by its parameters (bins, grid points, categories),
not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles
from .sampling import hash_sample

SQRT_2PI = 2.5066282746310002


def ordered_counts(df: DataFrame, key: str, order: Sequence, hue: str | None = None,
                   hue_order: Sequence | None = None, missing: str = "missing") -> DataFrame:
    """Bar counts per category with its position in a given order (0 = not listed).

    Null string categories become ``missing``.
    """
    def label(c):
        col = F.col(c)
        return F.coalesce(col, F.lit(missing)) if dict(df.dtypes)[c] == "string" else col

    keys = [label(key).alias(key)] + ([label(hue).alias(hue)] if hue else [])
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    out = out.withColumn("position", F.array_position(F.array(*[F.lit(v) for v in order]), F.col(key)))
    if hue:
        out = out.withColumn("hue_position",
                             F.array_position(F.array(*[F.lit(v) for v in hue_order or []]), F.col(hue)))
    return out


def _finite(col: str) -> Column:
    """The number, or null where it is null, NaN or infinite."""
    x = F.col(col).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def _ranges(df: DataFrame, *cols: str) -> dict[str, tuple]:
    """(min, max, count, sample stddev) of several columns' finite values in one pass."""
    aggs = []
    for c in cols:
        x = _finite(c)
        aggs += [F.min(x).alias(f"{c}__lo"), F.max(x).alias(f"{c}__hi"), F.count(x).alias(f"{c}__n"),
                 F.stddev_samp(x).alias(f"{c}__s")]
    r = df.agg(*aggs).first()
    return {c: (r[f"{c}__lo"], r[f"{c}__hi"], r[f"{c}__n"], r[f"{c}__s"]) for c in cols}


def bucket_of(col: str | Column, lo: float, hi: float, bins: int) -> Column:
    """1-based equal-width bucket; the maximum goes to the last bucket."""
    c = F.col(col) if isinstance(col, str) else col
    width = hi - lo
    if width == 0:
        return F.when(c.isNotNull(), F.lit(1).cast("long"))
    raw = F.floor((c.cast("double") - F.lit(lo)) / F.lit(width) * F.lit(bins)).cast("long") + 1
    return F.when(c.isNotNull(), F.least(raw, F.lit(bins).cast("long")))  # least() skips nulls


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram: (bucket, lower, upper, count); empty buckets omitted.

    One pass for the range, one grouped count.  NaN and infinite values are
    bucket 0, without bounds; a column with no finite value has that one only."""
    lo, hi, _, _ = _ranges(df, col)[col]
    return _histogram_in_range(df, col, bins, lo, hi)


def _histogram_in_range(df: DataFrame, col: str, bins: int, lo, hi) -> DataFrame:
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins
    bucket = F.coalesce(bucket_of(_finite(col), lo, hi, bins), F.lit(0).cast("long"))
    bounded = F.col("bucket") > 0
    return (df.where(F.col(col).isNotNull())
            .groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
            .select("bucket",
                    F.when(bounded, F.lit(lo) + (F.col("bucket") - 1) * F.lit(width)).alias("lower"),
                    F.when(bounded, F.lit(lo) + F.col("bucket") * F.lit(width)).alias("upper"),
                    "count"))


def density_curve(df: DataFrame, col: str, bins: int = 50, grid: int = 100) -> DataFrame:
    """Gaussian kernel density on a grid, estimated from the binned counts.

    Bandwidth 1.06·σ·n^(-1/5) (normal reference rule).  Each histogram bin
    contributes ``count · φ((g - centre)/h)`` to grid point ``g``; the work is
    bins × grid rows whatever the data size.
    """
    lo, hi, n, sd = _ranges(df, col)[col]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "point long, x double, density double")
    h = 1.06 * sd * n ** (-0.2)
    hist = _histogram_in_range(df, col, bins, lo, hi).where("bucket > 0")
    step = (hi - lo) / (grid - 1)
    return (hist.select(((F.col("lower") + F.col("upper")) / 2).alias("centre"), "count",
                        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
            .withColumn("x", F.lit(lo) + F.col("point") * F.lit(step))
            .groupBy("point", "x")
            .agg((F.sum(F.col("count") * F.exp(F.lit(-0.5) * F.pow((F.col("x") - F.col("centre")) / F.lit(h), 2)))
                  / F.lit(n * h * SQRT_2PI)).alias("density")))


def box_stats(df: DataFrame, col: str) -> DataFrame:
    """Exact quartiles, 1.5·IQR fences, whisker ends and outlier count."""
    q = {r["p"]: r["value"] for r in exact_quantiles(df, col, [0.25, 0.5, 0.75]).collect()}
    q1, med, q3 = q.get(0.25), q.get(0.5), q.get(0.75)
    if q1 is None:
        return df.sparkSession.createDataFrame(
            [], "q1 double, median double, q3 double, lower_fence double, upper_fence double, "
                "lower_whisker double, upper_whisker double, n_outliers long")
    iqr = float(q3) - float(q1)
    lo_f, hi_f = float(q1) - 1.5 * iqr, float(q3) + 1.5 * iqr
    x = F.col(col).cast("double")
    inside = (x >= F.lit(lo_f)) & (x <= F.lit(hi_f))
    return df.agg(
        F.lit(float(q1)).alias("q1"), F.lit(float(med)).alias("median"), F.lit(float(q3)).alias("q3"),
        F.lit(lo_f).alias("lower_fence"), F.lit(hi_f).alias("upper_fence"),
        F.min(F.when(inside, x)).alias("lower_whisker"), F.max(F.when(inside, x)).alias("upper_whisker"),
        F.count(F.when(~inside, x)).alias("n_outliers"))


def sample_points(df: DataFrame, cols: Sequence[str], keys: Sequence[str], fraction: float) -> DataFrame:
    """Rows for scatter / strip / rug plots: complete cases, reproducible hash sample."""
    return hash_sample(df.select(*keys, *cols).dropna(subset=list(cols)), keys, fraction)


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def quadratic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares fit of y on [x, x²] (normal equations: one pass over the data)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    data = (df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
            .withColumn("x2", F.col("x") * F.col("x")))
    vec = VectorAssembler(inputCols=["x", "x2"], outputCol="features").transform(data)
    model = LinearRegression(featuresCol="features", labelCol="y", solver="normal").fit(vec)
    c = model.coefficients
    return df.sparkSession.createDataFrame(
        [(float(model.intercept), float(c[0]), float(c[1]), float(model.summary.r2))],
        "intercept double, b1 double, b2 double, r2 double")


def binned_2d(df: DataFrame, x: str, y: str, bins_x: int = 20, bins_y: int = 20) -> DataFrame:
    """Counts on a bins_x × bins_y grid of equal-width cells over the pairs of
    finite numbers (empty cells omitted); one range pass, one grouped count."""
    clean = df.where(_finite(x).isNotNull() & _finite(y).isNotNull())
    rng = _ranges(clean, x, y)
    (lx, hx, _, _), (ly, hy, _, _) = rng[x], rng[y]
    if lx is None:
        return df.sparkSession.createDataFrame([], "bx long, `by` long, count long")
    return clean.groupBy(bucket_of(x, lx, hx, bins_x).alias("bx"),
                         bucket_of(y, ly, hy, bins_y).alias("by")).agg(F.count(F.lit(1)).alias("count"))


def pair_grid_counts(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """2-D binned counts for every pair of columns, in one scan.

    One pass finds each column's range over the rows of finite numbers; then every
    row emits one (pair, bucket x, bucket y) entry per column pair (a fixed
    number, k(k-1)/2) and a single grouped count with map-side combine
    produces all grids.  Output: x, y (column names), bx, by, count.
    """
    clean = df.select(*cols)
    for c in cols:
        clean = clean.where(_finite(c).isNotNull())
    rng = _ranges(clean, *cols)
    if rng[cols[0]][0] is None:
        return df.sparkSession.createDataFrame([], "x string, y string, bx long, `by` long, count long")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    cells = F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"),
                 bucket_of(a, rng[a][0], rng[a][1], bins).alias("bx"),
                 bucket_of(b, rng[b][0], rng[b][1], bins).alias("by"))
        for a, b in pairs])
    return (clean.select(F.explode(cells).alias("cell")).select("cell.*")
            .groupBy("x", "y", "bx", "by").agg(F.count(F.lit(1)).alias("count")))
