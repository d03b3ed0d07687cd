"""Penalised linear models over a whole grid from one pass of cross products.

A linear model needs nothing of the rows but their number, means and cross
products, and these add up.  One scan takes the means, a second the cross
products about them, per fold.  Every fold's training statistics are then the
sum of the other folds', every grid point is solved by coordinate descent on
them, and every metric follows from the left-out fold's statistics.  The work
on rows does not depend on the number of points or folds.

The objective is the one that Spark's linear regression minimises: features
and label scaled by their standard deviations, ``1/(2n)`` of the squared error
plus ``reg * (alpha * L1 + (1 - alpha) / 2 * L2)``.

Rows with a null or NaN in a feature, the label or the fold are left out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package


@dataclass(frozen=True)
class Moments:
    """Number of rows, means and centred cross products of the features and, last, the label."""

    n: int
    mean: np.ndarray
    cross: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        d = other.mean - self.mean
        return Moments(n, self.mean + d * (other.n / n), self.cross + other.cross + np.outer(d, d) * (self.n * other.n / n))


@dataclass(frozen=True)
class Point:
    """One setting of the grid."""

    reg_param: float
    elastic_net_param: float = 0.0
    fit_intercept: bool = True


def grid(reg_params: Iterable[float], elastic_net_params: Iterable[float] = (0.0,),
         fit_intercepts: Iterable[bool] = (True,)) -> list[Point]:
    """All combinations, the last argument changing fastest."""
    return [Point(*x) for x in itertools.product(reg_params, elastic_net_params, fit_intercepts)]


def cross_moments(df: DataFrame, features: Sequence[str], label: str, fold: Column) -> dict[int, Moments]:
    """Moments of every fold, in two scans of ``df``.

    Tasks add up theirs, so a fold brings (features + 2) squared numbers a
    task to the shuffle and as many in all to the driver.
    """
    ship_package(df.sparkSession)
    names = [*features, label]
    value = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]
    rows = df.select(fold.cast("int").alias("fold"), *value).where("fold is not null")
    for i in range(len(names)):
        rows = rows.where(F.col(f"c{i}").isNotNull() & ~F.isnan(f"c{i}"))
    shift = np.array(rows.agg(*[F.avg(f"c{i}") for i in range(len(names))]).first(), dtype=float)
    shift = np.where(np.isfinite(shift), shift, 0.0)
    width = len(names) + 1

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            of = np.asarray(batch.column(0))
            z = np.ones((batch.num_rows, width))
            for i in range(len(names)):
                z[:, i + 1] = np.asarray(batch.column(i + 1)) - shift[i]
            for f in np.unique(of):
                mine = z[of == f]
                sums[int(f)] = sums.get(int(f), 0.0) + mine.T @ mine
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(keys, width * width), pa.int32()), pa.array(np.tile(np.arange(width * width), len(keys)), pa.int32()),
             pa.array(np.concatenate([sums[k].ravel() for k in keys]) if keys else [], pa.float64())], ["fold", "at", "total"])

    total = rows.mapInArrow(add, "fold int, at int, total double").groupBy("fold", "at").agg(F.sum("total").alias("total"))
    matrices: dict[int, np.ndarray] = {}
    for r in total.collect():
        matrices.setdefault(r["fold"], np.zeros(width * width))[r["at"]] = r["total"]
    out = {}
    for f, flat in sorted(matrices.items()):
        m = flat.reshape(width, width)
        n, sums = m[0, 0], m[0, 1:]
        out[f] = Moments(int(n), shift + sums / n, m[1:, 1:] - np.outer(sums, sums) / n)
    return out


def fit(m: Moments, point: Point, tol: float = 1e-13, max_rounds: int = 100_000) -> tuple[float, np.ndarray]:
    """Intercept and coefficients for one setting, by cyclic coordinate descent.

    A feature or a label without spread gets coefficients of zero.
    """
    p = len(m.mean) - 1
    beta = np.zeros(p)
    if m.n < 2:
        return (float(m.mean[-1]) if m.n and point.fit_intercept else 0.0), beta
    sd = np.sqrt(np.maximum(np.diag(m.cross), 0.0) / (m.n - 1))
    if not sd[-1] and point.fit_intercept:
        return float(m.mean[-1]), beta
    second = m.cross if point.fit_intercept else m.cross + m.n * np.outer(m.mean, m.mean)
    label_sd = sd[-1] if sd[-1] else 1.0
    use = np.flatnonzero(sd[:-1] > 0)
    scale = sd[use]
    a = second[np.ix_(use, use)] / m.n / np.outer(scale, scale)
    b = second[use, -1] / m.n / (scale * label_sd)
    l1 = point.reg_param * point.elastic_net_param / label_sd
    l2 = point.reg_param * (1.0 - point.elastic_net_param) / label_sd
    w, gradient = np.zeros(len(use)), b.copy()  # gradient: b - a @ w
    for _ in range(max_rounds):
        largest = 0.0
        for j in range(len(use)):
            free = gradient[j] + a[j, j] * w[j]
            new = np.sign(free) * max(abs(free) - l1, 0.0) / (a[j, j] + l2)
            step = new - w[j]
            if step:
                gradient -= a[:, j] * step
                w[j] = new
                largest = max(largest, abs(step))
        if largest < tol:
            break
    beta[use] = w * label_sd / scale
    intercept = float(m.mean[-1] - m.mean[:-1] @ beta) if point.fit_intercept else 0.0
    return intercept, beta


def metrics(m: Moments, intercept: float, beta: np.ndarray) -> dict[str, float]:
    """rmse and r2 (1 - SSE/SST) of a model on the rows that ``m`` describes; NaN where undefined."""
    if not m.n:
        return {"rmse": float("nan"), "r2": float("nan")}
    off = m.mean[-1] - intercept - m.mean[:-1] @ beta
    sse = m.cross[-1, -1] - 2 * beta @ m.cross[:-1, -1] + beta @ m.cross[:-1, :-1] @ beta + m.n * off * off
    sst = m.cross[-1, -1]
    return {"rmse": float(np.sqrt(max(sse, 0.0) / m.n)), "r2": float(1 - sse / sst) if sst > 0 else float("nan")}


#: Metrics that are better when larger; the others when smaller.
LARGER = {"r2"}

TABLE = ("position int, reg_param double, elastic_net_param double, fit_intercept boolean, rmse double, r2 double, "
         "is_best boolean, intercept double, coefficients array<double>")


def tune(df: DataFrame, features: Sequence[str], label: str, points: Sequence[Point], fold: Column, validate: Sequence[int],
         metric: str = "rmse", digits: int = 9) -> DataFrame:
    """One row a grid point: its metrics, averaged over the folds ``validate``,
    each predicted by the model of all others, and its model of all rows.

    ``is_best`` marks the best ``metric``; metrics that agree to ``digits``
    significant digits are equal, and the first point wins.  With ``fold`` 0
    and 1 and ``validate`` (1,) this is a holdout, with 0 to k-1 and all of
    them k-fold validation.
    """
    moments = cross_moments(df, features, label, fold)
    if not moments:
        return df.sparkSession.createDataFrame([], TABLE)
    nothing = Moments(0, np.zeros(len(features) + 1), np.zeros((len(features) + 1,) * 2))
    every = sum(moments.values(), nothing)
    rows = []
    for i, point in enumerate(points):
        parts = []
        for f in validate:
            rest = sum((m for k, m in moments.items() if k != f), nothing)
            parts.append(metrics(moments.get(f, nothing), *fit(rest, point)))
        intercept, beta = fit(every, point)
        rows.append((i, point.reg_param, point.elastic_net_param, point.fit_intercept,
                     *(float(np.mean([x[name] for x in parts])) for name in ("rmse", "r2")), intercept, beta.tolist()))
    sign = -1.0 if metric in LARGER else 1.0
    at = {"rmse": 4, "r2": 5}[metric]
    known = [r for r in rows if np.isfinite(r[at])]
    best = min(known, key=lambda r: (float(f"{sign * r[at]:.{digits - 1}e}"), r[0]))[0] if known else None
    return df.sparkSession.createDataFrame([(*r[:6], r[0] == best, *r[6:]) for r in rows], TABLE)
