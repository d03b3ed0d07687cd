"""Centroid clustering (Lloyd rounds on integers) with norm-of-sum bounds.

Every vector carries an upper bound on the distance to its centroid and, for
each group of ``GROUP`` centroids, a lower bound on the distance to all others
of the group, each with the round it was evaluated in.  All centroids of all
rounds are kept.  A bound is loosened by the norm of the centroid's total
displacement since that round (a group's by the largest of its centroids), not
by the sum of the rounds' drifts, which the triangle inequality makes larger.
A vector whose upper bound stays below all lower bounds keeps its centroid
unseen.  For the others the own distance is evaluated first, then only the
groups whose bound still fails, all exactly in integers, ties to the smaller
number.

Bounds are compared with a slack that exceeds their rounding errors, so
assignments are those of a full search.  A round reads the stored vectors with
their state, writes them with the new state, and adds up every cluster's
components, per task first; the driver gets one sum a cluster and component.
The state of the round before is deleted then.

Defined results: a vector of another length, or with a null, NaN or infinite
component is not clustered and not returned; rows that repeat are clustered
each; a null vec_id hashes as an empty string and comes after others of equal
hash, then the vector decides; with fewer vectors than ``k`` each is a
centroid; components beyond +-2**27 are taken as that, so that squared
distances stay in a long, and an inertia that a long cannot hold is null; an empty table gives an empty result; only the id
and the vector are read, so other columns of any name do no harm.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

DIMENSION = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
GROUP = 10
MOST = 1 << 27

STATE = ("vec_id long, v array<int>, cluster int, upper double, upper_round int, "
         "lower array<double>, lower_round array<int>")


def whole_components(vector: Column, dimension: int, scale: int) -> Column:
    """floor(scale * x) of every component, or null for a vector that is not clustered."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))),
                                                             F.lit(float(-MOST)))).cast("int"))
    return F.when((F.size(vector) == dimension) & finite, whole)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``."""
    big = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if x.shape[1] * int(big) ** 2 < 1 << 50:  # every sum is a whole number that a double holds
        y, z = x.astype(np.float64), c.astype(np.float64)
        d = (y * y).sum(1)[:, None] - 2 * (y @ z.T) + (z * z).sum(1)[None, :]
        return d.astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1) if len(c) else np.zeros((len(x), 0), np.int64)


def own_squared(x: np.ndarray, c: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    return ((x - c[cluster]) ** 2).sum(1)


def below(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """``upper < lower`` beyond doubt."""
    return upper + 1e-6 + 1e-9 * upper < lower


def groups_of(k: int) -> list[np.ndarray]:
    return [np.arange(a, min(a + GROUP, k)) for a in range(0, k, GROUP)]


def first_state(x: np.ndarray, c: np.ndarray):
    """cluster, upper, upper_round, lower, lower_round by a full search in round 0."""
    n, groups = len(x), groups_of(len(c))
    d = squared(x, c)
    cluster = d.argmin(1)
    upper = np.sqrt(d[np.arange(n), cluster].astype(np.float64))
    other = d.astype(np.float64)
    other[np.arange(n), cluster] = np.inf
    lower = np.sqrt(np.stack([other[:, g].min(1) for g in groups], 1)) if n else np.zeros((0, len(groups)))
    return cluster, upper, np.zeros(n, np.int64), lower, np.zeros((n, len(groups)), np.int64)


def next_state(x: np.ndarray, state, history: np.ndarray):
    """The state for the last centroids of ``history``, and how many distances were evaluated."""
    cluster, upper, upper_round, lower, lower_round = (a.copy() for a in state)
    now = len(history) - 1
    c, groups = history[now], groups_of(history.shape[1])
    moved = np.sqrt(((history - c) ** 2).sum(2).astype(np.float64))  # by round and centroid, up to now
    moved_group = np.stack([moved[:, g].max(1) for g in groups], 1)
    loose_lower = lower - moved_group[lower_round, np.arange(len(groups))]
    loose_upper = upper + moved[upper_round, cluster]
    at = np.flatnonzero(~below(loose_upper[:, None], loose_lower).all(1))
    evaluated = len(at)
    if not len(at):
        return (cluster, upper, upper_round, lower, lower_round), evaluated
    old = cluster[at]
    best = own_squared(x[at], c, old)
    own = np.sqrt(best.astype(np.float64))
    upper[at], upper_round[at] = own, now
    fails = ~below(own[:, None], loose_lower[at])
    new, rescanned = old.copy(), []
    for g, members in enumerate(groups):
        rows = np.flatnonzero(fails[:, g])
        if not len(rows):
            continue
        d = squared(x[at[rows]], c[members])
        evaluated += d.size
        rescanned.append((g, rows, d))
        near = d.argmin(1)
        value, number = d[np.arange(len(rows)), near], members[near]
        better = (value < best[rows]) | ((value == best[rows]) & (number < new[rows]))
        best[rows] = np.where(better, value, best[rows])
        new[rows] = np.where(better, number, new[rows])
    cluster[at] = new
    upper[at] = np.sqrt(best.astype(np.float64))
    # the centroid left counts as another one of its group from now on
    left = np.flatnonzero(new != old)
    of_old = old[left] // GROUP
    lower[at[left], of_old] = np.minimum(loose_lower[at[left], of_old], own[left])
    lower_round[at[left], of_old] = now
    for g, rows, d in rescanned:
        other = d.astype(np.float64)
        mine = np.flatnonzero(new[rows] // GROUP == g)
        other[mine, new[rows[mine]] - groups[g][0]] = np.inf
        lower[at[rows], g] = np.sqrt(other.min(1))
        lower_round[at[rows], g] = now
    return (cluster, upper, upper_round, lower, lower_round), evaluated


def matrix(column: pa.ListArray, rows: int, kind) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind).reshape(rows, -1) if rows else np.zeros((0, 1), kind)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel(), kind))


def state_of(batch: pa.RecordBatch):
    n = batch.num_rows
    return (np.asarray(batch.column(2)).astype(np.int64), np.asarray(batch.column(3)),
            np.asarray(batch.column(4)).astype(np.int64), matrix(batch.column(5), n, np.float64),
            matrix(batch.column(6), n, np.int64))


def assigned(rows: DataFrame, history: np.ndarray) -> DataFrame:
    """``rows`` with the state for the last centroids of ``history``; without a state in round 0."""
    def run(batch):
        n = batch.num_rows
        x = matrix(batch.column(1), n, np.int64)
        state = (first_state(x, history[0]) if len(history) == 1 else next_state(x, state_of(batch), history)[0])
        cluster, upper, upper_round, lower, lower_round = state
        return {"vec_id": batch.column(0), "v": batch.column(1), "cluster": pa.array(cluster, pa.int32()),
                "upper": upper, "upper_round": pa.array(upper_round, pa.int32()),
                "lower": lists(lower, pa.float64()), "lower_round": lists(lower_round, pa.int32())}

    return C.map_arrow(rows, run, STATE)


def moved_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of every cluster's vectors; a cluster without one stays."""
    k, dim = centroids.shape

    def add(batches):
        sums, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster = np.asarray(batch.column(0)).astype(np.int64)
            x = matrix(batch.column(1), batch.num_rows, np.int64)
            for c in np.unique(cluster):
                mine = cluster == c
                sums[c] += x[mine].sum(0)
                n[c] += np.count_nonzero(mine)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, dim)), pa.array(np.tile(np.arange(dim), len(at))), pa.array(sums[at].ravel()),
             pa.array(np.repeat(n[at], dim))], ["cluster", "component", "total", "n"])

    wide = T.DecimalType(38, 0)
    parts = rows.select("cluster", "v").mapInArrow(add, "cluster long, component long, total long, n long")
    out = centroids.copy()
    for r in (parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast(wide)).alias("total"), F.sum("n").alias("n"))
              .collect()):  # k times the dimension rows
        out[r.cluster, r.component] = int(r.total) // r.n
    return out


def seeds(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(key.alias("h"), "vec_id", "v").orderBy("h", F.asc_nulls_last("vec_id"), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64) if rows else np.zeros((0, 1), np.int64)


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimension: int = DIMENSION, seed: int = SEED,
            scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every clustered vector.

    ``vectors`` has columns vec_id and embedding.
    """
    spark = vectors.sparkSession
    C.prepare(spark)
    rows = C.stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                                   whole_components(F.col("embedding"), dimension, scale).alias("v")).where("v is not null"))
    history = seeds(rows, k, seed)[None]
    if not history.shape[1]:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    for _ in range(rounds):
        before, rows = rows, C.stored(assigned(rows, history))
        C.discard(before)
        history = np.concatenate((history, moved_centroids(rows, history[-1])[None]))
    last = history[-1]

    def measure(batch):
        mine = np.asarray(batch.column(2)).astype(np.int64)
        return {"vec_id": batch.column(0), "cluster": batch.column(2),
                "distance": own_squared(matrix(batch.column(1), batch.num_rows, np.int64), last, mine)}

    found = C.stored(C.map_arrow(assigned(rows, history), measure, "vec_id long, cluster int, distance long"))
    C.discard(rows)
    # one row a cluster
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    total = None if None in inertia.values() else sum(inertia.values())
    total = total if total is None or total < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in last.tolist()]
    of_cluster = spark.createDataFrame([(c, s, total, digest[c]) for c, s in inertia.items()],
                                       "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia",
                                                                 "inertia", "centroid_sha256")


def op13_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """Cluster, squared distance, inertia and centroid digest of every vector of ``embeddings``."""
    return cluster(C.read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
