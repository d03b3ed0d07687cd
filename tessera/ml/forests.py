"""Random forests grown from counted rows.

A tree sees a row only through the bin that each of its features falls into
(``maxBins`` a feature) and its label.  MLlib passes over all rows, once for each
tree, for every level and every group of nodes that fits into memory.  Here
rows that agree in all bins are counted by label, once, and each task grows whole
trees from the counts; what a row's bootstrap weight is to MLlib, the sum over the
counted rows is here (a Poisson draw with the sum of their rates).
"""

from __future__ import annotations

import json
import math
import threading
import time
import uuid
import weakref

import numpy as np
import pyarrow as pa
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lifetimes import _path
from ..session import scratch_path

#: rows × trees × levels up to which MLlib is done before rows are counted
FEW_VISITS = 100_000
#: distinct rows (or sampled ones) × features or classes that a task may hold; beyond that MLlib fits
MOST_CELLS = 4_000_000
#: cells of the count tables that are open at once while a level is split
CELLS_AT_ONCE = 500_000
#: classes that MLlib infers from labels at most; its error is raised beyond that
MOST_CLASSES = 100
#: nodes of the models of one grid that the driver holds at once (about 200 bytes each), if one model alone has no more
MOST_NODES = 1_000_000
#: seconds after which a model is loaded all the same, as those before it may be held for good
LONGEST_WAIT = 600
EPSILON = 2.0 ** -52

NODE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
        "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
        "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


# ---- bins and counts -------------------------------------------------------

def thresholds_of(values: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's split points of a continuous feature: midpoints of all distinct values, or of the
    ``bins`` - 1 places that come closest to equal shares of the rows."""
    distinct, counts = np.unique(values + 0.0, return_counts=True)
    between = (distinct[:-1] + distinct[1:]) / 2.0
    if len(between) <= bins - 1:
        return between
    stride = len(values) / bins
    cuts, target, upto = [], stride, np.cumsum(counts)
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            cuts.append(between[i - 1])
            target += stride
    return np.array(cuts)


class CountedRows:
    """The distinct rows of bins (feature by row) and how many rows of each label (row by class) each stands for."""

    def __init__(self, bins: np.ndarray, counts: np.ndarray, thresholds: list, binary: list):
        self.bins, self.counts, self.thresholds, self.binary = bins, counts, thresholds, binary


def _counting(thresholds: list, binary: list, classes: int):
    """Arrow batches of (features, label) to (key, rows), one row a key and batch."""
    def keys(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(0)
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(thresholds))
            if vectors.null_count or not np.isfinite(x).all():
                raise ValueError("features must not be null, NaN or infinite")
            key = np.zeros(len(x), dtype=np.int64)
            for i, cuts in enumerate(thresholds):
                if binary[i] and not np.isin(x[:, i], (0.0, 1.0)).all():
                    raise ValueError(f"feature {i} is binary, but has other values than 0 and 1")
                key = key * (len(cuts) + 1) + np.searchsorted(cuts, x[:, i], side="left")
            key = key * classes + batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            found, rows = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(rows.astype(np.int64))], names=["key", "n"])
    return keys


def counted_rows(dataset: DataFrame, features_col: str, label_col: str, max_bins: int, seed: int,
                 rows: int, classes: int) -> CountedRows | None:
    """None if a key does not fit into 62 bits, or more keys come out than a task may hold.

    Split points come from a sample of max(``max_bins``², 10,000) rows, as MLlib's do; all rows are counted.
    """
    attrs = dataset.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    data = dataset.select(vector_to_array(features_col).alias("f"), F.col(label_col).cast("double").alias("y"))
    width = len(data.first().f)
    wanted = max(max_bins * max_bins, 10_000)
    if "nominal" in attrs or classes > MOST_CLASSES or width * min(wanted, rows) > MOST_CELLS:
        return None
    flags = {a["idx"] for a in attrs.get("binary", [])}
    binary = [i in flags for i in range(width)]
    sample = data.select("f") if rows <= wanted else data.select("f").sample(False, wanted / rows, seed)
    values = np.array([r.f for r in sample.collect()], dtype=float).reshape(-1, width)
    thresholds = [np.array([0.5]) if binary[i] else thresholds_of(values[:, i], min(max_bins, rows))
                  for i in range(width)]
    sizes = [len(t) + 1 for t in thresholds]
    if math.prod(sizes) * classes >= 2 ** 62:
        return None
    most = MOST_CELLS // width
    table = data.mapInArrow(_counting(thresholds, binary, classes), "key bigint, n bigint") \
        .groupBy("key").agg(F.sum("n").alias("n")).limit(most + 1).toArrow()
    if table.num_rows > most:
        return None
    key, label = np.divmod(table.column("key").to_numpy(), classes)
    key, place = np.unique(key, return_inverse=True)
    if len(key) * classes > MOST_CELLS:
        return None
    counts = np.zeros((len(key), classes), dtype=np.int64)
    counts[place, label] = table.column("n").to_numpy()
    bins = np.empty((width, len(key)), dtype=np.int32)
    for i in reversed(range(width)):
        key, bins[i] = np.divmod(key, sizes[i])
    return CountedRows(bins, counts, thresholds, binary)


# ---- trees -----------------------------------------------------------------

def _impurity(counts: np.ndarray, totals: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy of counts by class (the last axis), class by class as MLlib adds them up."""
    out = np.ones(totals.shape) if kind == "gini" else np.zeros(totals.shape)
    safe = np.where(totals > 0, totals, 1.0)
    for k in range(counts.shape[-1]):
        share = counts[..., k] / safe
        if kind == "gini":
            out -= share * share
        else:
            out -= share * (np.log(np.where(share > 0, share, 1.0)) / math.log(2))
    return np.where(totals > 0, out, 0.0)


class Tree:
    """Nodes level by level, so that children come after their parents; -1: no child."""

    def __init__(self, stats, gain, feature, cut, left, right, starts):
        self.stats, self.gain, self.feature, self.cut = stats, gain, feature, cut
        self.left, self.right, self.starts = left, right, starts


def grow(rows: CountedRows, weights: np.ndarray, rng, max_depth: int, subset: int, impurity: str = "gini",
         min_instances: int = 1, min_weight: float = 0.0, min_gain: float = 0.0) -> Tree:
    """One classification tree over counted rows with ``weights``, by MLlib's rules.

    Every node draws ``subset`` of the features and takes the bin border of the highest gain, the first of equal
    ones.  A node stays a leaf at ``max_depth``, when it is pure, or when no border has a gain over 0 and keeps to
    the minima.  Siblings that are leaves with the same prediction become one leaf.
    """
    here = np.flatnonzero(weights.any(1))
    weight = weights[here].astype(float)
    at = np.zeros(len(here), dtype=np.int64)
    stats = weight.sum(0, keepdims=True)
    all_stats, levels, starts = [stats], [], [0]
    ids, total_nodes = np.arange(1), 1
    ids = ids[_impurity(stats, stats.sum(1), impurity) >= EPSILON]
    for depth in range(max_depth):
        if not len(ids):
            break
        stats = all_stats[-1][ids - starts[-1]]
        gain, feature, cut, left = _best_borders(rows, here, weight, at, stats, rng, subset, impurity,
                                                 min_instances, min_weight, min_gain)
        split = gain > 0
        levels.append((ids[split], gain[split], feature[split], cut[split]))
        if not split.any():
            break
        child = np.empty((2 * int(split.sum()), stats.shape[1]))
        child[0::2] = left[split]
        child[1::2] = stats[split] - left[split]
        starts.append(total_nodes)
        total_nodes += len(child)
        all_stats.append(child)
        open_child = _impurity(child, child.sum(1), impurity) >= EPSILON
        place = np.cumsum(split) - 1
        keep = split[at]
        here, weight, at = here[keep], weight[keep], at[keep]
        side = np.empty(len(here), dtype=np.int64)
        for f in np.unique(feature[split]):
            mine = feature[at] == f
            side[mine] = rows.bins[f][here[mine]] > cut[at[mine]]
        to = 2 * place[at] + side
        keep = open_child[to]
        here, weight = here[keep], weight[keep]
        at = (np.cumsum(open_child) - 1)[to[keep]]
        ids = starts[-1] + np.flatnonzero(open_child)
    return _pruned(np.concatenate(all_stats), levels, starts)


def _best_borders(rows, here, weight, at, stats, rng, subset, impurity, min_instances, min_weight, min_gain):
    """(gain, feature, cut, counts left of it) of each open node; gain -1 where no border is valid."""
    nodes, classes = stats.shape
    width = len(rows.thresholds)
    drawn = np.ones((nodes, width), dtype=bool)
    if subset < width:
        drawn = np.zeros((nodes, width), dtype=bool)
        np.put_along_axis(drawn, np.argsort(rng.random((nodes, width)), axis=1)[:, :subset], True, axis=1)
    totals = stats.sum(1)
    parent = _impurity(stats, totals, impurity)
    best = np.full(nodes, -1.0)
    feature, cut, left = np.full(nodes, -1), np.zeros(nodes, dtype=np.int64), np.zeros((nodes, classes))
    for f, cuts in enumerate(rows.thresholds):
        size = len(cuts) + 1
        chosen = np.flatnonzero(drawn[:, f])
        if size < 2 or not len(chosen):
            continue
        local = np.full(nodes, -1)
        local[chosen] = np.arange(len(chosen))
        mine = local[at]
        of = np.flatnonzero(mine >= 0)
        mine, bins = mine[of], rows.bins[f][here[of]]
        per = max(1, CELLS_AT_ONCE // (size * classes))
        for begin in range(0, len(chosen), per):
            part = chosen[begin:begin + per]
            inside = slice(None) if len(chosen) <= per else (mine >= begin) & (mine < begin + per)
            cells = ((mine[inside] - begin) * size + bins[inside])[:, None] * classes + np.arange(classes)
            table = np.bincount(cells.ravel(), weight[of[inside]].ravel(), len(part) * size * classes)
            below = table.reshape(len(part), size, classes).cumsum(1)[:, :-1]
            above = stats[part][:, None, :] - below
            n_below, n_above = below.sum(2), above.sum(2)
            whole = totals[part][:, None]
            gains = parent[part][:, None] - n_below / whole * _impurity(below, n_below, impurity) \
                - n_above / whole * _impurity(above, n_above, impurity)
            least = np.minimum(n_below, n_above)
            gains[(least < min_instances) | (least < min_weight) | (gains < min_gain)] = -1.0
            top = gains.argmax(1)
            each = np.arange(len(part))
            better = gains[each, top] > best[part]
            who = part[better]
            best[who], feature[who], cut[who] = gains[each, top][better], f, top[better]
            left[who] = below[each, top][better]
    return best, feature, cut, left


def _pruned(stats, levels, starts) -> Tree:
    n = len(stats)
    gain, feature, cut = np.full(n, -1.0), np.full(n, -1), np.zeros(n, dtype=np.int64)
    left, right = np.full(n, -1), np.full(n, -1)
    prediction = stats.argmax(1)
    for (ids, g, f, c), start in zip(levels, starts[1:]):
        gain[ids], feature[ids], cut[ids] = g, f, c
        left[ids] = start + 2 * np.arange(len(ids))
        right[ids] = left[ids] + 1
    for ids, *_ in reversed(levels):
        a, b = left[ids], right[ids]
        same = ids[(left[a] < 0) & (left[b] < 0) & (prediction[a] == prediction[b])]
        left[same] = right[same] = feature[same] = -1
        gain[same] = -1.0
    kept = np.zeros(n, dtype=bool)
    kept[0] = True
    for ids, *_ in levels:
        inner = ids[kept[ids] & (left[ids] >= 0)]
        kept[left[inner]] = kept[right[inner]] = True
    number = np.where(kept, np.cumsum(kept) - 1, -1)
    moved = [np.where(side[kept] >= 0, number[side[kept]], -1) for side in (left, right)]
    bounds = [int(kept[:s].sum()) for s in starts]
    return Tree(stats[kept], gain[kept], feature[kept], cut[kept], *moved, bounds)


# ---- model files -----------------------------------------------------------

def _node_batch(tree: int, grown: Tree, rows: CountedRows, impurity: str) -> pa.RecordBatch:
    """A tree's nodes as MLlib's saved forests have them."""
    n, classes = grown.stats.shape
    inner = grown.left >= 0
    border = [0.0 if rows.binary[f] else float(rows.thresholds[f][c])
              for f, c in zip(grown.feature[inner], grown.cut[inner])]
    flags = np.array(rows.binary)
    categories = np.where(inner & flags[grown.feature], 2, -1)
    totals = grown.stats.sum(1)

    def int32(x):
        return pa.array(np.asarray(x, dtype=np.int32))

    def lists(offsets, flat):
        return pa.ListArray.from_arrays(int32(offsets), pa.array(flat, pa.float64()))

    split = pa.StructArray.from_arrays(
        [int32(grown.feature), lists(np.concatenate([[0], np.cumsum(inner)]), border), int32(categories)],
        names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    node = pa.StructArray.from_arrays(
        [int32(np.arange(n)), pa.array(grown.stats.argmax(1).astype(float)),
         pa.array(_impurity(grown.stats, totals, impurity)),
         lists(np.arange(n + 1) * classes, grown.stats.ravel()), pa.array(totals.astype(np.int64)),
         pa.array(grown.gain), int32(grown.left), int32(grown.right), split],
        names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.RecordBatch.from_arrays([int32(np.full(n, tree)), node], names=["treeID", "nodeData"])


def _growing(shared, seed: int, rate: float, bootstrap: bool, **rules):
    """Arrow batches of tree numbers to their nodes.  A tree's draws depend on seed and number only."""
    def trees(batches):
        rows = CountedRows(**shared.value)
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                rng = np.random.default_rng([seed & (2 ** 64 - 1), tree])
                if bootstrap:
                    weights = rng.poisson(rows.counts * rate)
                else:
                    weights = rows.counts if rate == 1.0 else rng.binomial(rows.counts, rate)
                yield _node_batch(tree, grow(rows, weights, rng, **rules), rows, rules["impurity"])
    return trees


def _param_json(params: dict) -> dict:
    return {p.name: v for p, v in params.items()}


def _subset(strategy: str, trees: int, width: int) -> int | None:
    strategy = strategy.lower()
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    sizes = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "onethird": math.ceil(width / 3),
             "log2": max(1, math.ceil(math.log2(width)))}
    return sizes.get(strategy)


class _Room:
    """Models of a grid wait here to be loaded until those in use leave room; a model leaves when nobody refers to it.
    A thread whose last model is still inside does not wait: its caller keeps the models."""

    def __init__(self):
        self.inside, self.changed = {}, threading.Condition()

    def enter(self, ticket: str, nodes: int) -> None:
        me = threading.get_ident()

        def fits():
            inside = self.inside.values()
            return not inside or me in (who for who, _ in inside) or sum(n for _, n in inside) + nodes <= MOST_NODES

        with self.changed:
            self.changed.wait_for(fits, LONGEST_WAIT)
            self.inside[ticket] = me, nodes

    def leave(self, ticket: str) -> None:
        with self.changed:
            self.inside.pop(ticket, None)
            self.changed.notify_all()


class CountedForestClassifier(RandomForestClassifier):
    """``RandomForestClassifier`` whose trees are grown from counted rows.

    Same parameters, rules and kind of model (without a training summary).  With bootstrap or a sampling rate the
    trees differ from MLlib's as another seed's do; they are the same on any layout that gives the same split points.
    Null, NaN or infinite features and labels that are no class numbers raise.  MLlib fits where that is soon done
    (``FEW_VISITS``), where too many rows differ (``MOST_CELLS``), and with row weights, nominal features,
    a label with ML attributes, or a number as the feature subset.
    """

    def fitMultiple(self, dataset, paramMaps):
        """Rows are counted once for all maps that agree in the columns, bins and seed.  Trees of several maps may grow
        at once; their models come one after another where the driver would hold over ``MOST_NODES``."""
        estimator, shared, lock, room = self.copy(), {}, threading.Lock(), _Room()

        def one(index):
            own = estimator.copy(paramMaps[index])
            own._shared = shared, lock, room
            return own._fit(dataset)

        return _FitMultipleIterator(one, len(paramMaps))

    def _fit(self, dataset):
        width_free = _subset(self.getFeatureSubsetStrategy(), self.getNumTrees(), 1) is not None
        plain = not self.isDefined(self.weightCol) or not self.getWeightCol()
        if not (width_free and plain) or "ml_attr" in dataset.schema[self.getLabelCol()].metadata:
            return super()._fit(dataset)
        shared, lock, room = getattr(self, "_shared", None) or ({}, threading.Lock(), _Room())
        columns = self.getFeaturesCol(), self.getLabelCol()
        key, counted = (*columns, self.getMaxBins(), self.getSeed()), None
        with lock:
            if columns not in shared:
                shared[columns] = self._rows_and_classes(dataset)
            rows, classes = shared[columns]
            if rows * self.getNumTrees() * (self.getMaxDepth() + 1) > FEW_VISITS:
                if key not in shared:
                    shared[key] = counted_rows(dataset, *key, rows, classes)
                counted = shared[key]
        return super()._fit(dataset) if counted is None else self._grown(dataset.sparkSession, counted, rows, room)

    def _rows_and_classes(self, dataset):
        y = F.col(self.getLabelCol()).cast("double")
        bad = F.col(self.getFeaturesCol()).isNull() | y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y)) \
            | (y >= 2 ** 31)
        found = dataset.agg(F.count(F.lit(1)).alias("n"), F.max(y).alias("top"), F.count_if(bad).alias("bad")).first()
        if found.bad:
            raise ValueError(f"{found.bad} rows have no features, or a label that is no class number")
        return found.n, int(found.top or 0) + 1

    def _grown(self, spark, counted: CountedRows, rows: int, room: _Room):
        trees, sc = self.getNumTrees(), spark.sparkContext
        folder = scratch_path(spark, "forest")
        self._write_metadata(spark, folder, counted)
        sent = sc.broadcast(vars(counted))  # no class of the package: executors have no copy to read it with
        try:
            grown = _growing(sent, self.getSeed(), self.getSubsamplingRate(), self.getBootstrap(),
                             max_depth=self.getMaxDepth(), impurity=self.getImpurity().lower(),
                             subset=_subset(self.getFeatureSubsetStrategy(), trees, len(counted.thresholds)),
                             min_instances=self.getMinInstancesPerNode(), min_gain=self.getMinInfoGain(),
                             min_weight=self.getMinWeightFractionPerNode() * rows)
            spark.range(0, trees, 1, min(trees, sc.defaultParallelism)).mapInArrow(grown, NODE) \
                .write.parquet(f"{folder}/data")
        finally:
            sent.destroy()
        room.enter(folder, trees * min(2 ** (self.getMaxDepth() + 1), 2 * len(counted.counts)))
        try:
            model = RandomForestClassificationModel.load(folder)
        except BaseException:
            room.leave(folder)
            raise
        weakref.finalize(model, room.leave, folder)
        path, files = _path(spark, folder)
        files.delete(path, True)
        return self._copyValues(model)

    def _write_metadata(self, spark, folder: str, counted: CountedRows) -> None:
        common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        package = "org.apache.spark.ml.classification"
        defaults = _param_json(self._defaultParamMap)
        forest = common | {"class": f"{package}.RandomForestClassificationModel", "uid": self.uid,
                           "paramMap": _param_json(self._paramMap), "defaultParamMap": defaults,
                           "numFeatures": len(counted.thresholds), "numClasses": counted.counts.shape[1],
                           "numTrees": self.getNumTrees()}
        of_tree = {k: v for k, v in (defaults | _param_json(self._paramMap)).items()
                   if k in ("cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol",
                            "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain", "minInstancesPerNode",
                            "minWeightFractionPerNode", "seed")}
        trees = [(i, json.dumps(common | {"class": f"{package}.DecisionTreeClassificationModel",
                                          "uid": f"dtc_{uuid.uuid4().hex[:12]}", "paramMap": of_tree,
                                          "defaultParamMap": {}}), 1.0) for i in range(self.getNumTrees())]
        path, files = _path(spark, f"{folder}/metadata/part-00000")
        out = files.create(path)
        out.write(bytearray(json.dumps(forest) + "\n", "utf-8"))
        out.close()
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
