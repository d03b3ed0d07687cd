"""Tuning from cross products, recoverable grids, wide categories, split gains."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tessera.ml import categories as CA
from tessera.ml import crossproducts as CP
from tessera.ml import features as FE
from tessera.ml import grid_runs as GR
from tessera.ml import models as MO
from tessera.ml import splits as SP
from tessera.operators.ranking import numbered
from tessera.operators.sampling import hash_unit
from tessera.session import scratch_path

NAMES = ["a", "b", "c", "d"]


def regression_rows(n=240):
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        a, b, c = rnd.gauss(1e6, 2.0), rnd.gauss(0, 30), rnd.random()
        rows.append((i, a, b, c, 5.0, 3 * (a - 1e6) - 0.2 * b + rnd.gauss(0, 2) + 7))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(regression_rows(), "id long, a double, b double, c double, d double, y double").repartition(5)


def test_metrics_equal_the_cross_validator_on_the_same_folds(spark, frame):
    """Every point's average metric and the refitted models, with correlated scales and a constant feature."""
    fold = (hash_unit("id") % 3).cast("int")
    data = FE.assemble(frame, NAMES, "features").withColumn("fold", fold).withColumnRenamed("y", "label").cache()
    points = CP.grid([0.1, 1.0], [0.4, 1.0])
    est = MO.linear_regression(tol=1e-9, maxIter=40, solver="l-bfgs")
    maps = ParamGridBuilder().addGrid(est.regParam, [0.1, 1.0]).addGrid(est.elasticNetParam, [0.4, 1.0]).build()
    settings = [(m[est.regParam], m[est.elasticNetParam], True) for m in maps]
    got = {(r.reg_param, r.elastic_net_param, r.fit_intercept): r
           for r in CP.tune(frame, NAMES, "y", points, fold, range(3)).collect()}
    assert set(got) == set(settings)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=RegressionEvaluator(metricName="r2"), numFolds=3,
                        foldCol="fold", parallelism=4).fit(data)
    for s, want in zip(settings, cv.avgMetrics):
        assert got[s].r2 == pytest.approx(want, rel=2e-5, abs=2e-5), s
    best = min((r for r in got.values()), key=lambda r: (float(f"{r.rmse:.8e}"), r.position))
    assert best.is_best and sum(r.is_best for r in got.values()) == 1
    refit = MO.linear_regression(reg_param=1.0, elastic_net=0.4, tol=1e-9, maxIter=60, solver="l-bfgs").fit(data)
    row = got[1.0, 0.4, True]
    assert np.allclose(row.coefficients, refit.coefficients.toArray(), atol=1e-4)
    data.unpersist()


def test_unpenalised_fit_is_least_squares(frame):
    rows = np.array([r[1:] for r in regression_rows()])
    for intercept in (True, False):
        point = CP.Point(0.0, 0.0, intercept)
        got = CP.tune(frame, ["b", "c"], "y", [point], F.lit(0), [0]).first()
        x = np.column_stack([rows[:, 1:3], np.ones(len(rows)) if intercept else np.zeros(len(rows))])
        want = np.linalg.lstsq(x, rows[:, -1], rcond=None)[0]
        assert np.allclose(got.coefficients, want[:2], rtol=1e-7)
        assert got.intercept == pytest.approx(want[2] if intercept else 0.0, rel=1e-7)


def test_rows_are_scanned_twice_whatever_the_grid(spark, frame):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = frame.mapInArrow(count, frame.schema)
    CP.tune(watched, NAMES, "y", CP.grid([0.1 * k for k in range(40)], [0.0, 1.0]), hash_unit("id") % 5, range(5)).count()
    assert seen.value == 2 * frame.count()


def test_nulls_empty_folds_and_empty_frames(spark, frame):
    some = frame.union(spark.createDataFrame([(900, None, 1.0, 1.0, 5.0, 1.0), (901, 1.0, float("nan"), 1.0, 5.0, 1.0),
                                              (902, 1.0, 1.0, 1.0, 5.0, None)], frame.schema))
    points = CP.grid([0.0, 1.0])
    same = [CP.tune(f, NAMES, "y", points, hash_unit("id") % 3, range(3)).drop("coefficients").collect() for f in (frame, some)]
    assert [tuple(np.round(list(r), 9)) for r in same[0]] == [tuple(np.round(list(r), 9)) for r in same[1]]
    assert CP.tune(frame.limit(0), NAMES, "y", points, F.lit(0), [0]).count() == 0
    alone = CP.tune(frame, ["d"], "y", points, F.lit(0), [0]).collect()  # nothing to train on, and no spread
    assert not any(r.is_best and np.isnan(r.rmse) for r in alone) and all(r.coefficients == [0.0] for r in alone)


def test_moments_add_up_far_from_zero(spark):
    rows = [(i % 4, 1e9 + i * 0.01, i * 0.5) for i in range(400)]
    df = spark.createDataFrame(rows, "f int, x double, y double").repartition(7)
    m = CP.cross_moments(df, ["x"], "y", F.col("f"))
    total = m[0] + m[1] + m[2] + m[3]
    x = np.array([[r[1], r[2]] for r in rows])
    want = np.cov(x.T, bias=True) * len(x)
    assert total.n == 400 and np.allclose(total.cross, want, rtol=1e-6)


# --- recoverable grid ----------------------------------------------------------

GRID = {"maxDepth": [1, 2, 3], "numTrees": [1, 2, 3], "subsamplingRate": [0.5, 1.0]}


class Killed(RuntimeError):
    pass


def test_a_killed_grid_goes_on_where_it_was(spark):
    points, path, measured = GR.points_of(GRID), scratch_path(spark, "grid"), []
    assert len(points) == 18

    def measure(p, stop_after=None):
        if stop_after is not None and len(measured) >= stop_after:
            raise Killed
        measured.append(json.dumps(p, sort_keys=True))
        return p["maxDepth"] % 3 + 0.1 * p["numTrees"]

    with pytest.raises(Killed):
        GR.run_grid(spark, points, lambda p: measure(p, 7), path, "s", parallelism=1)
    assert len(measured) == 7
    # a point whose folder was begun but not finished is run again
    half = f"{path}/run_id={GR.run_id(points[0], 's')}"
    files = spark._jvm.org.apache.hadoop.fs.Path(half).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{half}/_SUCCESS"), False)
    first = list(measured)
    measured.clear()
    runs = GR.run_grid(spark, points, measure, path, "s", parallelism=4)
    assert sorted(measured + first[1:]) == sorted(json.dumps(p, sort_keys=True) for p in points)
    table = runs.collect()
    assert sorted(r.position for r in table) == list(range(18))
    best = max(table, key=lambda r: (r.metric, -r.position))
    assert GR.best_settings(runs) == json.loads(best.settings)
    measured.clear()
    assert GR.run_grid(spark, points, measure, path, "s").count() == 18 and measured == []
    # another scope (other data) shares no result, and other grids in the table are left out
    assert GR.run_grid(spark, points[:2], measure, path, "other").count() == 2 and len(measured) == 2
    with pytest.raises(ValueError):
        GR.run_grid(spark, [points[0], dict(points[0])], measure, path, "s")


# --- wide categories ---------------------------------------------------------------

def test_dictionary_equals_the_string_indexer(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["AUTO", "FURNITURE", "x", "é", " ", "hot", "hot", "hot"])) for i in range(500)]
    df = spark.createDataFrame(rows + [(900, None)], "id long, segment string").repartition(6)
    words = CA.category_dictionary(df, "segment")
    model, indexed = FE.index_categories(df.dropna(), "segment", "i")
    assert [r.value for r in words.orderBy("index").collect()] == model.labels
    got = {r.id: r.i for r in CA.index_with(df, words, "segment", "i", "skip").collect()}
    assert got == {r.id: r.i for r in indexed.collect()}
    kept = {r.id: r.i for r in CA.index_with(df, words, "segment", "i", "keep").collect()}
    assert kept == got | {900: float(len(model.labels))}
    with pytest.raises(CA.UnseenCategory):
        CA.index_with(df, words, "segment", "i")
    assert CA.index_with(df.dropna(), words, "segment", "i").count() == 500
    _, dense = FE.one_hot(indexed, "i", "v")
    from pyspark.ml.functions import vector_to_array
    want = {r.id: r.a for r in dense.select("id", vector_to_array("v").alias("a")).collect()}
    for r in CA.one_hot_sparse(indexed, "i", len(model.labels), "v").collect():
        full = [0.0] * r.v["size"]
        for at, x in zip(r.v["indices"], r.v["values"]):
            full[at] = x
        assert full == want[r.id]
    whole = CA.one_hot_sparse(CA.index_with(df, words, "segment", "i", "keep"), "i", len(model.labels), "v", drop_last=False)
    assert {len(r.v["indices"]) for r in whole.where("id = 900").collect()} == {0}
    assert CA.category_dictionary(df.limit(0), "segment").count() == 0


def test_numbered_is_a_dense_order_over_many_partitions(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 50), rnd.choice("abc"), i) for i in range(700)]
    df = spark.createDataFrame(rows, "k int, s string, i int").repartition(9)
    for parts in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = [(r.k, r.s, r.i) for r in sorted(numbered(df, [F.desc("k"), F.asc("s"), F.asc("i")]).collect(), key=lambda r: r.position)]
        assert got == sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
        assert sorted(r.position for r in numbered(df, [F.asc("i")]).collect()) == list(range(700))
    spark.conf.set("spark.sql.shuffle.partitions", "8")


# --- split gains ---------------------------------------------------------------------

@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_gains_match_counting_and_the_tree(spark, impurity):
    rnd = random.Random(4)
    rows = [(rnd.random() < 0.4, rnd.choice("xyz"), rnd.random() < 0.5, rnd.choice([0.0, 1.0, 2.0])) for _ in range(300)]
    rows = [(a, s, b, 2.0 if a and rnd.random() < 0.7 else y) for a, s, b, y in rows] + [(None, None, True, 1.0), (True, "x", True, None)]
    df = spark.createDataFrame(rows, "a boolean, s string, b boolean, label double").repartition(4)

    def measure(labels):
        share = [labels.count(c) / len(labels) for c in set(labels)]
        return 1 - sum(p * p for p in share) if impurity == "gini" else -sum(p * np.log2(p) for p in share)

    got = {(r.feature, r.value): (r.n_left, r.gain) for r in SP.split_gains(df, ["a", "s", "b"], "label", impurity).collect()}
    for at, name in enumerate(["a", "s", "b"]):
        known = [(str(r[at]).lower() if isinstance(r[at], bool) else r[at], r[3]) for r in rows if r[at] is not None and r[3] is not None]
        for value in {v for v, _ in known}:
            left, right = [y for v, y in known if v == value], [y for v, y in known if v != value]
            after = (len(left) * measure(left) + len(right) * measure(right)) / len(known)
            assert got[name, value] == (len(left), pytest.approx(measure([y for _, y in known]) - after, abs=1e-12))
    assert len(got) == 7
    data = FE.assemble(df.dropna(), ["a", "b"], "features")
    model = MO.fit_classifier("tree", data, maxDepth=1, impurity=impurity)
    best = max(itertools.product(["a", "b"], ["true"]), key=lambda k: SP_GAIN(df.dropna(), k, impurity))
    assert model.featureImportances.toArray().argmax() == ["a", "b"].index(best[0])
    assert model._call_java("rootNode").gain() == pytest.approx(SP_GAIN(df.dropna(), best, impurity), abs=1e-9)


def SP_GAIN(df, key, impurity):
    return {(r.feature, r.value): r.gain for r in SP.split_gains(df, ["a", "b"], "label", impurity).collect()}[key]


def test_a_constant_column_and_an_empty_frame_have_no_gain(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 0.0)], "a boolean, label double")
    assert [r.gain for r in SP.split_gains(df, ["a"], "label").collect()] == [0.0]
    assert SP.split_gains(df.limit(0), ["a"], "label").count() == 0
