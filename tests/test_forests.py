import random
import re

import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.ml import features as FE
from tessera.ml import forests as FO
from tessera.session import scratch_path
from tests.conftest import SF_SMALL


@pytest.fixture
def counting(monkeypatch):
    """Also small fits are grown from counted rows; MLlib's own are noted."""
    seen, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(FO, "FEW_VISITS", 0)
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, data: seen.append(type(self)) or fit(self, data))
    return seen


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(7)
    rows = []
    for i in range(2500):
        a, b, k = r.randrange(20), r.uniform(-50, 50), "xyz"[i % 3]
        rows.append((i, float(a), b, float(i % 2), k, float(r.randrange(4) if r.random() < .4 else (a > 9) + (b > 0) + 1)))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, k string, label double")
    _, df = FE.index_categories(df, "k", "ki")
    _, df = FE.one_hot(df, "ki", "kv")
    return FE.assemble(df, ["a", "b", "c", "kv"], "features").cache()


def _rules(model):
    return re.sub(r"uid=\S+", "", model.toDebugString)


def _scored(model, data):
    return {r.id: r.p for r in model.transform(data).select("id", vector_to_array("probability").alias("p")).collect()}


@pytest.mark.parametrize("more", [
    {"maxDepth": 20}, {"maxDepth": 8, "impurity": "entropy"}, {"maxDepth": 9, "minInstancesPerNode": 7},
    {"maxDepth": 9, "minInfoGain": 0.01, "maxBins": 5}, {"maxDepth": 9, "minWeightFractionPerNode": 0.02}, {"maxDepth": 0}])
def test_a_tree_on_all_rows_is_mllibs(spark, data, counting, more):
    settings = dict(numTrees=1, bootstrap=False, featureSubsetStrategy="all", seed=3, **more)
    theirs = RandomForestClassifier(**settings).fit(data)
    counting.clear()
    ours = FO.CountedForestClassifier(**settings).fit(data)
    assert not counting and _rules(ours) == _rules(theirs) and _scored(ours, data) == _scored(theirs, data)
    assert ours.featureImportances == theirs.featureImportances and ours.getMaxDepth() == more["maxDepth"]


def test_a_forest_votes_as_mllibs_and_as_on_any_layout(spark, data, counting):
    """Sampled forests differ from MLlib's no more than MLlib's from each other, by rate and without bootstrap."""
    for settings in (dict(subsamplingRate=1.0), dict(subsamplingRate=0.5, bootstrap=False)):
        settings |= dict(numTrees=40, maxDepth=6)
        ours = FO.CountedForestClassifier(seed=1, **settings).fit(data)
        assert not counting and ours.getNumTrees == 40 and ours.getSubsamplingRate() == settings["subsamplingRate"]
        votes = [_scored(m, data) for m in (ours, *(RandomForestClassifier(seed=s, **settings).fit(data) for s in (1, 2)))]
        counting.clear()

        def apart(x, y):
            return sum(abs(p - q) for i in x for p, q in zip(x[i], y[i])) / len(x)

        assert apart(votes[0], votes[1]) < 1.25 * apart(votes[1], votes[2])
        again = FO.CountedForestClassifier(seed=1, **settings).fit(data.repartition(5, "b"))
        assert _rules(again) == _rules(ours)
        sizes = sorted(t.numNodes for t in ours.trees)
        assert len(set(sizes)) > 1  # trees of their own draws
    path = scratch_path(spark, "test-forest")
    ours.write().save(path)
    assert _rules(RandomForestClassificationModel.load(path)) == _rules(ours)


def test_rows_are_counted_once_for_a_grid_and_none_is_lost(spark, data, counting, monkeypatch):
    calls, count = [], FO.counted_rows
    monkeypatch.setattr(FO, "counted_rows", lambda *a: calls.append(count(*a)) or calls[-1])
    est = FO.CountedForestClassifier(numTrees=3, seed=1)
    models = est.fit(data, [{est.maxDepth: 2}, {est.maxDepth: 6}, {est.subsamplingRate: 0.5}])
    assert len(calls) == 1 and not counting and [m.getMaxDepth() for m in models] == [2, 6, 5]
    assert calls[0].counts.sum() == data.count() and len({tuple(c) for c in calls[0].bins.T}) == len(calls[0].counts)
    by_label = {int(r.label): r.n for r in data.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert dict(enumerate(calls[0].counts.sum(0).tolist())) == by_label


def test_bad_rows_raise(spark, data, counting):
    est = FO.CountedForestClassifier(numTrees=2, seed=1)
    for label in (F.lit(None).cast("double"), F.lit(-1.0), F.lit(1.5), F.lit(float("nan"))):
        with pytest.raises(ValueError):
            est.fit(data.withColumn("label", F.when(F.col("id") == 5, label).otherwise(F.col("label"))))
    for value in (float("nan"), float("inf")):
        odd = data.drop("features").withColumn("b", F.when(F.col("id") == 5, F.lit(value)).otherwise(F.col("b")))
        with pytest.raises(Exception, match="null, NaN or infinite"):
            est.fit(FE.assemble(odd, ["a", "b"], "features", handle_invalid="keep"))


def test_mllib_fits_what_is_not_counted(spark, data, counting, monkeypatch):
    est = FO.CountedForestClassifier(numTrees=2, maxDepth=2, seed=1)
    est.copy({est.weightCol: "w"}).fit(data.withColumn("w", F.lit(2.0)))
    est.copy({est.featureSubsetStrategy: "2"}).fit(data)
    est.fit(FE.assemble(data.drop("features"), ["a", "ki"], "features"))  # ki: a nominal feature
    assert len(counting) == 3
    two = FE.assemble(data.drop("features"), ["a", "b"], "features")
    monkeypatch.setattr(FO, "MOST_CELLS", 2 * 2500)  # the sample fits, the distinct rows by class do not
    assert est.copy({est.maxBins: 128}).fit(two).getNumTrees == 2 and len(counting) == 4


def test_deep_points_of_the_validator_stage_need_no_pass_a_level(spark, counting, monkeypatch):
    """MLlib passed over all rows for every level and group of nodes of every point."""
    from tessera.plans import ml_plans as P

    calls, count = [], FO.counted_rows
    monkeypatch.setattr(FO, "counted_rows", lambda *a: calls.append(1) or count(*a))
    grid = {"maxDepth": [3, 12], "numTrees": [10], "subsamplingRate": [0.5, 1.0]}
    row = P.m24_validator_as_last_stage(spark, SF_SMALL, grid).first()
    assert not counting and len(calls) == 2  # once for the points, once for the refit
    assert row.max_depth in (3, 12) and row.num_trees == 10 and 0 < row.accuracy_model < 1


def test_models_of_a_grid_wait_for_room_and_all_come(spark, data, counting, monkeypatch):
    """The driver holds few large models at once; held ones do not stop the rest for good."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import TrainValidationSplit

    most, enter = [], FO._Room.enter
    monkeypatch.setattr(FO, "MOST_NODES", 10)
    monkeypatch.setattr(FO._Room, "enter", lambda self, *a: (enter(self, *a), most.append(len(self.inside))))
    est = FO.CountedForestClassifier(maxDepth=6, seed=1)
    grid = [{est.numTrees: n} for n in (2, 3, 4, 5)]
    fit = TrainValidationSplit(estimator=est, estimatorParamMaps=grid, seed=3, parallelism=4,
                               evaluator=MulticlassClassificationEvaluator(metricName="accuracy")).fit(data)
    assert most == [1] * 5 and len(fit.validationMetrics) == 4 and not counting
    assert [m.getNumTrees for m in est.fit(data, grid)] == [2, 3, 4, 5]
