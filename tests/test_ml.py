import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.ml import evaluation as EV
from tessera.ml import features as FE
from tessera.ml import models as MO
from tessera.ml import pipelines as PL
from tessera.ml import tuning as TU
from tessera.session import scratch_path


def test_binarizer_integer_input_and_threshold(spark):
    df = spark.createDataFrame([(1, 5), (2, 4), (3, 3)], "id int, r int")
    out = {r.id: r.b for r in FE.binarize(df, "r", "b", 4.5).collect()}
    assert out == {1: 1.0, 2: 0.0, 3: 0.0}


def test_indexer_ties_alphabetical_and_one_hot_drops_last(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    model, out = FE.index_categories(df, "k", "i")
    assert model.labels == ["c", "a", "b"]
    _, enc = FE.one_hot(out, "i", "v")
    row = enc.where("k = 'b'").select(vector_to_array("v").alias("a")).first()
    assert row.a == [0.0, 0.0]


def test_indexer_keep_gives_null_last_index(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    _, out = FE.index_categories(df, "k", "i", handle_invalid="keep")
    assert sorted(r.i for r in out.collect()) == [0.0, 0.0, 1.0]


def test_assembler_and_metadata(spark):
    df = spark.createDataFrame([(True, 2.0, "x"), (False, 3.0, "y"), (True, 1.0, "x")], "b boolean, v double, k string")
    _, df = FE.index_categories(df, "k", "ki")
    _, df = FE.one_hot(df, "ki", "kv")
    out = FE.assemble(df, ["b", "v", "kv"], "features")
    meta = [(r.idx, r.name) for r in FE.feature_metadata(out).collect()]
    assert meta == [(0, "b"), (1, "v"), (2, "kv_x")]


def _binary(spark):
    rows = [(float(i % 2 == 0), float(i % 3 == 0 or i % 2 == 0 and i % 5 != 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, label double")
    return FE.assemble(df, ["x"], "features")


def test_logistic_on_binary_feature_predicts_group_means(spark):
    data = _binary(spark)
    model = MO.logistic_regression(regParam=0.0, tol=1e-10, maxIter=200).fit(data)
    means = {r.x: r.m for r in data.groupBy("x").agg(F.avg("label").alias("m")).collect()}
    probs = {r.x: r.p for r in model.transform(data).select("x", vector_to_array("probability")[1].alias("p"))
             .distinct().collect()}
    for x, m in means.items():
        assert probs[x] == pytest.approx(m, abs=1e-6)
    m = EV.binary_metrics(model.transform(data))
    assert 0.0 <= m["areaUnderROC"] <= 1.0 and 0.0 <= m["areaUnderPR"] <= 1.0


def test_summary_metric_equals_evaluator(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + (x % 3)) for x in range(50)], "x double, label double")
    data = FE.assemble(df, ["x"], "features")
    model = MO.linear_regression(solver="normal").fit(data)
    m = EV.regression_metrics(model.transform(data))
    assert m["r2"] == pytest.approx(model.summary.r2) and m["rmse"] == pytest.approx(model.summary.rootMeanSquaredError)


def test_pipeline_save_load_same_predictions(spark):
    rows = [(i, i % 7 == 0, (i % 5) + 1, "t" if i % 3 == 0 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, c boolean, star_rating int, review string") \
        .withColumn("cancelled", F.col("c").cast("int")).drop("c")
    path = scratch_path(spark, "test-pipeline")
    from tessera.plans.ml_plans import rating_pipeline

    PL.save_pipeline(rating_pipeline(), path)
    model = PL.load_pipeline(path).fit(df)
    mpath = scratch_path(spark, "test-pipeline-model")
    model.write().overwrite().save(mpath)
    a = model.transform(df).select("id", "prediction").orderBy("id").collect()
    b = PL.load_pipeline_model(mpath).transform(df).select("id", "prediction").orderBy("id").collect()
    assert a == b and len(a) == df.where("cancelled = 0").count()


def test_holdout_refits_best_on_all_training_rows(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + (x % 4)) for x in range(200)], "x double, label double")
    data = FE.assemble(df, ["x"], "features")
    est = MO.linear_regression(elastic_net=1.0)
    from pyspark.ml.evaluation import RegressionEvaluator

    maps = TU.param_grid({est.regParam: [0.0, 0.5, 5.0]})
    model, metrics = TU.holdout(est, maps, RegressionEvaluator(metricName="rmse"), data)
    assert metrics.count() == 3
    assert model.bestModel.summary.numInstances == 200


def test_drop_prediction_columns(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "prediction double, label double")
    assert EV.drop_prediction_columns(df).columns == ["label"]


def test_experiment_runs_are_idempotent(spark):
    from tessera.ml.experiments import run_experiments

    df = spark.createDataFrame([(i, float(i % 17), 2.0 * (i % 17) + (i % 3)) for i in range(300)],
                               "k long, x double, label double")
    data = FE.assemble(df, ["x"], "features")
    path = scratch_path(spark, "test-runs")
    params = [{"fit_intercept": True, "train_fraction": 0.7}, {"fit_intercept": False, "train_fraction": 0.7}]
    run_experiments(data, params, path, ["k"])
    out = run_experiments(data, params[:1], path, ["k"])  # a retried run
    rows = out.collect()
    assert len(rows) == 2 and len({r.run_id for r in rows}) == 2
    with_int = [r for r in rows if r.fit_intercept][0]
    assert with_int.r2 > 0.9 and with_int.n_train + with_int.n_test == 300


def test_least_squares_aggregate_equals_mllib(spark):
    df = spark.createDataFrame([(float(x), 2.5 * x + (x % 7) - 3.0) for x in range(200)], "x double, label double")
    r = MO.least_squares_one_feature(df, "x", "label").first()
    model = MO.linear_regression(solver="normal").fit(FE.assemble(df, ["x"], "features"))
    assert r.intercept == pytest.approx(model.intercept, rel=1e-9)
    assert r.slope == pytest.approx(model.coefficients[0], rel=1e-9)
    assert r.r2 == pytest.approx(model.summary.r2, rel=1e-9)
    assert r.rmse == pytest.approx(model.summary.rootMeanSquaredError, rel=1e-9) and r.n == 200


def test_assembler_skip_drops_rows_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (4.0, None)], "a double, b double")
    assert FE.assemble(df, ["a", "b"], "f", handle_invalid="skip").count() == 1
    with pytest.raises(Exception):
        FE.assemble(df, ["a", "b"], "f").collect()


def test_regression_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.createDataFrame([(float(i), i * 1.1 + (-1) ** i) for i in range(50)], "label double, prediction double")
    got = EV.regression_metrics(df)
    for name, value in got.items():
        assert value == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))
    flat = EV.regression_metrics(df.select(F.lit(1.0).alias("label"), "prediction"))
    assert flat["r2"] != flat["r2"] and EV.regression_metrics(df.limit(0))["rmse"] != 0


def test_fits_leave_nothing_persisted(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("m10_logistic_regression", "m15_holdout_area_under_roc", "m22_m23_kfold_tuning"):
        E.queries()[name](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_validator_stage_tunes_the_grid_it_is_given(spark):
    import inspect

    from tests.conftest import SF_SMALL

    from tessera.plans import ml_plans as P

    default = inspect.signature(P.m24_validator_as_last_stage).parameters["forest_grid"].default
    assert default == {"maxDepth": [5, 10, 20], "numTrees": [20, 50, 100], "subsamplingRate": [0.5, 1.0]}
    one = P.m24_validator_as_last_stage(spark, SF_SMALL, {"maxDepth": [2], "numTrees": [3], "subsamplingRate": [1.0]})
    assert [(r.max_depth, r.num_trees, r.subsampling_rate) for r in one.collect()] == [(2, 3, 1.0)]


def test_validator_stage_fits_on_all_cores(spark, monkeypatch):
    """Rows that a join leaves in one partition are dealt over the cores, none lost, in an order of their own."""
    from pyspark.ml.classification import RandomForestClassifier

    from tests.conftest import SF_SMALL

    from tessera.ml import tuning as TU
    from tessera.plans import ml_plans as P

    seen, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit",
                        lambda self, data: seen.append(data.rdd.getNumPartitions()) or fit(self, data))
    monkeypatch.setattr(TU, "LEAST_ROWS", 50, raising=False)
    P.m24_validator_as_last_stage(spark, SF_SMALL, {"maxDepth": [2], "numTrees": [3], "subsamplingRate": [1.0]}).collect()
    assert seen and min(seen) >= min(8, spark.sparkContext.defaultParallelism)
    one = spark.range(1000).coalesce(1)
    dealt = TU.spread_rows(one, "id")
    parts = dealt.rdd.glom().map(lambda rows: [r.id for r in rows]).collect()
    assert sorted(x for p in parts for x in p) == list(range(1000)) and all(p == sorted(p) for p in parts)
