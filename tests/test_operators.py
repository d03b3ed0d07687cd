import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import plotdata as V
from tessera.operators import stats as S
from tessera.operators.joins import join_dimension
from tessera.operators.quantiles import exact_quantiles, target_ranks
from tessera.operators.relational import frequency, label_by_feature
from tessera.operators.sampling import hash_sample, hash_split, labelled_random_split
from tessera.sources.local import TooLargeForDriver, to_local

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def brute_quantiles(values, probs):
    v = sorted(x for x in values if x is not None)
    return [v[r - 1] for r in target_ranks(probs, len(v))]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    hot = 7.5  # a third of all rows carry one value
    vals = [round(rnd.gauss(0, 100), 1) for _ in range(4000)] + [hot] * 2000 + [None] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    got = {r.p: r.value for r in exact_quantiles(df, "x", PROBS).collect()}
    assert [got[p] for p in PROBS] == brute_quantiles(vals, PROBS)


def test_exact_quantiles_small_and_equal_to_spark(spark):
    df = spark.range(1, 11).toDF("x")
    got = {r.p: r.value for r in exact_quantiles(df, "x", PROBS).collect()}
    assert [got[p] for p in PROBS] == [int(v) for v in df.approxQuantile("x", PROBS, 0.0)]


def test_exact_quantiles_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert all(r.value is None for r in exact_quantiles(df, "x", [0.5]).collect())


def test_approx_quantiles_rank_bound(spark):
    vals = list(range(10000))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = {r.p: r.value for r in S.approx_quantiles(df, "x", PROBS, 0.1).collect()}
    for p in PROBS:
        assert abs(got[p] - p * len(vals)) <= 0.1 * len(vals) + 1


def test_typed_crosstab_with_null_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (2, None)], "k int, c string")
    out = {r[0]: r.asDict() for r in S.typed_crosstab(df, "k", "c").collect()}
    assert out[1]["a"] == 1 and out[1]["b"] == 1 and out[1]["null"] == 0
    assert out[2]["null"] == 1 and out[None]["a"] == 1
    assert S.typed_crosstab(df, "k", "c").columns[0] == "k_c"


def test_describe_typed_matches_numpy(spark):
    vals = [1.0, 2.0, 4.0, None, 8.0]
    df = spark.createDataFrame([(v, 1) for v in vals], "x double, y int")
    r = [row for row in S.describe_typed(df, "x", "y").collect() if row.column == "x"][0]
    arr = np.array([v for v in vals if v is not None])
    assert r["count"] == 4 and r["mean"] == pytest.approx(arr.mean())
    assert r["stddev"] == pytest.approx(arr.std(ddof=1)) and (r["min"], r["max"]) == (1.0, 8.0)


def test_frequency_keeps_null_group_and_ties(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",), ("b",)], "k string")
    rows = frequency(df, "k").collect()
    assert [(r.k, r["count"]) for r in rows] == [(None, 1), ("a", 2), ("b", 2)]


def test_label_by_feature_mean_is_share(spark):
    df = spark.createDataFrame([("x", 1), ("x", 0), ("x", 1), ("y", 0)], "f string, y int")
    out = {r.f: (r.n, r.mean_label) for r in label_by_feature(df, "f", "y").collect()}
    assert out["x"] == (3, pytest.approx(2 / 3)) and out["y"] == (1, 0.0)


def test_histogram_counts_and_edges(spark):
    vals = [float(v) for v in range(101)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    h = {r.bucket: r for r in V.histogram(df, "x", 10).collect()}
    assert sum(r["count"] for r in h.values()) == 101
    assert h[10]["count"] == 11 and h[10]["upper"] == 100.0 and h[1]["lower"] == 0.0
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r["count"] for r in V.histogram(const, "x", 5).collect()] == [2]


def test_density_integrates_to_about_one(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.gauss(50, 10),) for _ in range(3000)], "x double")
    rows = sorted(V.density_curve(df, "x", bins=40, grid=200).collect(), key=lambda r: r.point)
    step = rows[1].x - rows[0].x
    assert sum(r.density for r in rows) * step == pytest.approx(1.0, abs=0.05)


def test_box_stats_match_brute_force(spark):
    vals = list(range(1, 101)) + [1000, -500]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    r = V.box_stats(df, "x").first()
    q1, med, q3 = brute_quantiles(vals, [0.25, 0.5, 0.75])
    iqr = q3 - q1
    inside = [v for v in vals if q1 - 1.5 * iqr <= v <= q3 + 1.5 * iqr]
    assert (r.q1, r.median, r.q3) == (q1, med, q3)
    assert (r.lower_whisker, r.upper_whisker, r.n_outliers) == (min(inside), max(inside), 2)


def test_linear_fit_exact_line(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 2.0) for x in range(20)], "x double, y double")
    r = V.linear_fit(df, "x", "y").first()
    assert (r.slope, r.intercept, r.r2) == (pytest.approx(3.0), pytest.approx(2.0), pytest.approx(1.0))


def test_quadratic_fit_recovers_coefficients(spark):
    df = spark.createDataFrame([(float(x), 1.0 + 2.0 * x + 0.5 * x * x) for x in range(30)], "x double, y double")
    r = V.quadratic_fit(df, "x", "y").first()
    assert (r.intercept, r.b1, r.b2) == (pytest.approx(1.0, abs=1e-6), pytest.approx(2.0, abs=1e-6),
                                         pytest.approx(0.5, abs=1e-6))


def test_hash_split_disjoint_complete_and_layout_independent(spark):
    df = spark.range(0, 5000).toDF("id")
    a, b = hash_split(df, ["id"], 0.3)
    ids_a, ids_b = {r.id for r in a.collect()}, {r.id for r in b.collect()}
    assert not ids_a & ids_b and len(ids_a | ids_b) == 5000
    assert abs(len(ids_a) - 1500) < 5 * math.sqrt(5000 * 0.3 * 0.7)
    again = {r.id for r in hash_sample(df.repartition(7), ["id"], 0.3).collect()}
    assert again == ids_a


def test_random_split_is_complete(spark):
    df = spark.range(0, 2000).toDF("id")
    out = labelled_random_split(df, [0.7, 0.3], seed=12345)
    assert out.count() == 2000 and out.select("id").distinct().count() == 2000


def test_join_dimension_leaves_broadcast_to_the_byte_threshold(spark):
    fact = spark.range(0, 1000).withColumn("k", F.col("id") % 10)
    dim = spark.range(0, 10).withColumnRenamed("id", "k")
    for threshold, join in ((10 << 20, "BroadcastHashJoin"), (-1, "SortMergeJoin")):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            out = join_dimension(fact, dim, "k")
            assert join in out._jdf.queryExecution().executedPlan().toString() and out.count() == 1000
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_to_local_refuses_unbounded(spark):
    df = spark.range(0, 100)
    assert len(to_local(df, max_rows=100)) == 100
    with pytest.raises(TooLargeForDriver):
        to_local(df, max_rows=99)


def test_ordered_counts_missing_label_and_positions(spark):
    df = spark.createDataFrame([("Car", "f"), ("Noir", None), ("Car", "m"), ("Elite", "f")], "s string, g string")
    out = {(r.s, r.g): (r["count"], r.position, r.hue_position) for r in
           V.ordered_counts(df, "s", ["Car", "Noir", "Grand", "Elite"], hue="g",
                            hue_order=["f", "m", "missing"]).collect()}
    assert out[("Noir", "missing")] == (1, 2, 3) and out[("Elite", "f")] == (1, 4, 1)


def test_all_pair_correlations(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float((-1) ** i)) for i in range(10)], "a double, b double, c double")
    out = {(r.x, r.y): r.corr for r in S.all_pair_correlations(df, ["a", "b", "c"]).collect()}
    assert out[("a", "b")] == pytest.approx(1.0) and len(out) == 3


def test_join_splitting_hot_keys_equals_plain_join(spark):
    from tessera.operators.joins import hot_keys, join_splitting_hot_keys

    # key 7 holds a third of the fact rows; key None never matches
    fact = spark.createDataFrame([(i, 7 if i % 3 == 0 else (None if i % 50 == 1 else i % 40)) for i in range(3000)],
                                 "id long, k long")
    dim = spark.createDataFrame([(k, f"name{k}") for k in range(0, 40, 1) if k != 5], "dk long, name string")
    assert hot_keys(fact, "k", 0.2) == [7]
    for how in ("inner", "left"):
        got = sorted(tuple(r) for r in join_splitting_hot_keys(fact, dim, "k", "dk", how, 0.2)
                     .select("id", "k", "name").collect())
        want = sorted(tuple(r) for r in fact.join(dim, fact.k == dim.dk, how).select("id", "k", "name").collect())
        assert got == want, how


def test_bernoulli_sample_size_within_five_sigma(spark):
    from tessera.operators.sampling import bernoulli_sample

    n, f = 20000, 0.05
    got = bernoulli_sample(spark.range(0, n), f, seed=12345).count()
    assert abs(got - n * f) <= 5 * math.sqrt(n * f * (1 - f))
    again = bernoulli_sample(spark.range(0, n), f, seed=12345).count()
    assert again == got


def test_exact_quantiles_bracketed_path_large(spark):
    rnd = random.Random(11)
    vals = [round(rnd.expovariate(1 / 50.0), 2) for _ in range(40000)] + [12.5] * 20000
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(8)
    probs = [0.001, 0.1, 0.3333, 0.5, 0.9, 0.999]
    got = {r.p: r.value for r in exact_quantiles(df, "x", probs, bracket_error=1e-3).collect()}
    assert [got[p] for p in probs] == brute_quantiles(vals, probs)


def test_exact_quantiles_wrong_brackets_fall_back(spark, monkeypatch):
    from tessera.operators import quantiles as Q

    vals = list(range(1000))
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    monkeypatch.setattr(Q, "_brackets", lambda v, probs, eps, value_type: [(900, 950)] * len(probs))
    got = {r.p: r.value for r in Q.exact_quantiles(df, "x", [0.1, 0.5, 0.92]).collect()}
    assert [got[p] for p in (0.1, 0.5, 0.92)] == brute_quantiles(vals, [0.1, 0.5, 0.92])


def test_exact_quantiles_dates_use_unbracketed_form(spark):
    import datetime as dt

    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i % 97) for i in range(500)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.p: r.value for r in exact_quantiles(df, "d", [0.25, 0.5]).collect()}
    assert [got[0.25], got[0.5]] == brute_quantiles(days, [0.25, 0.5])


def test_pair_grid_counts_match_single_pair_bins(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(rnd.random(), rnd.random() * 10, None if i % 17 == 0 else float(i % 13))
                                for i in range(2000)], "a double, b double, c double")
    grid = V.pair_grid_counts(df, ["a", "b", "c"], 5)
    assert {(r.x, r.y) for r in grid.collect()} == {("a", "b"), ("a", "c"), ("b", "c")}
    complete = df.dropna()
    for x, y in (("a", "b"), ("b", "c")):
        got = {(r.bx, r.by): r["count"] for r in grid.where((F.col("x") == x) & (F.col("y") == y)).collect()}
        want = {(r.bx, r.by): r["count"] for r in V.binned_2d(complete, x, y, 5, 5).collect()}
        assert got == want


def test_exact_quantiles_many_probabilities_and_decimals(spark):
    import decimal

    rnd = random.Random(4)
    vals = [decimal.Decimal(rnd.randrange(0, 10 ** 5)) / 100 for _ in range(8000)] + [decimal.Decimal("0.10")] * 4000
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)] * 50, "x decimal(12,2)").repartition(6)
    probs = [i / 100 for i in range(101)]
    got = {r.p: r.value for r in exact_quantiles(df, "x", probs, bracket_error=1e-3).collect()}
    assert [got[p] for p in probs] == brute_quantiles(vals, probs)


def test_plots_of_columns_without_finite_numbers(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, nan), (nan, 1.0), (None, 3.0), (inf, 1.0), (4.0, 5.0)], "x double, y double")
    assert {(r.bucket, r.lower, r.upper, r["count"]) for r in V.histogram(df, "x", 3).collect()} == {
        (0, None, None, 2), (1, 1.0, 2.0, 1), (2, 2.0, 3.0, 1), (3, 3.0, 4.0, 1)}
    assert sum(r["count"] for r in V.binned_2d(df, "x", "y", 2, 2).collect()) == 2
    assert sum(r["count"] for r in V.pair_grid_counts(df, ["x", "y"], 2).collect()) == 2
    assert all(r.density == r.density for r in V.density_curve(df, "x", 4, 10).collect())
    for none in (df.where("x = 99"), df.select("y", F.lit(None).cast("double").alias("x"))):
        assert V.histogram(none, "x").count() == V.binned_2d(none, "x", "y").count() == 0
        assert V.pair_grid_counts(none, ["x", "y"]).count() == V.density_curve(none, "x").count() == 0
    only = V.histogram(spark.createDataFrame([(nan,), (nan,)], "x double"), "x").collect()
    assert [(r.bucket, r.lower, r["count"]) for r in only] == [(0, None, 2)]


def test_exact_quantiles_large_longs_bracketed(spark):
    base = 2 ** 60
    rnd = random.Random(9)
    vals = [base + rnd.randrange(0, 10 ** 6) for _ in range(30000)] + [base + 17] * 5000
    df = spark.createDataFrame([(v,) for v in vals], "x long").repartition(5)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {r.p: r.value for r in exact_quantiles(df, "x", probs, bracket_error=1e-3).collect()}
    assert [got[p] for p in probs] == brute_quantiles(vals, probs)


def test_null_keys_fall_into_one_part(spark):
    from tessera.operators.sampling import hash_sample, hash_split

    df = spark.createDataFrame([(i if i % 3 else None, f"k{i}" if i % 2 else None) for i in range(60)], "id long, k string")
    for keys in (["id"], ["id", "k"]):
        a, b = hash_split(df, keys, 0.4)
        assert a.count() + b.count() == 60
        assert hash_sample(df, keys, 1.0).count() == 60


def test_table_reads_appended_rows(spark, tmp_path):
    from tessera.plans.registry import table

    spark.range(10).write.parquet(f"{tmp_path}/orders.parquet")
    assert table(spark, str(tmp_path), "orders").count() == 10
    spark.range(5).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert table(spark, str(tmp_path), "orders").count() == 15


def test_exact_quantiles_nan_is_above_all(spark):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN double('NaN') WHEN id % 3 = 1 THEN "
                                      "double('Infinity') ELSE id END AS x")
    got = {r.p: r.value for r in exact_quantiles(df, "x", [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    assert got[0.0] == 2.0 and got[0.1] == 2699.0 and got[0.5] == math.inf
    assert math.isnan(got[0.9]) and math.isnan(got[1.0])


def test_sketches_merge_by_levels(spark):
    from tessera.operators.quantiles import sketch_quantiles

    df = spark.range(0, 200_000, 1, 40).toDF("x")
    got = sketch_quantiles(df, "x", [0.1, 0.5, 0.9], 4e-4)
    assert all(abs(v / 200_000 - p) < 2e-3 for v, p in zip(got, (0.1, 0.5, 0.9)))
    assert sketch_quantiles(df.where("x < 0"), "x", [0.5], 4e-4) is None
