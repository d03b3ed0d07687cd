"""Tuning from sufficient statistics, recoverable grids, wide categories and
split gains (SURVEY §2.10, §2.11: M2, M3, M20-M24, M26).

With one feature the penalised fit has a closed form, so the whole tables of
metrics can be stated in SQL: the standardised slope is the soft-thresholded
correlation over the ridge-loaded variance.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..ml import categories as CA
from ..ml import crossproducts as CP
from ..ml import features as FE
from ..ml import grid_runs as GR
from ..ml import models as MO
from ..ml import splits as SP
from ..operators.sampling import HASH_SPACE, hash_unit
from ..session import scratch_path, stored
from .ml_plans import _FIVE_STAR_SQL, _HASH, _binary_data, _five_star, _lasso_data
from .registry import query, round_doubles, table

# ---- lasso, ridge and elastic net over a grid -------------------------------

REG_PARAMS = [0.0, 5.0, 20.0, 50.0, 200.0, 20000.0]
ELASTIC_NET_PARAMS = [0.0, 0.5, 1.0]
GRID = CP.grid(REG_PARAMS, ELASTIC_NET_PARAMS)
FOLDS = 3
_TRAIN_SHARE = 0.75
_CUT = int(_TRAIN_SHARE * HASH_SPACE)

_LINE_HASH = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT"
_POINTS_SQL = "(VALUES " + ", ".join(f"({i}, {p.reg_param}::DOUBLE, {p.elastic_net_param}::DOUBLE)"
                                     for i, p in enumerate(GRID)) + ") g(position, reg, alpha)"


def _statistics(source: str, group: str) -> str:
    return f"""SELECT {group} AS fold, count(*) AS n, avg(x) AS mx, avg(y) AS my, stddev_samp(x) AS sx, stddev_samp(y) AS sy,
        corr(x, y) AS r, var_pop(x) * count(*) AS sxx, var_pop(y) * count(*) AS syy, covar_pop(x, y) * count(*) AS sxy
    FROM {source} GROUP BY 1"""


def _slope(s: str) -> str:
    c = f"(({s}.n - 1) / {s}.n)"
    return (f"sign({s}.r) * greatest(abs({s}.r) * {c} - g.reg * g.alpha / {s}.sy, 0) "
            f"/ ({c} + g.reg * (1 - g.alpha) / {s}.sy) * {s}.sy / {s}.sx")


def _tuning_sql(fold: str, training: str, validate: str, metric: str, better: str) -> str:
    """``training``: (fold, x, y) rows from which the model validated on that fold is fitted."""
    return f"""
WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y, {fold} AS fold FROM lineitem),
tr AS ({_statistics(f"({training})", "fold")}),
va AS ({_statistics("t", "fold")}),
al AS ({_statistics("t", "0")}),
fitted AS (SELECT g.position, tr.fold, {_slope("tr")} AS b, tr.mx AS tx, tr.my AS ty FROM tr, {_POINTS_SQL}),
scored AS (SELECT f.position, (va.syy - 2 * f.b * va.sxy + f.b * f.b * va.sxx
                               + va.n * power(va.my - f.ty + f.b * f.tx - f.b * va.mx, 2)) AS sse, va.n, va.syy
           FROM fitted f JOIN va ON va.fold = f.fold WHERE f.fold IN ({validate})),
m AS (SELECT position, avg(sqrt(sse / n)) AS rmse, avg(1 - sse / syy) AS r2 FROM scored GROUP BY position),
w AS (SELECT g.position, g.reg, g.alpha, {_slope("al")} AS slope, al.mx, al.my FROM al, {_POINTS_SQL})
SELECT CAST(w.position AS INTEGER) AS position, w.reg AS reg_param, w.alpha AS elastic_net_param, true AS fit_intercept,
       round(m.rmse, 4) AS rmse, round(m.r2, 8) AS r2,
       w.position = first_value(w.position) OVER (ORDER BY round(m.{metric}, {4 if metric == "rmse" else 8}) {better}, w.position) AS is_best,
       round(w.my - w.slope * w.mx, 2) AS intercept, round(w.slope, 3) AS slope
FROM w JOIN m ON m.position = w.position"""


def _tuned(spark, d, fold, validate, metric):
    li = table(spark, d, "lineitem")
    out = CP.tune(li, ["l_quantity"], "l_extendedprice", GRID, fold, validate, metric)
    return out.select("position", "reg_param", "elastic_net_param", "fit_intercept", F.round("rmse", 4).alias("rmse"),
                      F.round("r2", 8).alias("r2"), "is_best", F.round("intercept", 2).alias("intercept"),
                      F.round(F.col("coefficients")[0], 3).alias("slope"))


@query("m22_m23_kfold_from_statistics",
       _tuning_sql(f"{_LINE_HASH} % {FOLDS}",
                   f"SELECT k.fold, t.x, t.y FROM t, (SELECT unnest(range({FOLDS})) AS fold) k WHERE t.fold <> k.fold",
                   ", ".join(map(str, range(FOLDS))), "rmse", "ASC"), "M20 M22 M23")
def m22_m23_kfold_from_statistics(spark, d):
    """Three folds by key hash, 18 points, two scans in all."""
    fold = hash_unit("l_orderkey", "l_linenumber") % FOLDS
    return _tuned(spark, d, fold, range(FOLDS), "rmse")


@query("m21_m23_holdout_from_statistics",
       _tuning_sql(f"CASE WHEN {_LINE_HASH} < {_CUT} THEN 0 ELSE 1 END", "SELECT 1 AS fold, x, y FROM t WHERE fold = 0", "1",
                   "rmse", "ASC"), "M20 M21 M23")
def m21_m23_holdout_from_statistics(spark, d):
    """Three quarters of the keys fit, the others measure; the models reported are those of all rows."""
    fold = F.when(hash_unit("l_orderkey", "l_linenumber") < F.lit(_CUT), 0).otherwise(1)
    return _tuned(spark, d, fold, (1,), "rmse")


@query("m22_lasso_path_many_features", None, "M9 M22 M23")
def m22_lasso_path_many_features(spark, d):
    """The lasso of the tuning queries, its six features, over 60 penalties: still two scans."""
    data = _lasso_data(spark, d)
    names = [f"x{i}" for i in range(6)]
    rows = data.select("id", "label", *FE.vector_columns(data, "features", 6, "x")).toDF("id", "label", *names)
    points = CP.grid([0.5 * 0.9 ** k for k in range(60)], [1.0])
    return round_doubles(CP.tune(rows, names, "label", points, hash_unit("id") % FOLDS, range(FOLDS)).drop("coefficients"), 9)


# ---- a grid of trees that can be resumed -------------------------------------

TREE_GRID = {"maxDepth": [1, 5, 10], "impurity": ["gini", "entropy"], "minInstancesPerNode": [1, 3, 10]}
_TREE_CUT = int(0.7 * HASH_SPACE)


@query("m24_recoverable_tree_grid", f"""
WITH t AS (SELECT id, reviewed, CAST(star_rating_double AS INTEGER) AS r, {_HASH} < {_TREE_CUT} AS train FROM {_FIVE_STAR_SQL}),
f AS (SELECT reviewed, r, count(*) AS n FROM t WHERE train GROUP BY 1, 2),
m AS (SELECT reviewed, arg_max(r, n * 10 - r) AS mode FROM f GROUP BY reviewed),
a AS (SELECT avg(CASE WHEN t.r = m.mode THEN 1.0 ELSE 0.0 END) AS accuracy, avg(CASE WHEN t.r = 5 THEN 1.0 ELSE 0.0 END) AS base
      FROM t JOIN m ON t.reviewed = m.reviewed WHERE NOT t.train),
p AS (SELECT CAST(row_number() OVER (ORDER BY d, i DESC, k) - 1 AS INTEGER) AS position, d, i, k
      FROM (SELECT unnest([1, 5, 10]) AS d), (SELECT unnest(['gini', 'entropy']) AS i), (SELECT unnest([1, 3, 10]) AS k))
SELECT position, CAST(d AS INTEGER) AS max_depth, i AS impurity, CAST(k AS INTEGER) AS min_instances,
       round(accuracy, 9) AS accuracy, round(base, 9) AS accuracy_baseline, position = 0 AS is_best
FROM p, a""", "M24 M20 M21 M23 M19")
def m24_recoverable_tree_grid(spark, d):
    """18 trees on one yes/no feature: whatever the setting, a leaf predicts its most frequent rating."""
    data = stored(FE.assemble(_five_star(spark, d), ["reviewed"], "features")
                  .select("id", "features", F.col("star_rating").cast("double").alias("label"),
                          (hash_unit("id") < F.lit(_TREE_CUT)).alias("train")), "grid-rows")
    train, test = data.where("train"), data.where("not train")

    def measure(p):
        model = MO.fit_classifier("tree", train, **p)
        hit = (F.col("prediction") == F.col("label")).cast("int")
        return model.transform(test).agg(F.avg(hit)).first()[0]

    runs = GR.run_grid(spark, GR.points_of(TREE_GRID), measure, scratch_path(spark, "grid"), f"{d} tree 0.7")
    best = GR.best_settings(runs)
    base = test.agg(F.avg((F.col("label") == 5.0).cast("int"))).first()[0]
    said = F.from_json("settings", "maxDepth int, impurity string, minInstancesPerNode int")
    is_best = F.lit(True)
    for name, value in best.items():
        is_best = is_best & (said.getField(name) == F.lit(value))
    return runs.select("position", said.maxDepth.alias("max_depth"), said.impurity.alias("impurity"),
                       said.minInstancesPerNode.alias("min_instances"), F.round("metric", 9).alias("accuracy"),
                       F.round(F.lit(base), 9).alias("accuracy_baseline"), is_best.alias("is_best"))


# ---- wide categories ----------------------------------------------------------

def _wide_sql(column: str) -> str:
    return f"""(SELECT {column} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS index
        FROM part GROUP BY {column})"""


@query("m2_wide_dictionary", f"SELECT value, n, index FROM {_wide_sql('p_name')}", "M2")
def m2_wide_dictionary(spark, d):
    """Dense indices of every part name, in the order in which the string indexer gives them."""
    return CA.category_dictionary(table(spark, d, "part"), "p_name")


@query("m2_wide_index", f"""
SELECT p.p_partkey, p.p_name, CAST(w.index AS DOUBLE) AS name_index FROM part p JOIN {_wide_sql('p_name')} w ON p.p_name = w.value""",
       "M2")
def m2_wide_index(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return CA.index_with(part, CA.category_dictionary(part, "p_name"), "p_name", "name_index")


@query("m3_wide_one_hot", f"""
SELECT p.p_partkey, CAST((SELECT count(DISTINCT p_brand) - 1 FROM part) AS INTEGER) AS size,
       CASE WHEN w.index < (SELECT count(DISTINCT p_brand) - 1 FROM part) THEN CAST(w.index AS INTEGER) END AS hot,
       CASE WHEN w.index < (SELECT count(DISTINCT p_brand) - 1 FROM part) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS total
FROM part p JOIN {_wide_sql('p_brand')} w ON p.p_brand = w.value""", "M3")
def m3_wide_one_hot(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    words = CA.category_dictionary(part, "p_brand")
    out = CA.one_hot_sparse(CA.index_with(part, words, "p_brand", "i"), "i", words.count(), "v")
    total = F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x)
    return out.select("p_partkey", F.col("v.size").alias("size"), F.get("v.indices", F.lit(0)).alias("hot"), total.alias("total"))


# ---- gains of candidate splits --------------------------------------------------

_RIDER_FLAGS = """(SELECT id, CASE WHEN totalprice > 250000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y,
    CAST(reviewed AS VARCHAR) AS reviewed, CAST(id % 3 = 0 AS VARCHAR) AS third, CAST(totalprice > 150000 AS VARCHAR) AS dear
    FROM (SELECT f.id, f.reviewed, r.o_totalprice AS totalprice FROM """ + _FIVE_STAR_SQL + """ f JOIN orders r ON r.o_orderkey = f.id))"""
_FLAGS = ["reviewed", "third", "dear"]


def _gains_sql() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, y FROM t" for c in _FLAGS)
    return f"""
WITH t AS {_RIDER_FLAGS},
u AS ({long}),
k AS (SELECT feature, value, count(*) AS n, sum(y) AS pos FROM u GROUP BY 1, 2),
a AS (SELECT feature, sum(n) AS n, sum(pos) AS pos FROM k GROUP BY 1),
s AS (SELECT k.feature, k.value, k.n AS nl, k.pos AS pl, a.n - k.n AS nr, a.pos - k.pos AS pr, a.n, a.pos FROM k JOIN a ON k.feature = a.feature),
g AS (SELECT feature, value, nl, nr, CASE WHEN nr = 0 THEN 0.0 ELSE
        2 * (pos / n) * (1 - pos / n) - nl / n * 2 * (pl / nl) * (1 - pl / nl) - nr / n * 2 * (pr / nr) * (1 - pr / nr) END AS gain FROM s)"""


def _flagged(spark, d):
    return _five_star(spark, d).select(
        "id", (F.col("totalprice") > 250000).cast("double").alias("label"), "reviewed", (F.col("id") % 3 == 0).alias("third"),
        (F.col("totalprice") > 150000).alias("dear"))


@query("m26_split_gains", f"""{_gains_sql()}
SELECT feature, value, CAST(nl AS DOUBLE) AS n_left, CAST(nr AS DOUBLE) AS n_right, round(gain, 9) AS gain FROM g""", "M26")
def m26_split_gains(spark, d):
    return round_doubles(SP.split_gains(_flagged(spark, d), _FLAGS, "label"), 9)


@query("m26_first_split_of_a_tree", f"""{_gains_sql()}
SELECT feature AS name, round(max(gain), 9) AS gain, 1.0::DOUBLE AS importance
FROM g GROUP BY feature ORDER BY max(gain) DESC LIMIT 1""", "M26 M11")
def m26_first_split_of_a_tree(spark, d):
    """Name, gain and importance of the one split of a depth-1 tree, from the fitted model."""
    data = FE.assemble(_flagged(spark, d), _FLAGS, "features")
    model = MO.fit_classifier("tree", data, maxDepth=1)
    top = MO.feature_importances(model, model.transform(data), "features", top=1)
    gain = float(model._call_java("rootNode").gain())
    return top.select("name", F.round(F.lit(gain), 9).alias("gain"), F.col("score").alias("importance"))
