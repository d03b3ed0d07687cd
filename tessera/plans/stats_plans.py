"""Exploratory statistics and plot data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import plotdata as V
from ..operators import stats as S
from ..operators.quantiles import exact_quantiles
from .frames import RIDERS_SQL, RIDES_SQL, riders, rides
from .registry import query, round_doubles, table

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
_PROBS_SQL = "[" + ", ".join(str(p) for p in PROBS) + "]"


def _describe_sql(col: str) -> str:
    return (f"SELECT '{col}' AS \"column\", count({col}) AS count, round(avg({col}), 6) AS mean, "
            f"round(stddev_samp({col}), 6) AS stddev, min({col})::DOUBLE AS min, max({col})::DOUBLE AS max "
            f"FROM lineitem")


@query("i4_describe_typed", " UNION ALL ".join(_describe_sql(c) for c in
                                               ("l_quantity", "l_extendedprice", "l_discount")), "I4")
def i4_describe_typed(spark, d):
    return round_doubles(S.describe_typed(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice",
                                          "l_discount"))


@query("a9_shape_moments", f"""
WITH r AS {RIDES_SQL}, m AS (SELECT avg(distance) AS mu FROM r)
SELECT round(avg(power(distance - mu, 3)) / power(avg(power(distance - mu, 2)), 1.5), 9) AS skewness,
       round(kurtosis_pop(distance), 9) AS kurtosis
FROM r, m""", "A9")
def a9_shape_moments(spark, d):
    return round_doubles(S.shape_moments(rides(spark, d), "distance"), 9)


@query("a10_pair_moments", f"""
SELECT round(corr(distance, duration), 9) AS corr, round(covar_samp(distance, duration), 0) AS covar_samp,
       round(covar_pop(distance, duration), 0) AS covar_pop
FROM {RIDES_SQL}""", "A10")
def a10_pair_moments(spark, d):
    out = S.pair_moments(rides(spark, d), "distance", "duration")
    return out.select(F.round("corr", 9).alias("corr"), F.round("covar_samp", 0).alias("covar_samp"),
                      F.round("covar_pop", 0).alias("covar_pop"))


@query("a11_approx_quantiles", None, "A11")
def a11_approx_quantiles(spark, d):
    return S.approx_quantiles(rides(spark, d), "distance", PROBS, 0.1)


@query("a11_approx_quantiles_rank_bound", f"""
SELECT unnest({_PROBS_SQL}::DOUBLE[]) AS p, n, true AS within_bound
FROM (SELECT count(distance) AS n FROM {RIDES_SQL})""", "A11")
def a11_approx_quantiles_rank_bound(spark, d):
    """Whether each approximate quantile's rank is within 0.1 n of the asked one."""
    r = rides(spark, d).select("distance")
    found = S.approx_quantiles(r, "distance", PROBS, 0.1).collect()
    x, n = F.col("distance"), F.count("distance")
    checks = [F.struct(F.lit(q.p).alias("p"), n.alias("n"),
                       ((F.count_if(x < q.value) <= (q.p + 0.1) * n) & (F.count_if(x <= q.value) >= (q.p - 0.1) * n)
                        ).alias("within_bound")) for q in found]
    return r.agg(F.array(*checks).alias("checks")).select(F.explode("checks").alias("c")).select("c.*")


@query("a12_exact_quantiles", f"""
SELECT unnest({_PROBS_SQL}::DOUBLE[]) AS p, unnest(quantile_disc(l_extendedprice, {_PROBS_SQL})) AS value
FROM lineitem""", "A12")
def a12_exact_quantiles(spark, d):
    return exact_quantiles(table(spark, d, "lineitem"), "l_extendedprice", PROBS)


@query("a12_exact_quantiles_nullable", f"""
SELECT unnest({_PROBS_SQL}::DOUBLE[]) AS p, unnest(quantile_disc(distance, {_PROBS_SQL})) AS value
FROM {RIDES_SQL}""", "A12")
def a12_exact_quantiles_nullable(spark, d):
    return S.approx_quantiles(rides(spark, d), "distance", PROBS, 0.0)


@query("a15_typed_crosstab", """
SELECT l_returnflag AS l_returnflag_l_linestatus,
       count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
       count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY l_returnflag""", "A15")
def a15_typed_crosstab(spark, d):
    return S.typed_crosstab(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query("a18_squared_correlation", """
SELECT round(power(corr(l_quantity, l_extendedprice), 2), 9) AS r_squared FROM lineitem""", "A18")
def a18_squared_correlation(spark, d):
    return round_doubles(S.squared_correlation(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice"), 9)


SEGMENT_ORDER = ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]
HUE_ORDER = ["building", "automobile", "machinery", "household", "furniture", "missing"]


@query("v1_ordered_bar_counts", f"""
SELECT segment, coalesce(sex, 'missing') AS sex, count(*) AS count,
       CAST(coalesce(list_position({SEGMENT_ORDER!r}, segment), 0) AS BIGINT) AS position,
       CAST(coalesce(list_position({HUE_ORDER!r}, coalesce(sex, 'missing')), 0) AS BIGINT) AS hue_position
FROM {RIDERS_SQL} GROUP BY segment, coalesce(sex, 'missing')""", "V1")
def v1_ordered_bar_counts(spark, d):
    return V.ordered_counts(riders(spark, d), "segment", SEGMENT_ORDER, hue="sex", hue_order=HUE_ORDER)


def _bucket_sql(x: str, bins: int) -> str:
    return (f"CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor(({x} - lo) / (hi - lo) * {bins}) AS BIGINT) + 1, "
            f"{bins}) END")


@query("v2_histogram", f"""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT {_bucket_sql('l_extendedprice', 20)} AS bucket, count(*) AS count FROM lineitem, s GROUP BY 1)
SELECT bucket, round(lo + (bucket - 1) * ((hi - lo) / 20), 6) AS lower,
       round(lo + bucket * ((hi - lo) / 20), 6) AS upper, count FROM b, s""", "V2")
def v2_histogram(spark, d):
    return round_doubles(V.histogram(table(spark, d, "lineitem"), "l_extendedprice", 20))


_WITH_NAN_SQL = """(SELECT CASE WHEN l_orderkey % 10 = 0 THEN 'NaN'::DOUBLE WHEN l_orderkey % 10 = 1 THEN 'Infinity'::DOUBLE
  WHEN l_orderkey % 10 = 2 THEN NULL ELSE l_extendedprice END AS x FROM lineitem)"""


@query("v2_histogram_with_nan", f"""
WITH t AS {_WITH_NAN_SQL}, s AS (SELECT min(x) AS lo, max(x) AS hi FROM t WHERE isfinite(x)),
b AS (SELECT CASE WHEN NOT isfinite(x) THEN 0 ELSE {_bucket_sql('x', 20)} END AS bucket, count(*) AS count
      FROM t, s WHERE x IS NOT NULL GROUP BY 1)
SELECT bucket, CASE WHEN bucket > 0 THEN round(lo + (bucket - 1) * ((hi - lo) / 20), 6) END AS lower,
       CASE WHEN bucket > 0 THEN round(lo + bucket * ((hi - lo) / 20), 6) END AS upper, count FROM b, s""", "V2")
def v2_histogram_with_nan(spark, d):
    kind = F.col("l_orderkey") % 10
    x = (F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(float("inf")))
         .when(kind != 2, F.col("l_extendedprice")))
    return round_doubles(V.histogram(table(spark, d, "lineitem").select(x.alias("x")), "x", 20))


@query("v3_density_curve", f"""
WITH t AS (SELECT distance AS x FROM {RIDES_SQL} WHERE distance IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n, 1.06 * stddev_samp(x) * power(count(x), -0.2) AS h
      FROM t),
b AS (SELECT {_bucket_sql('x', 50)} AS bucket, count(*) AS c FROM t, s GROUP BY 1),
c AS (SELECT (lo + (bucket - 1) * ((hi - lo) / 50) + lo + bucket * ((hi - lo) / 50)) / 2 AS centre, c FROM b, s),
g AS (SELECT range AS point, lo + range * ((hi - lo) / 99) AS x FROM range(0, 100), s)
SELECT CAST(point AS INTEGER) AS point, round(x, 6) AS x,
       round(sum(c * exp(-0.5 * power((x - centre) / h, 2))) / (n * h * 2.5066282746310002), 12) AS density
FROM g, c, s GROUP BY point, x, n, h""", "V3")
def v3_density_curve(spark, d):
    out = V.density_curve(rides(spark, d), "distance", bins=50, grid=100)
    return out.select("point", F.round("x", 6).alias("x"), F.round("density", 12).alias("density"))


@query("v4_box_stats", f"""
WITH t AS (SELECT distance AS x FROM {RIDES_SQL} WHERE distance IS NOT NULL),
q AS (SELECT quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.5) AS median, quantile_disc(x, 0.75) AS q3 FROM t),
f AS (SELECT q1, median, q3, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
       round(min(x) FILTER (WHERE x >= lower_fence AND x <= upper_fence), 6) AS lower_whisker,
       round(max(x) FILTER (WHERE x >= lower_fence AND x <= upper_fence), 6) AS upper_whisker,
       count(x) FILTER (WHERE NOT (x >= lower_fence AND x <= upper_fence)) AS n_outliers
FROM t, f GROUP BY q1, median, q3, lower_fence, upper_fence""", "V4")
def v4_box_stats(spark, d):
    return round_doubles(V.box_stats(rides(spark, d), "distance"))


@query("v5_sample_points", f"""
SELECT id, distance, duration FROM {RIDES_SQL}
WHERE distance IS NOT NULL AND duration IS NOT NULL
  AND ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT < {int(0.05 * 2 ** 32)}""", "V5 K5 F12")
def v5_sample_points(spark, d):
    return V.sample_points(rides(spark, d), ["distance", "duration"], ["id"], 0.05)


@query("v6_linear_fit", f"""
SELECT round(regr_slope(duration, distance), 9) AS slope, round(regr_intercept(duration, distance), 6) AS intercept,
       round(regr_r2(duration, distance), 9) AS r2, CAST(regr_count(duration, distance) AS BIGINT) AS n
FROM {RIDES_SQL}""", "V6")
def v6_linear_fit(spark, d):
    out = V.linear_fit(rides(spark, d), "distance", "duration")
    return out.select(F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"),
                      F.round("r2", 9).alias("r2"), "n")


@query("v7_quadratic_fit", None, "V7")
def v7_quadratic_fit(spark, d):
    return V.quadratic_fit(rides(spark, d), "distance", "duration")


@query("v7_quadratic_fit_scaled", f"""
WITH t AS (SELECT distance / 1000 AS x, power(distance / 1000, 2) AS z, duration AS y FROM {RIDES_SQL}
           WHERE distance IS NOT NULL AND duration IS NOT NULL),
m AS (SELECT var_pop(x) AS xx, var_pop(z) AS zz, covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy,
             var_pop(y) AS yy, avg(x) AS mx, avg(z) AS mz, avg(y) AS my FROM t),
b AS (SELECT *, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2 FROM m)
SELECT round(my - b1 * mx - b2 * mz, 3) AS intercept, round(b1, 4) AS b1, round(b2, 5) AS b2,
       round((b1 * xy + b2 * zy) / yy, 6) AS r2 FROM b""", "V7")
def v7_quadratic_fit_scaled(spark, d):
    r = rides(spark, d).select((F.col("distance") / 1000).alias("x"), "duration")
    return V.quadratic_fit(r, "x", "duration").select(
        F.round("intercept", 3).alias("intercept"), F.round("b1", 4).alias("b1"), F.round("b2", 5).alias("b2"),
        F.round("r2", 6).alias("r2"))


_PAIR_COLS = ["distance", "duration", "ship_month"]


@query("v8_pair_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 9) AS corr FROM {RIDES_SQL}"
    for i, a in enumerate(_PAIR_COLS) for b in _PAIR_COLS[i + 1:]), "V8")
def v8_pair_correlations(spark, d):
    return round_doubles(S.all_pair_correlations(rides(spark, d), _PAIR_COLS), 9)


def _pair_grid_sql(cols, bins):
    clean = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    rng = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in cols)

    def bucket(c):
        return (f"CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE least(CAST(floor(({c} - lo_{c}) / (hi_{c} - lo_{c}) * {bins}) "
                f"AS BIGINT) + 1, {bins}) END")
    parts = [f"SELECT '{a}' AS x, '{b}' AS y, {bucket(a)} AS bx, {bucket(b)} AS \"by\" FROM t, s"
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    return (f"WITH t AS (SELECT {', '.join(cols)} FROM {RIDES_SQL} WHERE {clean}), s AS (SELECT {rng} FROM t) "
            f"SELECT x, y, bx, \"by\", count(*) AS count FROM ({' UNION ALL '.join(parts)}) GROUP BY x, y, bx, \"by\"")


@query("v8_pair_grid_counts", _pair_grid_sql(_PAIR_COLS, 10), "V8 V9")
def v8_pair_grid_counts(spark, d):
    return V.pair_grid_counts(rides(spark, d), _PAIR_COLS, 10)


@query("v9_binned_2d", f"""
WITH t AS (SELECT distance, duration FROM {RIDES_SQL} WHERE distance IS NOT NULL AND duration IS NOT NULL),
sx AS (SELECT min(distance) AS lo, max(distance) AS hi FROM t),
sy AS (SELECT min(duration) AS lo, max(duration) AS hi FROM t)
SELECT least(CAST(floor((distance - sx.lo) / (sx.hi - sx.lo) * 20) AS BIGINT) + 1, 20) AS bx,
       least(CAST(floor((duration - sy.lo) / (sy.hi - sy.lo) * 10) AS BIGINT) + 1, 10) AS by,
       count(*) AS count
FROM t, sx, sy WHERE distance IS NOT NULL AND duration IS NOT NULL GROUP BY 1, 2""", "V9")
def v9_binned_2d(spark, d):
    return V.binned_2d(rides(spark, d), "distance", "duration", 20, 10)
