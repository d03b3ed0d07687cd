"""UDF paths and the arrival-time rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scoring import predicted_arrival_hhmm
from ..functions.udfs import haversine_arrow_udf, haversine_udf, hour_of_day_arrow_udf, hour_of_day_udf
from .frames import RIDES_SQL, rides
from .registry import query, round_doubles, table

_HAV = """6372.8 * (2.0 * asin(sqrt(power(sin(radians(dest_lat - origin_lat) / 2.0), 2)
    + cos(radians(origin_lat)) * cos(radians(dest_lat)) * power(sin(radians(dest_lon - origin_lon) / 2.0), 2))))
    * 1000.0"""
_HOURS_SQL = "SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS count FROM events GROUP BY 1 ORDER BY 1"


@query("u1_rides_per_hour_pandas_udf", _HOURS_SQL, "U1 U3 A14")
def u1_rides_per_hour_pandas_udf(spark, d):
    return (table(spark, d, "events").select(hour_of_day_udf("ts").alias("hour_of_day"))
            .groupBy("hour_of_day").count().orderBy("hour_of_day"))


# the queries registered as row UDFs keep their names; no function gets single rows any more
@query("u1_rides_per_hour_row_udf", _HOURS_SQL, "U1")
@query("u1_rides_per_hour_arrow_udf", _HOURS_SQL, "U1 U3")
def u1_rides_per_hour_arrow_udf(spark, d):
    return (table(spark, d, "events").select(hour_of_day_arrow_udf("ts").alias("hour_of_day"))
            .groupBy("hour_of_day").count().orderBy("hour_of_day"))


@query("u2_haversine_pandas_udf", f"""
SELECT id, round({_HAV}, 2) AS haversine_approximation FROM {RIDES_SQL}""", "U2 U3")
def u2_haversine_pandas_udf(spark, d):
    r = rides(spark, d)
    return round_doubles(r.select("id", haversine_udf("origin_lat", "origin_lon", "dest_lat", "dest_lon")
                                  .alias("haversine_approximation")), 2)


_DISTANCES_SQL = f"SELECT id, round({_HAV}, 2) AS haversine_approximation FROM {RIDES_SQL}"


@query("u2_haversine_row_udf", _DISTANCES_SQL, "U2")
@query("u2_haversine_arrow_udf", _DISTANCES_SQL, "U2 U3")
def u2_haversine_arrow_udf(spark, d):
    r = rides(spark, d)
    return round_doubles(r.select("id", haversine_arrow_udf("origin_lat", "origin_lon", "dest_lat", "dest_lon")
                                  .alias("haversine_approximation")), 2)


@query("u4_udf_result_vs_recorded", f"""
SELECT {_HAV} > distance AS haversine_gt_distance, count(*) AS count FROM {RIDES_SQL} GROUP BY 1""", "U4")
def u4_udf_result_vs_recorded(spark, d):
    r = rides(spark, d).withColumn(
        "haversine_approximation", haversine_udf("origin_lat", "origin_lon", "dest_lat", "dest_lon"))
    return (r.select((F.col("haversine_approximation") > F.col("distance")).alias("haversine_gt_distance"))
            .groupBy("haversine_gt_distance").count())


# scheduled arrival (hhmm, hour may be 24 to test carry-over) and departure delay from lineitem
_SCHED = "(l_partkey % 25) * 100 + l_suppkey % 60"
_DELAY = "l_quantity * 3 - 30 + l_discount"
M27_SQL = f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {_SCHED} AS sched_arr_time, {_DELAY} AS dep_delay FROM lineitem),
u AS (SELECT *, floor(((floor(sched_arr_time / 100) * 60 + sched_arr_time % 100) * 60000000
                       + CAST(round_even((dep_delay * 1.02 - 5.9) * 60000000, 0) AS BIGINT)) / 60000000) AS total_min
      FROM t),
v AS (SELECT *, ((total_min % 1440) + 1440) % 1440 AS clock FROM u)
SELECT l_orderkey, l_linenumber, sched_arr_time, dep_delay,
       CAST(floor(clock / 60) * 100 + clock % 60 AS INTEGER) AS pred_arr_time
FROM v"""


def m27_input(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     ((F.col("l_partkey") % 25) * 100 + F.col("l_suppkey") % 60).alias("sched_arr_time"),
                     (F.col("l_quantity") * 3 - 30 + F.col("l_discount")).alias("dep_delay"))


@query("m27_arrival_time_rule", M27_SQL, "M27")
def m27_arrival_time_rule(spark, d):
    return m27_input(spark, d).withColumn(
        "pred_arr_time", predicted_arrival_hhmm("sched_arr_time", "dep_delay"))


@query("m27_stream_scoring", M27_SQL, "M27")
def m27_stream_scoring(spark, d):
    from ..session import scratch_path
    from ..streaming.scoring import start_scoring

    requests = m27_input(spark, d)
    source, sink, ckpt = (scratch_path(spark, p) for p in ("requests", "scored", "stream-checkpoint"))
    requests.write.parquet(source)
    q = start_scoring(spark, source, requests.schema, sink, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"scoring stream failed: {q.exception()}")
    return spark.read.parquet(sink)
