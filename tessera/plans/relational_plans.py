"""Sorts, distinct, limits and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import haversine
from ..lifetimes import kept
from ..operators.joins import hot_keys, join_splitting_hot_keys, orders_enriched
from ..operators.relational import (
    frequency,
    group_by_expression,
    grouped_count_mean,
    label_by_feature,
    shares,
    sort_splittable,
)
from ..sources.inspect import head_rows
from .frames import FLIGHTS_SQL, RIDERS_SQL, RIDES_SQL, flights, riders, rides
from .registry import query, round_doubles, table


@query("a4_filter_group_sort", """
SELECT o_orderpriority, count(*) AS n_orders, round(avg(o_totalprice), 6) AS avg_totalprice
FROM orders WHERE o_orderstatus = 'F'
GROUP BY o_orderpriority ORDER BY avg_totalprice
""", "A4 O6")
def a4_filter_group_sort(spark, d):
    orders = table(spark, d, "orders")
    out = grouped_count_mean(orders.where(F.col("o_orderstatus") == "F"), "o_orderpriority",
                             "o_totalprice", count_name="n_orders", mean_name="avg_totalprice")
    return round_doubles(out).orderBy("avg_totalprice")


@query("a5_sql_group_sort", """
SELECT o_orderpriority, count(*) AS n_orders, round(avg(o_totalprice), 6) AS avg_totalprice
FROM orders WHERE o_orderstatus = 'F'
GROUP BY o_orderpriority ORDER BY avg_totalprice
""", "A5 S18 F15")
def a5_sql_group_sort(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("orders")
    return spark.sql("""
        SELECT o_orderpriority, count(*) AS n_orders, round(avg(o_totalprice), 6) AS avg_totalprice
        FROM orders WHERE o_orderstatus = 'F'
        GROUP BY o_orderpriority ORDER BY avg_totalprice""")


# ---- distinct, sorts, limits -----------------------------------------------

@query("o1_distinct_values", f"SELECT DISTINCT carrier FROM {FLIGHTS_SQL}", "O1")
def o1_distinct_values(spark, d):
    return flights(spark, d).select("carrier").distinct()


@query("o2_sort_ascending", f"SELECT id, month, day FROM {FLIGHTS_SQL} ORDER BY month, day", "O2")
def o2_sort_ascending(spark, d):
    return sort_splittable(flights(spark, d).select("id", "month", "day"), ["month", "day"], "id")


@query("o3_sort_descending", f"""
SELECT id, month, day FROM {FLIGHTS_SQL} ORDER BY month DESC, day DESC""", "O3")
def o3_sort_descending(spark, d):
    return sort_splittable(flights(spark, d).select("id", "month", "day"), ["month", "day"], "id",
                           ascending=False)


@query("o4_i1_limit_first_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5""", "O4 I1")
def o4_i1_limit_first_rows(spark, d):
    return head_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
                     5, "o_orderkey")


@query("o5_filter_sort_project_topk", f"""
SELECT id, carrier, arr_delay FROM {FLIGHTS_SQL} WHERE dest = 'F'
ORDER BY arr_delay DESC NULLS LAST, id LIMIT 10""", "O5")
def o5_filter_sort_project_topk(spark, d):
    return (flights(spark, d).filter(F.col("dest") == "F")
            .orderBy(F.desc_nulls_last("arr_delay"), F.asc("id"))
            .select("id", "carrier", "arr_delay").limit(10))


# ---- aggregates ------------------------------------------------------------

@query("a1_global_count", "SELECT count(*) AS n_rows FROM lineitem", "A1 I3")
def a1_global_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query("a2_p6_count_distinct", f"""
SELECT count(DISTINCT carrier) AS num_carriers, count(DISTINCT origin) AS num_origins FROM {FLIGHTS_SQL}""",
       "A2 P6")
def a2_p6_count_distinct(spark, d):
    return flights(spark, d).agg(F.count_distinct("carrier").alias("num_carriers"),
                                 F.count_distinct("origin").alias("num_origins"))


@query("a3_grouped_count_mean", f"""
SELECT origin, count(*) AS n_flights, round(avg(dep_delay), 6) AS avg_dep_delay,
       round(sum(dep_delay), 6) AS sum_dep_delay
FROM {FLIGHTS_SQL} GROUP BY origin""", "A3")
def a3_grouped_count_mean(spark, d):
    out = grouped_count_mean(flights(spark, d), "origin", "dep_delay", count_name="n_flights",
                             mean_name="avg_dep_delay", sum_name="sum_dep_delay")
    return round_doubles(out)


@query("a6_frequency_one_key", """
SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY c_mktsegment ORDER BY c_mktsegment""", "A6")
def a6_frequency_one_key(spark, d):
    return frequency(table(spark, d, "customer"), "c_mktsegment")


@query("a7_frequency_two_keys", f"""
SELECT student, sex, count(*) AS count FROM {RIDERS_SQL} GROUP BY student, sex ORDER BY student, sex""",
       "A7")
def a7_frequency_two_keys(spark, d):
    return frequency(riders(spark, d), "student", "sex")


@query("a8_grouped_moments", f"""
SELECT rider_student, count(distance) AS n_distance, round(avg(distance), 6) AS mean_distance,
       round(stddev_samp(distance), 6) AS sd_distance
FROM {RIDES_SQL} GROUP BY rider_student ORDER BY rider_student""", "A8")
def a8_grouped_moments(spark, d):
    out = (rides(spark, d).groupBy("rider_student")
           .agg(F.count("distance").alias("n_distance"), F.avg("distance").alias("mean_distance"),
                F.stddev("distance").alias("sd_distance")).orderBy("rider_student"))
    return round_doubles(out)


_HAV = """6372.8 * (2.0 * asin(sqrt(power(sin(radians(dest_lat - origin_lat) / 2.0), 2)
    + cos(radians(origin_lat)) * cos(radians(dest_lat)) * power(sin(radians(dest_lon - origin_lon) / 2.0), 2))))
    * 1000.0"""


@query("a13_group_by_boolean_expression", f"""
SELECT {_HAV} > distance AS haversine_gt_distance, count(*) AS count
FROM {RIDES_SQL} GROUP BY 1""", "A13 U4")
def a13_group_by_boolean_expression(spark, d):
    r = rides(spark, d)
    expr = haversine("origin_lat", "origin_lon", "dest_lat", "dest_lon") > F.col("distance")
    return group_by_expression(r, expr, "haversine_gt_distance")


@query("a14_rides_per_hour_native", """
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS count FROM events GROUP BY 1 ORDER BY 1""", "A14 X15")
def a14_rides_per_hour_native(spark, d):
    return (table(spark, d, "events").groupBy(F.hour("ts").alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("hour_of_day"))


@query("a16_label_by_feature", """
SELECT d.lang, count(*) AS n, round(avg(CAST(l.quality AS DOUBLE)), 6) AS mean_label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang ORDER BY d.lang""", "A16 V1 J1")
def a16_label_by_feature(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    labelled = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return round_doubles(label_by_feature(labelled, "lang", "quality"))


@query("a17_one_pass_shares", f"""
SELECT round(avg(CASE WHEN origin = 'R' THEN 1.0 ELSE 0.0 END), 9) AS share_returned,
       round(avg(CASE WHEN arr_delay > 0 THEN 1.0 ELSE 0.0 END), 9) AS share_late,
       round(avg(CASE WHEN dest = 'F' AND origin = 'A' THEN 1.0 ELSE 0.0 END), 9) AS share_af
FROM {FLIGHTS_SQL}""", "A17")
def a17_one_pass_shares(spark, d):
    f = flights(spark, d)
    return round_doubles(shares(f, share_returned=F.col("origin") == "R", share_late=F.col("arr_delay") > 0,
                                share_af=(F.col("dest") == "F") & (F.col("origin") == "A")), 9)


@query("j1_orders_enriched", """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment, n.n_name, r.r_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""", "J1")
def j1_orders_enriched(spark, d):
    j = orders_enriched(table(spark, d, "orders"), table(spark, d, "customer"),
                        table(spark, d, "nation"), table(spark, d, "region"))
    return j.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "n_name", "r_name")


@query("j1_orders_enriched_hot_key_split", """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment, n.n_name, r.r_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""", "J1")
def j1_orders_enriched_hot_key_split(spark, d):
    # customers holding at least 1% of all orders are salted
    j = orders_enriched(table(spark, d, "orders"), table(spark, d, "customer"),
                        table(spark, d, "nation"), table(spark, d, "region"), hot_key_share=0.01)
    return j.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "n_name", "r_name")


_HOT_THIRD = "CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN o_custkey END"


@query("j1_hot_third_null_rest_left_join", f"""
SELECT o.o_orderkey, o.k, c.c_name
FROM (SELECT o_orderkey, {_HOT_THIRD} AS k FROM orders) o LEFT JOIN customer c ON o.k = c.c_custkey""", "J1")
def j1_hot_third_null_rest_left_join(spark, d):
    """A third of the orders on one key, a third on none."""
    orders = table(spark, d, "orders").select("o_orderkey", F.expr(_HOT_THIRD).alias("k"))
    keys = hot_keys(orders, "k", 0.1)
    if keys != [1] and not orders.isEmpty():
        raise RuntimeError(f"one hot key expected, not {keys}")
    cust = table(spark, d, "customer").select("c_custkey", "c_name")
    return join_splitting_hot_keys(orders, cust, "k", "c_custkey", "left", keys=keys).drop("c_custkey")


@query("s19_persist_reused_result", f"""
SELECT 'by_origin' AS grouping, origin AS key, count(*) AS n FROM {FLIGHTS_SQL} WHERE arr_delay > 0 GROUP BY origin
UNION ALL
SELECT 'by_dest', dest, count(*) FROM {FLIGHTS_SQL} WHERE arr_delay > 0 GROUP BY dest""", "S19")
def s19_persist_reused_result(spark, d):
    late = kept(flights(spark, d).where(F.col("arr_delay") > 0).select("origin", "dest"))
    a = late.groupBy(F.col("origin").alias("key")).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("by_origin").alias("grouping"), "key", "n")
    b = late.groupBy(F.col("dest").alias("key")).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("by_dest").alias("grouping"), "key", "n")
    return a.unionByName(b)
