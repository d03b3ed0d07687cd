"""Projections, filters and scalar functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.geo import haversine
from ..ml.pipelines import prepared_rows
from .frames import FLIGHTS_SQL, RATED_SQL, RIDERS_SQL, RIDES_SQL, flights, rated, riders, rides
from .registry import query, round_doubles, table

AS_OF = _dt.date(2026, 12, 1)  # fixed "today" for age queries


@query("p1_select_columns", "SELECT l_suppkey, l_partkey FROM lineitem", "P1")
def p1_select_columns(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", "l_partkey")


@query("p2_select_range", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders""", "P2")
def p2_select_range(spark, d):
    return C.select_range(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", "o_orderpriority")


@query("p3_x1_computed_alias", f"""
SELECT id, distance, round(distance / 1609.344::DOUBLE, 2) AS distance_in_miles FROM {RIDES_SQL}""",
       "P3 X1")
def p3_x1_computed_alias(spark, d):
    return rides(spark, d).select("id", "distance", C.metres_to_miles("distance").alias("distance_in_miles"))


@query("p4_x17_add_boolean_column", f"""
SELECT id, arr_delay, arr_delay <= 0 AS on_time FROM {FLIGHTS_SQL}""", "P4 X17")
def p4_x17_add_boolean_column(spark, d):
    return (flights(spark, d).withColumn("on_time", C.on_time("arr_delay"))
            .select("id", "arr_delay", "on_time"))


@query("p5_replace_column", f"""
SELECT id, round(distance / 1609.344::DOUBLE, 2) AS distance FROM {RIDES_SQL}""", "P5")
def p5_replace_column(spark, d):
    return rides(spark, d).withColumn("distance", C.metres_to_miles("distance")).select("id", "distance")


@query("p7_constant_columns", """
SELECT o_orderkey, 5.0::DOUBLE AS prediction_baseline, 'SFO' AS dest FROM orders""", "P7")
def p7_constant_columns(spark, d):
    return (table(spark, d, "orders").withColumn("prediction_baseline", F.lit(5.0))
            .withColumn("dest", F.lit("SFO")).select("o_orderkey", "prediction_baseline", "dest"))


@query("p8_sql_transformer_projection", f"""
SELECT id, review IS NOT NULL AS reviewed, CAST(star_rating AS DOUBLE) AS star_rating_double
FROM {RATED_SQL}""", "P8 X18")
def p8_sql_transformer_projection(spark, d):
    step = prepared_rows("true", {"reviewed": "isnotnull(review)", "star_rating_double": "double(star_rating)"})
    return step.transform(rated(spark, d)).select("id", "reviewed", "star_rating_double")


# ---- filters ---------------------------------------------------------------

_F1_SQL = f"SELECT id, carrier, origin, dest FROM {FLIGHTS_SQL} WHERE dest = 'F'"


@query("f1_filter_equality", _F1_SQL, "F1")
def f1_filter_equality(spark, d):
    return flights(spark, d).filter(F.col("dest") == F.lit("F")).select("id", "carrier", "origin", "dest")


@query("f2_where_equality", _F1_SQL, "F2")
def f2_where_equality(spark, d):
    return flights(spark, d).where(F.col("dest") == F.lit("F")).select("id", "carrier", "origin", "dest")


@query("f3_where_sql_string", _F1_SQL, "F3")
def f3_where_sql_string(spark, d):
    return flights(spark, d).where("dest = 'F'").select("id", "carrier", "origin", "dest")


@query("f4_predefined_predicate", f"""
SELECT id, student, student = 1 AS student_boolean FROM {RIDERS_SQL} WHERE student = 1""", "F4 X3")
def f4_predefined_predicate(spark, d):
    student = C.flag_is_one("student")
    return (riders(spark, d).withColumn("student_boolean", student).filter(student)
            .select("id", "student", "student_boolean"))


@query("f5_and_or_three_valued", f"""
SELECT id, student, sex,
       (student = 1) AND (sex = 'machinery') AS student_and_male,
       (student = 1) OR (sex = 'machinery') AS student_or_male
FROM {RIDERS_SQL}""", "F5")
def f5_and_or_three_valued(spark, d):
    student, male = C.flag_is_one("student"), F.col("sex") == "machinery"
    return riders(spark, d).select("id", "student", "sex", (student & male).alias("student_and_male"),
                                   (student | male).alias("student_or_male"))


_F6_SQL = f"SELECT id, student, sex FROM {RIDERS_SQL} WHERE sex = 'machinery' AND student = 1"


@query("f6_and_filter", _F6_SQL, "F6")
def f6_and_filter(spark, d):
    male, student = F.col("sex") == "machinery", C.flag_is_one("student")
    return riders(spark, d).filter(male & student).select("id", "student", "sex")


@query("f6_chained_filters", _F6_SQL, "F6")
def f6_chained_filters(spark, d):
    return (riders(spark, d).filter(F.col("sex") == "machinery").filter(C.flag_is_one("student"))
            .select("id", "student", "sex"))


@query("f7_or_filter", f"""
SELECT id, student, sex FROM {RIDERS_SQL} WHERE sex = 'machinery' OR student = 1""", "F7")
def f7_or_filter(spark, d):
    return (riders(spark, d).filter((F.col("sex") == "machinery") | C.flag_is_one("student"))
            .select("id", "student", "sex"))


@query("f8_not_equal_distinct", f"""
SELECT DISTINCT sex FROM {RIDERS_SQL} WHERE sex <> 'machinery'""", "F8 O1")
def f8_not_equal_distinct(spark, d):
    return riders(spark, d).filter(F.col("sex") != "machinery").select("sex").distinct()


@query("f8_not_equal_keep_null_distinct", f"""
SELECT DISTINCT sex FROM {RIDERS_SQL} WHERE sex IS DISTINCT FROM 'machinery'""", "F8")
def f8_not_equal_keep_null_distinct(spark, d):
    return riders(spark, d).filter(C.not_equal_keep_null("sex", "machinery")).select("sex").distinct()


@query("f9_range_two_columns", f"""
SELECT id, dep_delay, arr_delay FROM {FLIGHTS_SQL} WHERE dep_delay < 20 AND arr_delay < 30""", "F9")
def f9_range_two_columns(spark, d):
    return (flights(spark, d).filter((F.col("dep_delay") < 20) & (F.col("arr_delay") < 30))
            .select("id", "dep_delay", "arr_delay"))


_HAV_SQL = """6372.8 * (2.0 * asin(sqrt(power(sin(radians(dest_lat - origin_lat) / 2.0), 2)
    + cos(radians(origin_lat)) * cos(radians(dest_lat)) * power(sin(radians(dest_lon - origin_lon) / 2.0), 2))))
    * 1000.0"""


@query("f10_column_comparison", f"""
SELECT id, distance, round({_HAV_SQL}, 2) AS haversine_approximation
FROM {RIDES_SQL} WHERE {_HAV_SQL} > distance""", "F10")
def f10_column_comparison(spark, d):
    r = rides(spark, d).withColumn(
        "haversine_approximation", haversine("origin_lat", "origin_lon", "dest_lat", "dest_lon"))
    return round_doubles(r.filter(F.col("haversine_approximation") > F.col("distance"))
                         .select("id", "distance", "haversine_approximation"), 2)


@query("f11_sql_transformer_filter", f"""
SELECT id, cancelled, star_rating FROM {RATED_SQL} WHERE cancelled = 0""", "F11")
def f11_sql_transformer_filter(spark, d):
    return prepared_rows("NOT boolean(cancelled)", {}).transform(rated(spark, d)).select("id", "cancelled", "star_rating")


@query("f12_drop_any_null", f"""
SELECT * FROM {FLIGHTS_SQL}
WHERE id IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL
  AND carrier IS NOT NULL AND flight IS NOT NULL AND origin IS NOT NULL AND dest IS NOT NULL
  AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL AND distance IS NOT NULL""", "F12")
def f12_drop_any_null(spark, d):
    return flights(spark, d).dropna(how="any")


@query("f13_fill_missing_label", f"""
SELECT student, coalesce(sex, 'missing') AS sex, count(*) AS count
FROM {RIDERS_SQL} GROUP BY student, sex""", "F13 A7")
def f13_fill_missing_label(spark, d):
    counts = riders(spark, d).groupBy("student", "sex").agg(F.count(F.lit(1)).alias("count"))
    return counts.fillna("missing")


@query("f14_null_flag", f"""
SELECT id, CAST(review IS NOT NULL AS INTEGER) AS reviewed FROM {RATED_SQL}""", "F14")
def f14_null_flag(spark, d):
    return rated(spark, d).select("id", C.null_flag("review").alias("reviewed"))


@query("f15_sql_where_on_view", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'""", "F15 S18")
def f15_sql_where_on_view(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")


# ---- scalar functions ------------------------------------------------------

@query("x2_zero_padded_id", f"""
SELECT id, CASE WHEN flight IS NULL THEN NULL ELSE lpad(CAST(id AS VARCHAR), 10, '0') END AS id_fixed
FROM {FLIGHTS_SQL}""", "X2")
def x2_zero_padded_id(spark, d):
    f = flights(spark, d)
    padded = C.zero_pad(F.when(F.col("flight").isNotNull(), F.col("id")))
    return f.select("id", padded.alias("id_fixed"))


@query("x3_x4_flag_to_boolean", f"""
SELECT id, student, student = 1 AS student_by_compare, CAST(student AS BOOLEAN) AS student_by_cast
FROM {RIDERS_SQL}""", "X3 X4")
def x3_x4_flag_to_boolean(spark, d):
    return riders(spark, d).select("id", "student", C.flag_is_one("student").alias("student_by_compare"),
                                   C.flag_as_boolean("student").alias("student_by_cast"))


@query("x5_trim_upper", f"""
SELECT id, ' ' || sex || '  ' AS raw_sex, upper(trim(' ' || sex || '  ')) AS gender FROM {RIDERS_SQL}""",
       "X5")
def x5_trim_upper(spark, d):
    raw = F.concat(F.lit(" "), F.col("sex"), F.lit("  "))
    return riders(spark, d).select("id", raw.alias("raw_sex"), C.normalise_label(raw).alias("gender"))


@query("x6_x7_block_group", f"""
SELECT id, home_block, substr(home_block, 1, 12) AS by_substring,
       regexp_extract(home_block, '^(\\d{{12}}).*', 1) AS by_regex
FROM {RIDERS_SQL}""", "X6 X7")
def x6_x7_block_group(spark, d):
    return riders(spark, d).select("id", "home_block", C.block_group("home_block").alias("by_substring"),
                                   C.block_group_regex("home_block").alias("by_regex"))


@query("x9_x10_timestamp_to_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS by_cast, CAST(o_orderdate AS DATE) AS by_function
FROM orders""", "X9 X10")
def x9_x10_timestamp_to_date(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", C.to_date_by_cast("o_orderdate").alias("by_cast"),
                    C.to_date_by_function("o_orderdate").alias("by_function"))


_RIDE_TEXT_SQL = """(SELECT event_id,
    CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS date_time
  FROM events)"""


@query("x11_x12_string_to_timestamp", f"""
SELECT event_id, date_time,
       CAST(TRY_CAST(date_time AS TIMESTAMP) AS VARCHAR) AS by_cast,
       CAST(try_strptime(date_time, '%Y-%m-%d %H:%M') AS VARCHAR) AS by_format
FROM {_RIDE_TEXT_SQL}""", "X11 X12")
def x11_x12_string_to_timestamp(spark, d):
    ev = table(spark, d, "events")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    t = ev.select("event_id", text.alias("date_time"))
    return t.select("event_id", "date_time",
                    C.to_timestamp_by_cast("date_time").cast("string").alias("by_cast"),
                    C.to_timestamp_with_format("date_time").cast("string").alias("by_format"))


@query("x13_x14_age_in_years", f"""
SELECT o_orderkey, CAST(floor((
    (year(DATE '{AS_OF}') - year(o_orderdate)) * 12 + (month(DATE '{AS_OF}') - month(o_orderdate))
    + CASE WHEN day(DATE '{AS_OF}') = day(o_orderdate)
             OR (DATE '{AS_OF}' = last_day(DATE '{AS_OF}') AND CAST(o_orderdate AS DATE) = last_day(o_orderdate))
           THEN 0 ELSE (day(DATE '{AS_OF}') - day(o_orderdate)) / 31.0 END) / 12) AS BIGINT) AS age
FROM orders""", "X13 X14")
def x13_x14_age_in_years(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", C.age_in_years("o_orderdate", F.lit(AS_OF)).cast("long").alias("age"))


@query("x13_age_today", """
SELECT o_orderkey, true AS same_as_at_current_date, true AS not_negative FROM orders""", "X13 X14")
def x13_age_today(spark, d):
    """The age without a date is the age at the session's current date."""
    today = C.age_in_years("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", (today == C.age_in_years("o_orderdate", F.current_date())).alias("same_as_at_current_date"),
        (today >= 0).alias("not_negative"))


@query("x15_hour_of_timestamp", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day FROM events", "X15")
def x15_hour_of_timestamp(spark, d):
    return table(spark, d, "events").select("event_id", C.hour_of_day("ts").alias("hour_of_day"))


@query("x16_concat_null", f"""
SELECT id, carrier || CAST(flight AS VARCHAR) AS carrier_flight FROM {FLIGHTS_SQL}""", "X16")
def x16_concat_null(spark, d):
    return flights(spark, d).select("id", C.concat_key("carrier", "flight").alias("carrier_flight"))


@query("x18_casts", f"""
SELECT id, CAST(star_rating AS DOUBLE) AS star_rating_double, CAST(trunc(totalprice) AS INTEGER) AS price_int,
       CAST(review IS NOT NULL AS INTEGER) AS reviewed
FROM {RATED_SQL}""", "X18")
def x18_casts(spark, d):
    r = rated(spark, d)
    return r.select("id", F.col("star_rating").cast("double").alias("star_rating_double"),
                    F.col("totalprice").cast("int").alias("price_int"),
                    F.col("review").isNotNull().cast("int").alias("reviewed"))


@query("x19_haversine_native", f"""
SELECT id, round({_HAV_SQL}, 2) AS haversine_approximation FROM {RIDES_SQL}""", "X19 U2")
def x19_haversine_native(spark, d):
    r = rides(spark, d)
    return round_doubles(r.select(
        "id", haversine("origin_lat", "origin_lon", "dest_lat", "dest_lon").alias("haversine_approximation")), 2)
