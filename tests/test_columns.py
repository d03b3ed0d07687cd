import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.functions.geo import haversine, haversine_numpy
from tessera.functions.scoring import predicted_arrival_hhmm


def test_haversine_known_answer(spark):
    df = spark.createDataFrame([(36.12, -86.67, 33.94, -118.40), (None, 1.0, 2.0, 3.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(2887259.9506071107, abs=1e-6)
    assert got[1] is None
    assert haversine_numpy(36.12, -86.67, 33.94, -118.40) == pytest.approx(2887259.9506071107, abs=1e-6)


def test_arrival_rule_known_answer(spark):
    df = spark.createDataFrame([(724, 43.0)], "s int, d double")
    assert df.select(predicted_arrival_hhmm("s", "d")).first()[0] == 801


def test_arrival_rule_across_midnight(spark):
    cases = [(0, 0.0, 2354), (1, -30.5, 2323), (59, 5.78, 58), (2359, 43.0, 36), (2300, 180.25, 157)]
    cases += [(2345, 1500.0, 109), (100, -120.0, 2251), (1159, 0.1, 1153), (724, 43.0, 801)]
    df = spark.createDataFrame(cases, "s int, d double, want int")
    assert [r.want for r in df.collect()] == [r.p for r in df.select(predicted_arrival_hhmm("s", "d").alias("p")).collect()]


def test_arrival_rule_null_in_null_out(spark):
    df = spark.createDataFrame([(None, 1.0), (700, None)], "s int, d double")
    assert [r[0] for r in df.select(predicted_arrival_hhmm("s", "d")).collect()] == [None, None]


def test_three_valued_logic(spark):
    df = spark.createDataFrame([(True, None), (False, None)], "a boolean, b boolean")
    rows = df.select((F.col("a") & F.col("b")).alias("and_"), (F.col("a") | F.col("b")).alias("or_")).collect()
    assert (rows[0].and_, rows[0].or_) == (None, True)
    assert (rows[1].and_, rows[1].or_) == (False, None)


def test_not_equal_drops_null_and_null_safe_keeps_it(spark):
    df = spark.createDataFrame([("male",), ("female",), (None,)], "sex string")
    plain = {r.sex for r in df.filter(F.col("sex") != "male").collect()}
    safe = {r.sex for r in df.filter(C.not_equal_keep_null("sex", "male")).collect()}
    assert plain == {"female"} and safe == {"female", None}


def test_zero_pad_keeps_null(spark):
    df = spark.createDataFrame([(42,), (None,)], "id int")
    assert [r[0] for r in df.select(C.zero_pad("id")).collect()] == ["0000000042", None]


def test_block_group_regex_and_substring(spark):
    df = spark.createDataFrame([("123456789012345",), ("B12345678901234",), (None,)], "b string")
    rows = df.select(C.block_group("b").alias("s"), C.block_group_regex("b").alias("r")).collect()
    assert rows[0].s == rows[0].r == "123456789012"
    assert rows[1].r == "" and rows[1].s == "B12345678901"
    assert rows[2].s is None and rows[2].r is None


def test_log_request(spark):
    df = spark.createDataFrame([('1.2.3.4 - - [x] "GET /a?b=1 HTTP/1.1" 200 5',), ('x "POST /a" 200',)], "v string")
    assert [r[0] for r in df.select(C.log_request("v")).collect()] == ["GET /a?b=1 HTTP/1.1", ""]


def test_timestamp_parsing_bad_text_is_null(spark):
    df = spark.createDataFrame([("2017-02-01 00:14",), ("n/a",), (None,)], "t string")
    rows = df.select(C.to_timestamp_with_format("t").alias("f"), C.to_timestamp_by_cast("t").alias("c")).collect()
    assert rows[0].f == dt.datetime(2017, 2, 1, 0, 14) and rows[0].c == dt.datetime(2017, 2, 1, 0, 14)
    assert rows[1].f is None and rows[1].c is None and rows[2].f is None


def test_age_in_years_birthday_boundary(spark):
    df = spark.createDataFrame([(dt.date(2000, 6, 15),)], "b date")
    before = df.select(C.age_in_years("b", F.lit(dt.date(2026, 6, 14)))).first()[0]
    on = df.select(C.age_in_years("b", F.lit(dt.date(2026, 6, 15)))).first()[0]
    assert (before, on) == (25, 26)


def test_concat_null_and_on_time(spark):
    df = spark.createDataFrame([("AA", 1, -3.0), ("UA", None, 2.0), ("DL", 7, None)], "c string, f int, d double")
    rows = df.select(C.concat_key("c", "f").alias("k"), C.on_time("d").alias("o")).collect()
    assert [r.k for r in rows] == ["AA1", None, "DL7"]
    assert [r.o for r in rows] == [True, False, None]


def test_share_true_counts_null_as_false(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,), (2.0,)], "x double")
    assert df.agg(C.share_true(F.col("x") > 0)).first()[0] == pytest.approx(0.5)


def test_select_range(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "year int, month int, day int, a int, b int")
    assert C.select_range(df, "year", "day", "b").columns == ["year", "month", "day", "b"]


def test_metres_to_miles(spark):
    df = spark.createDataFrame([(1609.344,), (None,)], "m double")
    assert [r[0] for r in df.select(C.metres_to_miles("m")).collect()] == [1.0, None]
    assert math.isclose(C.METRES_PER_MILE, 1609.344)


def test_arrival_rule_carries_over_hour_24_and_minute_overflow(spark):
    # 24:30 minus 5.9 minutes is 00:24 the next day; 07:75 is read as 08:15
    df = spark.createDataFrame([(2430, 0.0), (775, 0.0)], "s int, d double")
    got = [r[0] for r in df.select(predicted_arrival_hhmm("s", "d")).collect()]
    assert got == [24, 809]
