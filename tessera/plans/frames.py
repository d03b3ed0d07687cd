"""The reference's input tables, derived from the test tables.

The reference works on flights, rides and riders tables; the test data is a
TPC-H-like schema without nulls.  Each frame below is a column mapping over
one test table, with nulls made by ``CASE WHEN`` so null rules are
exercised.  Every frame has a Spark form and the same mapping as a DuckDB
subquery (``*_SQL``) for the oracles.
"""

from __future__ import annotations

from .registry import table

# flights ↔ lineitem: carrier, flight, origin, dest, delays, date parts.
FLIGHTS_SQL = """(SELECT
    l_orderkey * 10 + l_linenumber AS id,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
    CAST(day(l_shipdate) AS INTEGER) AS day,
    'C' || CAST(l_suppkey % 16 AS VARCHAR) AS carrier,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS flight,
    l_returnflag AS origin, l_linestatus AS dest,
    CASE WHEN l_quantity >= 49 THEN NULL ELSE l_quantity - 20 END AS dep_delay,
    CASE WHEN l_tax = 0.08 THEN NULL ELSE l_extendedprice / 1000 - 50 END AS arr_delay,
    l_extendedprice / 100 AS distance
  FROM lineitem)"""


def flights(spark, d):
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "year(l_shipdate) AS year", "month(l_shipdate) AS month", "dayofmonth(l_shipdate) AS day",
        "concat('C', CAST(l_suppkey % 16 AS STRING)) AS carrier",
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS flight",
        "l_returnflag AS origin", "l_linestatus AS dest",
        "CASE WHEN l_quantity >= 49 THEN NULL ELSE l_quantity - 20 END AS dep_delay",
        "CASE WHEN l_tax = 0.08D THEN NULL ELSE l_extendedprice / 1000 - 50 END AS arr_delay",
        "l_extendedprice / 100 AS distance",
    )


# rides ↔ lineitem: coordinates made from keys, distance null when cancelled.
RIDES_SQL = """(SELECT
    l_orderkey * 10 + l_linenumber AS id,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS distance,
    l_quantity * 60 AS duration,
    CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_orderkey % 2 END AS rider_student,
    month(l_shipdate) AS ship_month,
    l_partkey % 180 - 90 + l_discount AS origin_lat,
    l_suppkey % 360 - 180 + l_tax AS origin_lon,
    l_orderkey % 170 - 85 + l_discount AS dest_lat,
    (l_partkey + l_suppkey) % 360 - 180 - l_tax AS dest_lon
  FROM lineitem)"""


def rides(spark, d):
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled",
        "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS distance",
        "l_quantity * 60 AS duration",
        "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_orderkey % 2 END AS rider_student",
        "month(l_shipdate) AS ship_month",
        "l_partkey % 180 - 90 + l_discount AS origin_lat",
        "l_suppkey % 360 - 180 + l_tax AS origin_lon",
        "l_orderkey % 170 - 85 + l_discount AS dest_lat",
        "(l_partkey + l_suppkey) % 360 - 180 - l_tax AS dest_lon",
    )


# riders ↔ customer: sex, student flag, census block code; nulls by nation.
RIDERS_SQL = """(SELECT
    c_custkey AS id,
    CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE lower(c_mktsegment) END AS sex,
    CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(c_custkey % 2 AS INTEGER) END AS student,
    CASE WHEN c_nationkey % 5 = 0 THEN 'B' || lpad(CAST(c_custkey * 7919 AS VARCHAR), 14, '0')
         ELSE lpad(CAST(c_custkey * 7919 + 100000000000 AS VARCHAR), 15, '0') END AS home_block,
    c_mktsegment AS segment, c_nationkey AS nationkey
  FROM customer)"""


def riders(spark, d):
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE lower(c_mktsegment) END AS sex",
        "CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(c_custkey % 2 AS INT) END AS student",
        "CASE WHEN c_nationkey % 5 = 0 THEN concat('B', lpad(CAST(c_custkey * 7919 AS STRING), 14, '0')) "
        "ELSE lpad(CAST(c_custkey * 7919 + 100000000000 AS STRING), 15, '0') END AS home_block",
        "c_mktsegment AS segment", "c_nationkey AS nationkey",
    )


# rated orders ↔ orders: cancelled, star rating 1-5, nullable review text.
RATED_SQL = """(SELECT
    o_orderkey AS id,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS cancelled,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS star_rating,
    CASE WHEN o_totalprice > 200000 THEN o_orderpriority ELSE NULL END AS review,
    o_totalprice AS totalprice, o_custkey AS custkey
  FROM orders)"""


def rated(spark, d):
    return table(spark, d, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS cancelled",
        "CAST(substr(o_orderpriority, 1, 1) AS INT) AS star_rating",
        "CASE WHEN o_totalprice > 200000 THEN o_orderpriority ELSE NULL END AS review",
        "o_totalprice AS totalprice", "o_custkey AS custkey",
    )
