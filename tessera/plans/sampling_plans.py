"""Sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as K
from .frames import RIDES_SQL, rides
from .registry import query, table

_CUT_30 = int(0.3 * 2 ** 32)


@query("k1_seeded_bernoulli_sample", None, "K1")
def k1_seeded_bernoulli_sample(spark, d):
    return K.bernoulli_sample(table(spark, d, "lineitem"), 0.01, seed=12345)


@query("k2_unseeded_bernoulli_sample", None, "K2")
def k2_unseeded_bernoulli_sample(spark, d):
    return K.bernoulli_sample(table(spark, d, "lineitem"), 0.05)


@query("k3_seeded_random_split", None, "K3")
def k3_seeded_random_split(spark, d):
    return K.labelled_random_split(rides(spark, d), [0.7, 0.3], seed=12345)


@query("k4_unseeded_random_split", None, "K4")
def k4_unseeded_random_split(spark, d):
    return K.labelled_random_split(rides(spark, d), [0.7, 0.3])


@query("k5_hash_sample", f"""
SELECT * FROM orders WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < {int(0.1 * 2 ** 32)}""",
       "K5")
def k5_hash_sample(spark, d):
    return K.hash_sample(table(spark, d, "orders"), ["o_orderkey"], 0.1)


@query("k5_hash_split", f"""
SELECT id, CASE WHEN ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT < {_CUT_30} THEN 0 ELSE 1 END
       AS split
FROM {RIDES_SQL}""", "K5 K3")
def k5_hash_split(spark, d):
    first, rest = K.hash_split(rides(spark, d).select("id"), ["id"], 0.3)
    return first.withColumn("split", F.lit(0)).unionByName(rest.withColumn("split", F.lit(1)))


@query("k5_hash_sample_two_keys", f"""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT
      < {int(0.02 * 2 ** 32)}""", "K5")
def k5_hash_sample_two_keys(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return K.hash_sample(li, ["l_orderkey", "l_linenumber"], 0.02)


_NULL_KEY_SQL = "coalesce(CAST({} AS VARCHAR), chr(1) || 'null')"


@query("k5_hash_split_null_keys", f"""
SELECT id, CASE WHEN ('0x' || substr(md5({_NULL_KEY_SQL.format("CASE WHEN id % 10 <> 0 THEN id END")}), 1, 8))::BIGINT
       < {_CUT_30} THEN 0 ELSE 1 END AS split
FROM {RIDES_SQL}""", "K5 K3")
def k5_hash_split_null_keys(spark, d):
    keyed = rides(spark, d).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"))
    first, rest = K.hash_split(keyed, ["k"], 0.3)
    return first.select("id", F.lit(0).alias("split")).unionByName(rest.select("id", F.lit(1).alias("split")))


@query("k5_hash_split_two_nullable_keys", f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN ('0x' || substr(md5({_NULL_KEY_SQL.format("CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END")} || '|' ||
                                     {_NULL_KEY_SQL.format("CASE WHEN l_linenumber > 1 THEN l_linenumber END")}), 1, 8))::BIGINT
            < {_CUT_30} THEN 0 ELSE 1 END AS split
FROM lineitem""", "K5")
def k5_hash_split_two_nullable_keys(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")).alias("a"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("b"))
    parts = [p.select("l_orderkey", "l_linenumber", F.lit(i).alias("split"))
             for i, p in enumerate(K.hash_split(li, ["a", "b"], 0.3))]
    return parts[0].unionByName(parts[1])


_SAMPLE_SQL = """SELECT count(*) AS n_rows, true AS all_known, true AS no_repeats, true AS size_as_expected FROM orders"""


def _sample_checks(orders, sample, fraction):
    """Whether a Bernoulli sample is a subset without repeats, its size within five standard deviations."""
    both = orders.select("o_orderkey", F.lit(1).alias("base")).join(
        sample.select("o_orderkey", F.lit(1).alias("hit")), "o_orderkey", "full")
    n, hits = F.count("base"), F.count("hit")
    return both.agg(
        n.alias("n_rows"), F.bool_and(F.col("base").isNotNull()).alias("all_known"),
        (F.count_distinct(F.when(F.col("hit") == 1, F.col("o_orderkey"))) == hits).alias("no_repeats"),
        (F.abs(hits - n * fraction) <= 5 * F.sqrt(n * (fraction * (1 - fraction)))).alias("size_as_expected"))


@query("k1_seeded_sample_is_subset", _SAMPLE_SQL, "K1")
def k1_seeded_sample_is_subset(spark, d):
    orders = table(spark, d, "orders")
    return _sample_checks(orders, K.bernoulli_sample(orders, 0.1, seed=12345), 0.1)


@query("k2_unseeded_sample_is_subset", _SAMPLE_SQL, "K2")
def k2_unseeded_sample_is_subset(spark, d):
    orders = table(spark, d, "orders")
    return _sample_checks(orders, K.bernoulli_sample(orders, 0.05), 0.05)


_PARTITION_SQL = f"SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, 2 AS n_parts FROM {RIDES_SQL}"


def _split_totals(parts_df):
    return parts_df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
                        F.count_distinct("split").cast("int").alias("n_parts"))


@query("k3_seeded_split_is_partition", _PARTITION_SQL, "K3")
def k3_seeded_split_is_partition(spark, d):
    """The parts of a seeded random split cover every row exactly once."""
    return _split_totals(K.labelled_random_split(rides(spark, d), [0.7, 0.3], seed=12345))


@query("k4_unseeded_split_is_partition", _PARTITION_SQL, "K4")
def k4_unseeded_split_is_partition(spark, d):
    return _split_totals(K.labelled_random_split(rides(spark, d), [0.7, 0.3]))
