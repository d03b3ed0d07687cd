"""Joins: dimension tables, and equi-joins with hot keys.

Whether a side is broadcast is left to the planner, which compares its size in
bytes with ``spark.sql.autoBroadcastJoinThreshold`` (from file sizes when
planning, from shuffle output when adaptive execution replans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join with a table that is usually small; broadcast only if its bytes allow."""
    return fact.join(dim, on, how)


def orders_enriched(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                    region: DataFrame, how: str = "inner", hot_key_share: float | None = None) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region: one wide row per order.

    orders ⋈ customer is a fact-to-fact join (both grow with the data) and
    shuffles on the customer key; with ``hot_key_share`` customers holding at
    least that share of orders are split off and salted.
    """
    geo = join_dimension(
        nation.select("n_nationkey", "n_name", "n_regionkey"),
        region.select("r_regionkey", "r_name"),
        F.col("n_regionkey") == F.col("r_regionkey"), how)
    cust = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    if hot_key_share:
        joined = join_splitting_hot_keys(orders, cust, "o_custkey", "c_custkey", how, hot_key_share)
    else:
        joined = orders.join(cust, orders["o_custkey"] == cust["c_custkey"], how)
    return join_dimension(joined, geo, F.col("c_nationkey") == F.col("n_nationkey"), how)


def hot_keys(df: DataFrame, key: str, min_share: float) -> list:
    """Non-null keys holding at least ``min_share`` of all rows, sorted.

    A frequent-items sketch (about 2/min_share entries a task) names the
    candidates; one more pass counts exactly those, with all other rows in one
    group.  At most 1/min_share keys come back.
    """
    sketch = df.where(F.col(key).isNotNull()).select(key).freqItems([key], max(min_share / 2, 1e-4)).first()
    candidates = [k for k in (sketch[0] or []) if k is not None]
    if not candidates:
        return []
    known = F.when(F.col(key).isin(candidates), F.col(key))
    counts = {r["k"]: r["n"] for r in df.groupBy(known.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    return sorted(k for k, n in counts.items() if k is not None and n >= min_share * total)


def join_splitting_hot_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner",
                            min_share: float = 0.01, keys: list | None = None, salts: int = 32) -> DataFrame:
    """Equi-join that spreads hot keys over ``salts`` partitions.

    Rows of ``fact`` whose key is hot (given, or found by :func:`hot_keys`)
    carry a salt, and the matching ``dim`` rows, at most 1/min_share keys, are
    repeated once a salt.  Rows with a null key match nothing: a left join
    takes them past the shuffle.  All others take the ordinary join.
    ``how`` may be ``inner`` or ``left`` (fact preserved).
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins split hot keys")
    keys = hot_keys(fact, fact_key, min_share) if keys is None else keys
    present = fact.where(F.col(fact_key).isNotNull())
    cold = present.where(~F.col(fact_key).isin(keys)) if keys else present
    out = cold.join(dim, cold[fact_key] == dim[dim_key], how)
    if keys:
        hot = present.where(F.col(fact_key).isin(keys)).withColumn(
            "__fact_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        copies = dim.where(F.col(dim_key).isin(keys)).withColumn(
            "__dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same = (hot[fact_key] == copies[dim_key]) & (F.col("__fact_salt") == F.col("__dim_salt"))
        out = out.union(hot.join(copies, same, how).drop("__fact_salt", "__dim_salt"))
    if how == "left":
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
        out = out.union(fact.where(F.col(fact_key).isNull()).select("*", *nothing))
    return out
