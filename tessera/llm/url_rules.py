"""URL prefix rules by a sort-merge range join, in DataFrame operations only.

Reversed-host canonical keys (``com.example/en/``) turn a rule into an interval
of keys.  An url is looked up under each of its host's suffixes, so a rule for
a host also meets the subdomains with their own paths.  Interval ends and
distinct url keys are range-partitioned and sorted together; a sweep keeps the
stack of active nested rules: a running count of open intervals is the depth,
and the rule on top is the one opened last at that depth.  Depth and stack at
the start of a range come from per-range aggregates (a few rows a range).

A host with very many pages is cut by path between ranges, and equal urls are
judged once.

Defined results: a null url, or one without ``://``, has empty host and path
and no rule; without a rule the verdict is the default; of equal rules the one
that sorts last (block) counts; rows that repeat are judged alike; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

DEFAULT = "allow"
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def canonical(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), path).cast("binary")


def after_prefix(key: Column) -> Column:
    """The smallest key beyond all that begin with ``key``: its last byte plus one."""
    digits = F.hex(key)
    last = F.conv(F.substring(digits, -2, 2), 16, 10).cast("int") + 1
    return F.unhex(F.concat(F.substring(digits, F.lit(1), F.length(digits) - 2), F.lpad(F.hex(last), 2, "0")))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls: distinct (host, path).  Adds ``rule``, the longest that fits (null if none), and its verdict."""
    spark = urls.sparkSession
    C.prepare(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.slice(labels, F.size(labels) - k + 1, k))
    points = urls.select("host", "path", F.explode(suffixes).alias("suffix")).select(
        canonical(F.col("suffix"), F.col("path")).alias("key"), F.lit(2).alias("kind"), F.lit(0).alias("step"),
        F.lit(None).cast("struct<rule:string,verdict:string>").alias("rule"), "host", "path")
    named = (rules.withColumn("key", canonical(labels, F.col("path"))).groupBy("key")
             .agg(F.max(F.struct(F.concat("host", "path").alias("rule"), "verdict")).alias("rule")))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("host", "path")]
    opened = named.select("key", F.lit(1).alias("kind"), F.lit(1).alias("step"), "rule", *nothing)
    closed = named.select(after_prefix(F.col("key")).alias("key"), F.lit(0).alias("kind"), F.lit(-1).alias("step"),
                          F.lit(None).cast("struct<rule:string,verdict:string>").alias("rule"), *nothing)
    # stored: the ranges must be the same in the steps below
    swept = C.stored(points.unionByName(opened).unionByName(closed)
                     .repartitionByRange(ranges, "key", "kind", "host").withColumn("part", F.spark_partition_id()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    depths = (swept.groupBy("part").agg(F.sum("step").alias("net"))
              .select("part", F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("base")))  # a row a range
    so_far = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    deep = (swept.join(F.broadcast(depths), "part")
            .withColumn("level", F.col("base") + F.sum("step").over(so_far)).drop("base"))
    left_open = (deep.where("kind <> 0").groupBy("part", "level")
                 .agg(F.max_by("rule", F.when(F.col("kind") == 1, F.col("key"))).alias("rule")))
    stack = left_open.select("part", "level", F.last("rule", ignorenulls=True).over(
        Window.partitionBy("level").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("from_before"))
    at_level = Window.partitionBy("part", "level").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    tops = (deep.where("kind <> 0").withColumn("top", F.last("rule", ignorenulls=True).over(at_level))
            .where("kind = 2 and level > 0").join(stack, ["part", "level"])
            .withColumn("top", F.coalesce("top", "from_before")))
    return (tops.groupBy("host", "path").agg(F.max_by("top", F.length("top.rule")).alias("top"))
            .select("host", "path", "top.rule", "top.verdict"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = match_rules(pages.select("host", "path").distinct(), rules)
    return (pages.join(found, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    pages = C.read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP5_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rhost, rpath, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT s.page_id, s.host, s.path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY s.page_id, s.host, s.path ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
  FROM split s LEFT JOIN rules ON (s.host = rhost OR ends_with(s.host, '.' || rhost)) AND starts_with(s.path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""
