"""Positions of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

_PLACE_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with the 0-based position of every row in ``order`` as a long.

    Rows are range-partitioned and sorted; a row's place within its partition
    stands in the low bits of ``monotonically_increasing_id`` and the
    partition's number in the high ones.  The sorted rows are stored, which
    fixes the layout for the count and the result.  The driver gets one count
    a partition.  Rows that are equal in ``order`` get positions in any order;
    one value of ``order`` is never split over partitions, so add a key that
    tells rows apart where a value may be hot.  An empty frame stays empty.
    """
    spark, at = df.sparkSession, "__at"
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn(at, F.monotonically_increasing_id()), "numbered")
    part, before, total = F.shiftright(at, _PLACE_BITS), [], 0
    for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        before.append((r["part"], total))
        total += r["n"]
    offsets = spark.createDataFrame(before, "__part long, __before long")
    place = F.col("__before") + F.col(at).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (rows.withColumn("__part", part).join(F.broadcast(offsets), "__part")  # one row a partition
            .withColumn(name, place).drop("__part", "__before", at))
