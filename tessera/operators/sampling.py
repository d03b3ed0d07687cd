"""Sampling and splitting.

``sample`` / ``randomSplit`` are Spark's seeded Bernoulli forms; their
output depends on the partition layout even with a seed.  The hash forms
decide per row from an md5 of key columns, so the same rows are chosen on
any layout, any cluster size and in any engine that has md5.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_SPACE = 2 ** 32
NULL_KEY = chr(1) + "null"


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None,
                     with_replacement: bool = False) -> DataFrame:
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def labelled_random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None,
                          label: str = "split") -> DataFrame:
    """A random split as one frame, tagged 0, 1, ... by part: one scan, one draw a row."""
    total, bounds = sum(weights), []
    for w in list(weights)[:-1]:
        bounds.append((bounds[-1] if bounds else 0.0) + w / total)
    drawn = df.withColumn(label, F.rand(seed) if seed is not None else F.rand())
    return drawn.withColumn(label, reduce(lambda a, b: a + b, [(F.col(label) >= b).cast("int") for b in bounds], F.lit(0)))


def hash_unit(*keys: str | Column) -> Column:
    """Integer in [0, 2^32) from the first 8 hex digits of md5 of the keys.

    Keys should be integers or strings: their text form is the same in
    every engine, so the same rows are chosen everywhere (doubles print
    differently across engines).  A null key hashes as a marker of its own, so
    that its row falls into one part of a split like any other."""
    cols = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit(NULL_KEY)) for k in keys]
    text = cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, keys: Sequence[str | Column], fraction: float) -> DataFrame:
    return df.where(hash_unit(*keys) < F.lit(int(fraction * HASH_SPACE)))


def hash_split(df: DataFrame, keys: Sequence[str | Column], first_fraction: float
               ) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete split: rows whose key hash is below the cut, and the rest."""
    cut = F.lit(int(first_fraction * HASH_SPACE))
    h = hash_unit(*keys)
    return df.where(h < cut), df.where(h >= cut)
