"""Registry of named queries over the test tables.

Each entry pairs a Spark builder ``fn(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL over the same tables (or ``None`` where the result is
not expressible in SQL: seeded random sampling, iterative model fitting).
Doubles are rounded in both forms so results compare exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from ..sources.readers import load as _load

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None
    inventory: str  # SURVEY §2 row ids covered


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None, inventory: str):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = Entry(name, build, sql.strip() if sql else None, inventory)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, opened anew each time, so that rows added meanwhile are read."""
    return _load(spark, sf_dir, name)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double / float column (comparison stability across engines)."""
    out = []
    for name, dtype in df.dtypes:
        if dtype in ("double", "float"):
            out.append(F.round(F.col(name).cast("double"), digits).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
