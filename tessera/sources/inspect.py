"""Inspection: first rows, schema, counts, catalog listings."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def head_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows; with sort keys the result is deterministic
    (``TakeOrderedAndProject``: a top-k per partition, no full sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


def schema_frame(df: DataFrame) -> DataFrame:
    """``printSchema`` / ``dtypes`` as a DataFrame: (position, col_name, data_type, nullable)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, col_name string, data_type string, nullable boolean")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE name`` restricted to the column rows."""
    out = spark.sql(f"DESCRIBE TABLE {name}")
    return out.where("col_name NOT LIKE '#%' AND col_name <> ''")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of the database; without one, those of the current database and the
    session's temporary views, which are in no database."""
    return spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary") if database else spark.sql("SHOW TABLES")


@contextlib.contextmanager
def database(spark: SparkSession, name: str) -> Iterator[str]:
    """``USE name`` inside the block, the session's former database afterwards, also after an error.

    The database is created where it is missing.
    """
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")
    try:
        yield name
    finally:
        spark.sql(f"USE {before}")


def row_count(df: DataFrame) -> int:
    return df.count()
