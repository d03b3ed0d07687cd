"""Readers: delimited text, text lines, Parquet, ORC, JSON and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   schema: T.StructType | str | None = None, infer: bool = True,
                   **options) -> DataFrame:
    """csv / tsv scan.  A declared schema skips the inference pass over the
    text and renames columns by position; the header option is still needed
    so the header line is not read as a row."""
    reader = spark.read.option("header", header).option("sep", sep).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_format(spark: SparkSession, fmt: str, path: str, schema=None, **options) -> DataFrame:
    """Generic ``format(fmt).option(k, v).load(path)``."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def table_dir(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables by name."""
    return spark.read.parquet(table_dir(sf_dir, name))
