"""Writers: delimited (optionally compressed), text, Parquet, ORC, JSON and
catalog tables.  Paths are parameters; nothing is written to a
machine-local folder by the library itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..lifetimes import note_table


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "errorifexists", compression: str | None = None) -> None:
    w = df.write.mode(mode).option("header", header).option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text sink: the frame must have exactly one string column."""
    if len(df.columns) != 1 or dict(df.dtypes)[df.columns[0]] != "string":
        raise ValueError("text sink needs exactly one string column")
    df.write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).orc(path)


def write_format(df: DataFrame, fmt: str, path: str, mode: str = "errorifexists", **options) -> None:
    df.write.format(fmt).mode(mode).options(**options).save(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], only_touched: bool = True) -> None:
    """Parquet with one folder per value of ``by``.

    With ``only_touched`` a later write replaces just the folders of the values
    it brings (dynamic partition overwrite); otherwise it replaces all.  Rows
    of one value are brought together first so that a folder gets few files;
    the rebalancing shuffle splits values that hold very many rows.
    """
    mode = "dynamic" if only_touched else "static"
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", mode)
     .partitionBy(*by).parquet(path))


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str, mode: str = "overwrite") -> str:
    """A catalog table whose rows lie in ``buckets`` hash buckets of ``keys``, sorted within.

    Tables of the same number of buckets join on these keys without a shuffle.
    Rows are dealt by the same hash first, so that a bucket gets one file.  A key
    with a large share of the rows makes a large bucket: where keys are hot,
    join with ``join_splitting_hot_keys`` instead.
    """
    (df.repartition(buckets, *keys).write.mode(mode).option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return note_table(name)


def create_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> str:
    """A catalog entry over files that are there already; nothing is copied, and dropping it keeps them."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    return note_table(name)


def unique_table_name(prefix: str = "t") -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def save_as_table(df: DataFrame, name: str | None = None, path: str | None = None,
                  mode: str = "errorifexists") -> str:
    """``saveAsTable`` under a unique name; with ``path`` the table's files go
    to that (shared) location instead of the warehouse."""
    name = name or unique_table_name()
    w = df.write.mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return note_table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
