"""Delimited text of unknown types: types from the data, bad rows set apart.

Spark's own inference widens a column to text as soon as one value does not
fit.  Here a type holds if at most a given share of the non-empty values fails
it, and lines with such values, or with another number of fields, come back as
rejects.  The types take one scan of the text as strings;
nothing but one row of counts reaches the driver.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: From narrow to wide; text always fits.
CANDIDATES: tuple[T.DataType, ...] = (T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampNTZType())

CORRUPT = "_corrupt_line"


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether the text is a plain form of the type (a cast alone would take ' 1 ' or '1d')."""
    shape = {T.IntegerType: r"^[+-]?\d{1,10}$", T.LongType: r"^[+-]?\d{1,19}$",
             T.DoubleType: r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$", T.BooleanType: r"(?i)^(true|false)$",
             T.DateType: r"^\d{4}-\d{2}-\d{2}$", T.TimestampNTZType: r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"}
    return value.rlike(shape[type(kind)]) & value.try_cast(kind).isNotNull()


def infer_types(strings: DataFrame, max_bad: float = 0.01) -> T.StructType:
    """The narrowest type of every text column that at most ``max_bad`` of its non-empty values fail.

    A column without values stays text.
    """
    names = strings.columns
    counts = []
    for i, name in enumerate(names):
        value = F.col("`" + name.replace("`", "``") + "`")
        value = F.when(value != "", value)
        counts.append(F.count(value).alias(f"n{i}"))
        counts += [F.count(F.when(_fits(value, kind), 1)).alias(f"n{i}_{k}") for k, kind in enumerate(CANDIDATES)]
    found = strings.agg(*counts).first()
    fields = []
    for i, name in enumerate(names):
        n = found[f"n{i}"]
        fitting = [kind for k, kind in enumerate(CANDIDATES) if n and found[f"n{i}_{k}"] >= (1 - max_bad) * n]
        fields.append(T.StructField(name, fitting[0] if fitting else T.StringType()))
    return T.StructType(fields)


def _lines(spark: SparkSession, path: str | Sequence[str], sep: str, header: bool, names: Sequence[str] | None
           ) -> tuple[DataFrame, list[str]]:
    """The lines that hold rows, and the columns' names (those of the header, the given ones, or _c0, _c1, ...)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    first = lines.first()
    if first is None:
        return lines, list(names or [])
    fields = next(csv.reader([first["value"]], delimiter=sep))
    if header:  # every file begins with it
        return lines.where(F.col("value") != F.lit(first["value"])), list(names or fields)
    return lines, list(names or [f"_c{i}" for i in range(len(fields))])


def _parsed(lines: DataFrame, schema: T.StructType, sep: str, options: Mapping[str, str]) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_csv("value", F.lit(wide.toDDL()),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "sep": sep, **options})
    return lines.select(read.alias("row"))


def read_with_rejects(spark: SparkSession, path: str | Sequence[str], sep: str = ",", header: bool = True,
                      names: Sequence[str] | None = None, schema: T.StructType | None = None, max_bad: float = 0.01,
                      **options) -> tuple[DataFrame, DataFrame, T.StructType]:
    """(rows, rejects, schema) of delimited text, one row a line.

    ``rows`` have the declared or inferred types; ``rejects`` are the lines
    that do not fit them (column ``line``).  A line is in exactly one of the
    two, whichever columns are read later.  Lines of white space only and, with
    ``header``, lines equal to the first one are no rows.  Without a line the
    columns of ``names`` are text.
    """
    lines, names = _lines(spark, path, sep, header, names)
    if schema is None:
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        schema = infer_types(_parsed(lines, text, sep, options).select("row.*").drop(CORRUPT), max_bad) if names else text
    parsed = _parsed(lines, schema, sep, options)
    corrupt = F.col("row").getField(CORRUPT)
    rows = parsed.where(corrupt.isNull()).select(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields])
    return rows, parsed.where(corrupt.isNotNull()).select(corrupt.alias("line")), schema
