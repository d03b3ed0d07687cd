"""UDF registration paths.

The native expressions (``F.hour``, :func:`tessera.functions.geo.haversine`)
are what the library uses.  These UDFs exist because the reference registers
Python functions as UDFs.  The Arrow forms get and return Arrow arrays: no
pandas, no pickled rows, and every step is one vectorised kernel.
"""

from __future__ import annotations

import math

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .geo import EARTH_RADIUS_KM, haversine_numpy


@F.arrow_udf(T.IntegerType())
def hour_of_day_arrow_udf(ts: pa.Array) -> pa.Array:
    return pc.cast(pc.hour(ts), pa.int32())


@F.pandas_udf(T.IntegerType())
def hour_of_day_udf(ts: pd.Series) -> pd.Series:
    return ts.dt.hour.astype("Int32")


def _radians(degrees: pa.Array) -> pa.Array:
    return pc.multiply(pc.cast(degrees, pa.float64()), math.pi / 180)


def _sine_of_half_squared(angle: pa.Array) -> pa.Array:
    half = pc.sin(pc.divide(angle, 2.0))
    return pc.multiply(half, half)


@F.arrow_udf(T.DoubleType())
def haversine_arrow_udf(lat1: pa.Array, lon1: pa.Array, lat2: pa.Array, lon2: pa.Array) -> pa.Array:
    """Great-circle distance in metres; null where a coordinate is."""
    lat1, lon1, lat2, lon2 = (_radians(x) for x in (lat1, lon1, lat2, lon2))
    across = pc.multiply(pc.multiply(pc.cos(lat1), pc.cos(lat2)), _sine_of_half_squared(pc.subtract(lon2, lon1)))
    chord = pc.add(_sine_of_half_squared(pc.subtract(lat2, lat1)), across)
    return pc.multiply(pc.asin(pc.sqrt(chord)), 2000.0 * EARTH_RADIUS_KM)


@F.pandas_udf(T.DoubleType())
def haversine_udf(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    return pd.Series(haversine_numpy(lat1.astype("float64"), lon1.astype("float64"),
                                     lat2.astype("float64"), lon2.astype("float64")))
