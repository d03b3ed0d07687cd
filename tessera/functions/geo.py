"""Great-circle distance as a native Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value that must match the reference's results: Earth radius in km.
EARTH_RADIUS_KM = 6372.8


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in metres between two points given in degrees.

    Null in any input gives null out; evaluated inside whole-stage codegen.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    d_lat = F.radians(lat2 - lat1)
    d_lon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(d_lat / 2.0), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(d_lon / 2.0), 2))
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.asin(F.sqrt(a))) * F.lit(1000.0)


def haversine_numpy(lat1, lon1, lat2, lon2):
    """Same formula over numpy arrays / pandas Series (used by the pandas UDF)."""
    import numpy as np

    d_lat = np.radians(lat2 - lat1)
    d_lon = np.radians(lon2 - lon1)
    a = (np.sin(d_lat / 2.0) ** 2
         + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(d_lon / 2.0) ** 2)
    return EARTH_RADIUS_KM * (2.0 * np.arcsin(np.sqrt(a))) * 1000.0
