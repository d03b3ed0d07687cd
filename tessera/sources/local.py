"""Bounded hand-over of results to local pandas frames.

``toPandas`` moves everything to the driver.  These helpers only do so for
frames whose size is proven small (one limited read), so an aggregate or a
sample can be pulled, a whole table cannot.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

DEFAULT_MAX_ROWS = 100_000


class TooLargeForDriver(ValueError):
    pass


def to_local(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> pd.DataFrame:
    """``toPandas`` that refuses frames with more than ``max_rows`` rows."""
    got = df.limit(max_rows + 1).toPandas()
    if len(got) > max_rows:
        raise TooLargeForDriver(f"frame has more than {max_rows} rows; aggregate, limit or sample first")
    return got


def head_local(df: DataFrame, n: int = 5) -> pd.DataFrame:
    return df.limit(n).toPandas()
