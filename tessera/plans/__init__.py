"""Named queries over the test tables, each with its DuckDB oracle."""

from . import (  # noqa: F401
    column_plans,
    ml_plans,
    relational_plans,
    sampling_plans,
    source_plans,
    stats_plans,
    tuning_plans,
    udf_plans,
)
from .registry import REGISTRY

__all__ = ["REGISTRY"]
