"""Column expressions: projections, predicates and scalar conversions.

Each helper returns a ``Column`` so it composes inside one projection and
stays in whole-stage code generation.  Spark 2 era behaviour that changed in
Spark 4 (ANSI casts, inferred timestamps) is handled with ``try_*`` forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must match the reference's results.
METRES_PER_MILE = 1609.344
BLOCK_GROUP_DIGITS = 12
BLOCK_GROUP_PATTERN = r"^(\d{12}).*"
LOG_REQUEST_PATTERN = r'^.*"(GET.*?)".*$'
RIDE_TIME_FORMAT = "yyyy-MM-dd HH:mm"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- projections -----------------------------------------------------------

def select_range(df: DataFrame, first: str, last: str, *more: str) -> DataFrame:
    """``select(year:day, arr_delay)``: a positional run of columns plus others."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if i > j:
        i, j = j, i
    return df.select(*cols[i:j + 1], *more)


# ---- numeric ---------------------------------------------------------------

def metres_to_miles(c: str | Column, digits: int = 2) -> Column:
    return F.round(_c(c) / F.lit(METRES_PER_MILE), digits)


def zero_pad(c: str | Column, width: int = 10) -> Column:
    """``format_string('%010d', c)`` that keeps null as null (Spark prints 'null')."""
    col = _c(c)
    return F.when(col.isNotNull(), F.format_string(f"%0{width}d", col))


def flag_is_one(c: str | Column) -> Column:
    return _c(c) == F.lit(1)


def flag_as_boolean(c: str | Column) -> Column:
    return _c(c).cast("boolean")


# ---- strings ---------------------------------------------------------------

def normalise_label(c: str | Column) -> Column:
    return F.upper(F.trim(_c(c)))


def block_group(c: str | Column) -> Column:
    """First 12 characters of a census block code (1-based substring)."""
    return F.substring(_c(c), 1, BLOCK_GROUP_DIGITS)


def block_group_regex(c: str | Column) -> Column:
    """Leading 12 digits by regex; '' when the value does not start with 12 digits."""
    return F.regexp_extract(_c(c), BLOCK_GROUP_PATTERN, 1)


def log_request(c: str | Column) -> Column:
    """Quoted ``GET ...`` request of a web server log line; '' when absent."""
    return F.regexp_extract(_c(c), LOG_REQUEST_PATTERN, 1)


def concat_key(*cols: str | Column) -> Column:
    """``concat`` of columns: null when any part is null."""
    return F.concat(*[_c(c).cast("string") for c in cols])


# ---- dates and times -------------------------------------------------------

def to_date_by_cast(c: str | Column) -> Column:
    return _c(c).cast("date")


def to_date_by_function(c: str | Column) -> Column:
    return F.to_date(_c(c))


def to_timestamp_by_cast(c: str | Column) -> Column:
    """String to timestamp; malformed text gives null (Spark 2 behaviour)."""
    return F.try_to_timestamp(_c(c).cast("string"))


def to_timestamp_with_format(c: str | Column, fmt: str = RIDE_TIME_FORMAT) -> Column:
    return F.try_to_timestamp(_c(c).cast("string"), F.lit(fmt))


def age_in_years(birth: str | Column, as_of: str | Column | None = None) -> Column:
    """Whole years between two dates; ``as_of`` defaults to ``current_date()``.

    Both sides are cast to date first so the result does not depend on the
    time of day of either value.
    """
    today = F.current_date() if as_of is None else _c(as_of).cast("date")
    return F.floor(F.months_between(today, _c(birth).cast("date")) / F.lit(12))


def hour_of_day(c: str | Column) -> Column:
    return F.hour(_c(c))


# ---- predicates ------------------------------------------------------------

def on_time(delay: str | Column) -> Column:
    return _c(delay) <= F.lit(0)


def null_flag(c: str | Column) -> Column:
    """1 when the value is present, 0 when null."""
    return _c(c).isNotNull().cast("int")


def not_equal_keep_null(c: str | Column, value) -> Column:
    """``c != value`` that keeps null rows (plain ``!=`` drops them)."""
    return ~_c(c).eqNullSafe(F.lit(value))


def share_true(pred: Column) -> Column:
    """Share of rows where ``pred`` holds, null counted as false, in one pass."""
    return F.avg(F.coalesce(pred, F.lit(False)).cast("double"))
