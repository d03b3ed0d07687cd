"""Arrival-time scoring rule as one Column expression (batch scoring).

Rule: predicted delay in minutes is ``dep_delay * 1.02 - 5.9``; it is added
to the scheduled arrival time given as an ``hhmm`` integer and the result is
returned as ``hhmm`` of the wall clock, wrapping at midnight.  The delay is
applied at microsecond resolution (round half to even) and seconds are cut
off, as adding a ``timedelta`` to a clock time does.  Hours of 24 or minutes
above 59 carry over instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rule.
DELAY_SLOPE = 1.02
DELAY_OFFSET_MIN = 5.9
MICROS_PER_MINUTE = 60_000_000
MINUTES_PER_DAY = 1440


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def predicted_arrival_hhmm(sched_arr_time, dep_delay) -> Column:
    sched = _c(sched_arr_time).cast("long")
    delay = _c(dep_delay).cast("double")
    hours = F.floor(sched / F.lit(100))
    minutes = F.pmod(sched, F.lit(100))
    start_us = (hours * 60 + minutes) * F.lit(MICROS_PER_MINUTE)
    shift_us = F.rint((delay * F.lit(DELAY_SLOPE) - F.lit(DELAY_OFFSET_MIN))
                      * F.lit(MICROS_PER_MINUTE)).cast("long")
    total_min = F.floor((start_us + shift_us) / F.lit(MICROS_PER_MINUTE))
    clock = F.pmod(total_min, F.lit(MINUTES_PER_DAY))
    return (F.floor(clock / F.lit(60)) * 100 + F.pmod(clock, F.lit(60))).cast("int")
