"""Clock parts of a timestamp, in the session time zone (UTC by default)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUNDAY, SATURDAY = 1, 7


def hour_of(moment: str | Column) -> Column:
    return F.hour(moment)


def weekday_of(moment: str | Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(moment)


def weekend_flag(moment: str | Column) -> Column:
    """1 on Saturday and Sunday, else 0 (also for a missing moment)."""
    return F.when(F.dayofweek(moment).isin(SUNDAY, SATURDAY), 1).otherwise(0)
