"""Row predicates: required values, inclusive ranges."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(columns: Iterable[str]) -> Column:
    """None of the columns is null. NaN counts as present; a range check removes it."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns), F.lit(True))


def all_in_range(ranges: Mapping[str, tuple[float, float]]) -> Column:
    """Every column lies in its range, both ends included; null and NaN do not."""
    return reduce(and_, (F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()), F.lit(True))


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.where(all_present(columns))


def within(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.where(all_in_range(ranges))
