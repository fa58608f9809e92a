"""Null handling: fill from another column, fill from constants."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_from_column(df: DataFrame, fallbacks: Mapping[str, str]) -> DataFrame:
    """Where a column is null, take the value of its fallback column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.col(other)) for c, other in fallbacks.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any], only_present: bool = False) -> DataFrame:
    """Replace null (and NaN in floating columns) by a constant per column.

    A column the frame lacks is an error, unless `only_present` drops its rule.
    """
    absent = sorted(set(defaults) - set(df.columns))
    if absent and not only_present:
        raise ValueError(f"cannot fill missing columns: {absent}")
    rules = {c: v for c, v in defaults.items() if c in df.columns}
    return df.fillna(rules) if rules else df
