"""Categorical labels derived from measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the risk levels and the conditions of each category.
RISK_FLOORS = (("HIGH", 3), ("MEDIUM", 2))
CONDITION_CATEGORIES = (("HIGH", ("SNOW", "ICE")), ("MEDIUM", ("RAIN", "FOG")))


def risk_level(measure: str | Column) -> Column:
    """HIGH, MEDIUM or LOW by a mean severity; a missing mean is LOW."""
    value = F.col(measure) if isinstance(measure, str) else measure
    (first, floor), *others = RISK_FLOORS
    ladder = F.when(value >= floor, first)
    for label, floor in others:
        ladder = ladder.when(value >= floor, label)
    return ladder.otherwise("LOW")


def condition_category(
    condition: str | Column, categories: tuple[tuple[str, tuple[str, ...]], ...] = CONDITION_CATEGORIES
) -> Column:
    """Category of a condition, compared in normalised (upper-case, trimmed) form; LOW when unlisted."""
    value = F.upper(F.trim(condition))
    (first, members), *others = categories
    ladder = F.when(value.isin(*members), first)
    for label, members in others:
        ladder = ladder.when(value.isin(*members), label)
    return ladder.otherwise("LOW")
