"""A space-filling curve over several columns, as a column expression.

Each value becomes a whole number of `bits` binary digits by its place between two bounds, and the digits of all columns
are interleaved, the highest first. Rows that are near each other in every column are mostly near on the curve, so files
sorted by it cover small boxes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(value: Column, low: float, high: float, bits: int) -> Column:
    """The place of a number between two bounds, 0 to 2^bits - 1; outside values take the nearest, null and NaN 0."""
    top = (1 << bits) - 1
    share = (value.cast("double") - low) / (high - low)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.nanvl(F.coalesce(share, F.lit(0.0)), F.lit(0.0))))
    return F.coalesce(F.floor(bounded * top).cast("bigint"), F.lit(0).cast("bigint"))


def _apart(number: Column, bits: int, columns: int) -> Column:
    """The number's digits, each `columns` places from the next, by halving the groups that stay together."""
    group = 1
    while group < bits:
        group *= 2
    spread = number
    while group > 1:
        group //= 2
        # Digits from `group` on within each pair of groups move up by what the other columns need.
        mask = 0
        for i in range(bits):
            mask |= 1 << (i // group * group * columns + i % group)
        spread = spread.bitwiseOR(F.shiftleft(spread, group * (columns - 1))).bitwiseAND(F.lit(mask).cast("bigint"))
    return spread


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """One number from several of `bits` digits each; at most 62 digits in all."""
    if bits * len(numbers) > 62:
        raise ValueError("the digits of all columns do not fit into a bigint")
    made = None
    for i, number in enumerate(numbers):
        moved = F.shiftleft(_apart(number, bits, len(numbers)), len(numbers) - 1 - i)
        made = moved if made is None else made.bitwiseOR(moved)
    return made
