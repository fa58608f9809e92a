"""Grouped summaries described by expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordering(terms: Sequence[str]) -> list[Column]:
    """'name' or 'name DESC' to sort columns; nulls sort first ascending and last descending."""
    made = []
    for term in terms:
        name, _, direction = term.partition(" ")
        made.append(F.col(name).desc_nulls_last() if direction.upper() == "DESC" else F.col(name).asc_nulls_first())
    return made


@dataclass(frozen=True)
class Summary:
    """Group by `keys`, compute `measures`, keep groups that satisfy `having`, add `derived`, take `top`.

    All parts are SQL expressions by output name. `order` must end in the keys, so that ties have one
    order and the top rows are unique.
    """

    keys: Mapping[str, str]
    measures: Mapping[str, str]
    where: str | None = None
    having: str | None = None
    derived: Mapping[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    top: int | None = None

    def of(self, df: DataFrame) -> DataFrame:
        rows = df.where(self.where) if self.where else df
        grouped = rows.groupBy(*[F.expr(e).alias(n) for n, e in self.keys.items()])
        result = grouped.agg(*[F.expr(e).alias(n) for n, e in self.measures.items()])
        if self.having:
            result = result.where(self.having)
        if self.derived:
            result = result.withColumns({n: F.expr(e) for n, e in self.derived.items()})
        if self.order:
            result = result.orderBy(*ordering(self.order))
        return result.limit(self.top) if self.top is not None else result
