"""The paged reads of the marts."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.operators.page_index import PageIndex, indexed, version_of
from sedimark.operators.paging import page_of, page_totals
from sedimark.session import path_exists
from sedimark.sources.files import read_parquet
from sedimark.sources.layout import Layout


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Served:
    """How one mart is read: its columns, a total order, page sizes and the filters it accepts."""

    mart: str
    columns: tuple[str, ...]
    order: tuple[str, ...]
    default_size: int
    max_size: int
    filters: tuple[str, ...] = ()

    def rows(self, mart: DataFrame, filters: Mapping[str, str] | None = None) -> DataFrame:
        """The un-paged rows; a filter compares with the upper-cased argument, an empty one is ignored."""
        chosen = mart.select(*self.columns)
        for column, value in (filters or {}).items():
            if column not in self.filters:
                raise ValueError(f"{self.mart} cannot be filtered by {column}")
            if value:
                chosen = chosen.where(F.col(column) == value.upper())
        return chosen

    def page(self, mart: DataFrame, page: int = 1, size: int | None = None, **filters: str) -> DataFrame:
        return page_of(self.rows(mart, filters), self.order, page, self._size(size), self.max_size)

    def totals(self, mart: DataFrame, page: int = 1, size: int | None = None, **filters: str) -> DataFrame:
        return page_totals(self.rows(mart, filters), page, self._size(size))

    def index(self, spark: SparkSession, layout: Layout, fallback: str | None = None) -> PageIndex:
        """The page index of the mart as it is now written; built by the first call after the mart was."""
        mart = self.rows(read_parquet(spark, mart_path(spark, layout, self.mart, fallback)))
        return indexed(mart, layout.page_index(self.mart), version_of(mart), self.order)

    def far_page(self, spark: SparkSession, layout: Layout, page: int, size: int | None = None) -> DataFrame:
        """As `page` without filters, by the mart's index: any page costs one or two of its ranges."""
        return self.index(spark, layout).page(page, self._size(size), self.max_size)

    def _size(self, size: int | None) -> int:
        return self.default_size if size is None else size


# Columns, leading order, default and largest page size of each read. The further order
# columns only settle ties.
SERVED = {
    "states": Served(
        "state_stats",
        ("state", "total_accidents", "avg_severity", "cities_count"),
        ("total_accidents DESC", "state"),
        10, 100,
    ),
    "weather": Served(
        "weather_analysis",
        ("weather_condition", "total_accidents", "avg_severity", "avg_temperature"),
        ("total_accidents DESC", "weather_condition"),
        10, 50,
    ),
    "cities": Served(
        "city_hotspots",
        ("state", "city", "total_accidents", "avg_severity", "latitude", "longitude"),
        ("total_accidents DESC", "state", "city"),
        20, 100,
        filters=("state",),
    ),
    "time": Served(
        "time_patterns",
        ("hour", "day_of_week", "total_accidents", "avg_severity"),
        ("total_accidents DESC", "hour", "day_of_week"),
        24, 50,
    ),
    "severity_predictions": Served(
        "ml_severity_predictions",
        ("severity", "prediction", "start_lat", "start_lng", "model_type", "accuracy", "training_timestamp"),
        ("training_timestamp DESC", "severity", "prediction", "start_lat", "start_lng"),
        10, 50,
    ),
    "risk_zones": Served(
        "ml_risk_zones",
        ("risk_zone", "accident_count", "avg_severity", "center_lat", "center_lng", "risk_level"),
        ("accident_count DESC", "risk_zone"),
        10, 50,
    ),
    "hotspots": Served(
        "ml_hotspots",
        ("lat_grid", "lng_grid", "total_accidents", "avg_severity", "hotspot_score"),
        ("hotspot_score DESC", "lat_grid", "lng_grid"),
        10, 50,
    ),
}

MARTS = tuple(s.mart for s in SERVED.values())


def mart_path(spark: SparkSession, layout: Layout, mart: str, fallback: str | None = None) -> str | None:
    """Where the mart is, under the layout or else under the fallback root; None when it was not built."""
    places = [layout.gold(mart), *([Layout(fallback).gold(mart)] if fallback else [])]
    return next((p for p in places if path_exists(spark, p)), None)


def open_marts(spark: SparkSession, layout: Layout, fallback: str | None = None) -> dict[str, DataFrame]:
    """Every mart that was built, by name, also registered as a temporary view for SQL."""
    opened = {}
    for mart in MARTS:
        place = mart_path(spark, layout, mart, fallback)
        if place is None:
            log.warning("%s was not built", mart)
            continue
        opened[mart] = read_parquet(spark, place)
        opened[mart].createOrReplaceTempView(mart)
    return opened
