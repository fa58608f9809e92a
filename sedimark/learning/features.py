"""Preparation of cleaned records for training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.functions import hour_of, weekday_of
from sedimark.operators.filling import fill_defaults
from sedimark.operators.validity import within
from sedimark.profile import RecordProfile

# Candidate inputs of the two models.
SEVERITY_INPUTS = (
    "start_lat", "start_lng",
    "distance_mi", "temperature_f", "humidity", "pressure_in", "visibility_mi", "wind_speed_mph",
    "amenity", "bump", "crossing", "give_way", "junction", "traffic_signal", "turning_loop",
    "hour", "day_of_week",
)
ZONE_INPUTS = ("start_lat", "start_lng", "hour", "day_of_week", "junction", "traffic_signal")


def prepare(df: DataFrame, profile: RecordProfile) -> DataFrame:
    """Fill gaps, turn flags into 0/1, check ranges, add hour and weekday; for any subset of the columns."""
    rules = profile.bound_to({profile.key, *profile.required, *df.columns})
    filled = fill_defaults(df, rules.learning_defaults, only_present=True)
    flags = {c: F.col(c).cast("int") for c in rules.flags if c in df.columns}
    numeric = filled.withColumns(flags) if flags else filled
    valid = within(numeric, rules.ranges)
    if "start_time" not in df.columns:
        return valid
    return valid.withColumns({"hour": hour_of("start_time"), "day_of_week": weekday_of("start_time")})


def available(df: DataFrame, candidates: tuple[str, ...]) -> list[str]:
    return [c for c in candidates if c in df.columns]


def spread(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """A fixed number of partitions with sorted rows, so that training sees one layout in every run."""
    return df.repartition(partitions, key).sortWithinPartitions(key)
