"""Incident records derived from the `events`, `customer` and `nation` tables.

Supplies every operator with nulls, padded text, invalid severities, coordinates out of range and
conflicting copies of one key, in proportion to the size of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.operators.cleaning import clean
from sedimark.profile import INCIDENTS

# The copies of a record are numbered; the lowest number survives.
PROFILE = INCIDENTS.with_tie_break("copy_no", total=True)

COPY_DAY = "2025-01-03"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _unless(multiple_of: int, value: Column) -> Column:
    """Null for every n-th record, else the value."""
    return F.when(F.col("event_id") % multiple_of != 0, value)


def incidents_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Raw incidents, one pass over `events`; every 19th record is followed by a conflicting copy."""
    events = _table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    customers = _table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    places = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    located = events.join(places, events.user_id == places.c_custkey)

    event, user, value, kind = F.col("event_id"), F.col("user_id"), F.col("value"), F.col("event_type")
    lat = 20 + user * 7919 % 320 / F.lit(10.0)
    lng = -135 + user * 104729 % 750 / F.lit(10.0)
    severity = (
        F.when(value >= 150, 5).when(value >= 80, 4).when(value >= 40, 3).when(value >= 10, 2).otherwise(1)
    )
    day = F.when(event % 100 < 33, "2025-01-01").when(event % 100 < 66, "2025-01-02").otherwise("2025-01-03")
    copies = F.when(event % 19 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    daylight = F.when(F.hour("ts").between(6, 18), "Day").otherwise("Night")
    condition = F.when(event % 13 == 0, F.concat(F.lit(" "), kind, F.lit(" "))).otherwise(kind)

    numbered = located.withColumn("copy_no", F.explode(copies))
    copied = F.col("copy_no") == 1
    return numbered.select(
        event.alias("id"),
        F.col("ts").alias("start_time"),
        F.when(copied, 4).otherwise(severity).alias("severity"),
        _unless(101, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).alias("state"),
        F.when(copied, "COPY").otherwise(_unless(17, F.col("c_mktsegment"))).alias("city"),
        lat.alias("start_lat"),
        (lng + event % 4 * F.lit(0.03)).alias("start_lng"),
        F.when(event % 5 >= 2, lat + F.lit(0.01)).alias("end_lat"),
        F.when(event % 5 >= 2, lng).alias("end_lng"),
        value.alias("distance_mi"),
        _unless(9, 20 + value % 80).alias("temperature_f"),
        _unless(8, F.lit(30.0) + event % 60).alias("humidity"),
        _unless(10, F.lit(29.0) + event % 20 / F.lit(10.0)).alias("pressure_in"),
        _unless(12, F.lit(1.0) + event % 10).alias("visibility_mi"),
        _unless(7, F.lit(0.5) * (event % 40)).alias("wind_speed_mph"),
        _unless(11, condition).alias("weather_condition"),
        _unless(14, F.substring(F.lit("nesw"), (event % 4 + 1).cast("int"), F.lit(1))).alias("wind_direction"),
        _unless(15, daylight).alias("sunrise_sunset"),
        (event % 3 == 0).alias("junction"),
        (kind == "error").alias("traffic_signal"),
        _unless(6, event % 2 == 0).alias("crossing"),
        F.to_date(F.when(copied, COPY_DAY).otherwise(day)).alias("situation_date"),
        "copy_no",
    )


def incidents_silver(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned incidents."""
    return clean(incidents_bronze(spark, folder), PROFILE).drop("copy_no")
