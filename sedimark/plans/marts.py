"""The aggregate marts, as declared summaries of cleaned incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.operators.summaries import Summary, ordering

# Mart columns and thresholds.
CITY_MIN_ROWS, CITY_TOP = 50, 200
GRID_DIGITS, GRID_MIN_ROWS, GRID_TOP = 1, 5, 50

STATE_STATS = Summary(
    keys={"state": "state"},
    measures={
        "total_accidents": "count(*)",
        "avg_severity": "avg(severity)",
        "cities_count": "count(DISTINCT city)",
    },
    order=("total_accidents DESC", "state"),
)

TIME_PATTERNS = Summary(
    keys={"hour": "hour(start_time)", "day_of_week": "dayofweek(start_time)"},
    measures={"total_accidents": "count(*)", "avg_severity": "avg(severity)"},
)

WEATHER_ANALYSIS = Summary(
    where="weather_condition IS NOT NULL",
    keys={"weather_condition": "weather_condition"},
    measures={
        "total_accidents": "count(*)",
        "avg_severity": "avg(severity)",
        "avg_temperature": "avg(temperature_f)",
    },
    order=("total_accidents DESC", "weather_condition"),
)

CLASS_DISTRIBUTION = Summary(
    keys={"severity": "severity"}, measures={"count": "count(*)"}, order=("severity",)
)


def city_hotspots(min_rows: int = CITY_MIN_ROWS, top: int = CITY_TOP) -> Summary:
    """Cities by number of incidents; rows without a city form one group per state."""
    return Summary(
        keys={"state": "state", "city": "city"},
        measures={
            "total_accidents": "count(*)",
            "avg_severity": "avg(severity)",
            "latitude": "avg(start_lat)",
            "longitude": "avg(start_lng)",
        },
        having=f"total_accidents >= {int(min_rows)}",
        order=("total_accidents DESC", "state", "city"),
        top=top,
    )


def grid_hotspots(digits: int = GRID_DIGITS, min_rows: int = GRID_MIN_ROWS, top: int = GRID_TOP) -> Summary:
    """Map cells (coordinates rounded half up) by total severity."""
    return Summary(
        keys={"lat_grid": f"round(start_lat, {int(digits)})", "lng_grid": f"round(start_lng, {int(digits)})"},
        measures={
            "total_accidents": "count(*)",
            "avg_severity": "avg(severity)",
            # The sum itself: count times average differs from it in the last digits, which would break ties.
            "hotspot_score": "cast(sum(severity) AS double)",
        },
        having=f"total_accidents >= {int(min_rows)}",
        order=("hotspot_score DESC", "lat_grid", "lng_grid"),
        top=top,
    )


def city_sums(silver: DataFrame) -> DataFrame:
    """Sums per (state, city): small, and enough for both the state and the city mart."""
    return silver.groupBy("state", "city").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("severity").alias("severity"),
        F.count("severity").alias("rated"),
        F.sum("start_lat").alias("lat"),
        F.sum("start_lng").alias("lng"),
        F.count("start_lat").alias("located"),
    )


def state_stats_from(cities: DataFrame) -> DataFrame:
    """The state mart from `city_sums`: (state, city) is already distinct, so cities are counted plainly."""
    made = cities.groupBy("state").agg(
        F.sum("rows").alias("total_accidents"),
        F.try_divide(F.sum("severity"), F.sum("rated")).alias("avg_severity"),
        F.count("city").alias("cities_count"),
    )
    return made.orderBy(*ordering(STATE_STATS.order))


def city_hotspots_from(cities: DataFrame, min_rows: int = CITY_MIN_ROWS, top: int = CITY_TOP) -> DataFrame:
    """The city mart from `city_sums`."""
    made = cities.where(F.col("rows") >= min_rows).select(
        "state",
        "city",
        F.col("rows").alias("total_accidents"),
        F.try_divide("severity", "rated").alias("avg_severity"),
        F.try_divide("lat", "located").alias("latitude"),
        F.try_divide("lng", "located").alias("longitude"),
    )
    return made.orderBy(*ordering(city_hotspots().order)).limit(top)


def weather_table(silver: DataFrame) -> DataFrame:
    """The weather columns of the cleaned records, with their key and place."""
    # The weather columns of the record layout.
    weather = (
        "weather_timestamp", "temperature_f", "wind_chill_f", "humidity", "pressure_in", "visibility_mi",
        "wind_direction", "wind_speed_mph", "precipitation_in", "weather_condition",
    )
    return silver.select("id", *[c for c in weather if c in silver.columns])


def summary_row(states: DataFrame, cities: DataFrame) -> DataFrame:
    """One row over two marts: incidents and rows of the state mart, rows of the city mart."""
    parts = states.select("total_accidents", F.lit(1).alias("s"), F.lit(0).alias("c")).unionByName(
        cities.select(F.lit(0).cast("bigint").alias("total_accidents"), F.lit(0).alias("s"), F.lit(1).alias("c"))
    )
    return parts.agg(
        F.sum("total_accidents").alias("total_accidents"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("total_states"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("total_cities"),
    )
