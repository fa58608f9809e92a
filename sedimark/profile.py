"""What a record type requires, how its gaps are filled and which ranges are valid."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any


@dataclass(frozen=True)
class RecordProfile:
    """Declarative cleaning rules of one record type.

    `tie_break` decides, in ascending order, which of several rows with one `key` survives. Unless
    `tie_break_is_total` says that no two rows of a key agree in it, all other columns settle ties; a
    total one lets later steps read fewer columns.
    """

    key: str
    required: tuple[str, ...]
    tie_break: tuple[str, ...] = ()
    tie_break_is_total: bool = False
    fallbacks: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, Any] = field(default_factory=dict)
    uppercase: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    learning_defaults: Mapping[str, Any] = field(default_factory=dict)
    learning_columns: tuple[str, ...] = ()
    learning_required: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()

    def bound_to(self, columns: Iterable[str]) -> RecordProfile:
        """The same rules restricted to columns that exist; missing required ones are an error."""
        present = set(columns)
        absent = [c for c in (self.key, *self.required, *self.ranges) if c not in present]
        if absent:
            raise ValueError(f"required columns are missing: {sorted(set(absent))}")

        def known(rules: Mapping[str, Any]) -> dict[str, Any]:
            return {c: v for c, v in rules.items() if c in present}

        tie_break = tuple(c for c in self.tie_break if c in present)
        return replace(
            self,
            tie_break=tie_break,
            tie_break_is_total=self.tie_break_is_total and tie_break == self.tie_break,
            fallbacks={c: o for c, o in self.fallbacks.items() if c in present and o in present},
            defaults=known(self.defaults),
            uppercase=tuple(c for c in self.uppercase if c in present),
            types=known(self.types),
            learning_defaults=known(self.learning_defaults),
            flags=tuple(c for c in self.flags if c in present),
        )

    def with_tie_break(self, *columns: str, total: bool = False) -> RecordProfile:
        return replace(self, tie_break=columns, tie_break_is_total=total)


# The source layout, fill values, valid ranges and storage types of road incidents.
RAW_COLUMNS = (
    "ID", "Source", "Severity", "Start_Time", "End_Time", "Start_Lat", "Start_Lng", "End_Lat", "End_Lng",
    "Distance(mi)", "Description", "Street", "City", "County", "State", "Zipcode", "Country", "Timezone",
    "Airport_Code", "Weather_Timestamp", "Temperature(F)", "Wind_Chill(F)", "Humidity(%)", "Pressure(in)",
    "Visibility(mi)", "Wind_Direction", "Wind_Speed(mph)", "Precipitation(in)", "Weather_Condition",
    "Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout", "Station",
    "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop", "Sunrise_Sunset", "Civil_Twilight",
    "Nautical_Twilight", "Astronomical_Twilight",
)

FLAG_COLUMNS = (
    "amenity", "bump", "crossing", "give_way", "junction", "no_exit", "railway", "roundabout", "station",
    "stop", "traffic_calming", "traffic_signal", "turning_loop",
)

DOUBLE_COLUMNS = (
    "start_lat", "start_lng", "end_lat", "end_lng", "distance_mi", "temperature_f", "wind_chill_f",
    "humidity", "pressure_in", "visibility_mi", "wind_speed_mph", "precipitation_in",
)

TIME_COLUMNS = ("start_time", "end_time", "weather_timestamp")

INCIDENTS = RecordProfile(
    key="id",
    required=("id", "severity", "state", "start_lat", "start_lng", "start_time"),
    tie_break=("situation_date",),
    fallbacks={"end_lat": "start_lat", "end_lng": "start_lng"},
    defaults={
        "description": "No description available",
        "street": "Unknown Street",
        "zipcode": "00000",
        "timezone": "US/Eastern",
        "airport_code": "UNKNOWN",
        "temperature_f": 70.0,
        "humidity": 60.0,
        "pressure_in": 29.92,
        "visibility_mi": 10.0,
        "wind_direction": "CALM",
        "wind_speed_mph": 5.0,
        "weather_condition": "Clear",
        "sunrise_sunset": "Day",
        "civil_twilight": "Day",
        "nautical_twilight": "Day",
        "astronomical_twilight": "Day",
    },
    uppercase=("state", "weather_condition", "wind_direction"),
    ranges={"severity": (1, 4), "start_lat": (24.0, 50.0), "start_lng": (-130.0, -65.0)},
    types={
        "severity": "int",
        **dict.fromkeys(DOUBLE_COLUMNS, "double"),
        **dict.fromkeys(FLAG_COLUMNS, "boolean"),
        **dict.fromkeys(TIME_COLUMNS, "timestamp"),
    },
    learning_defaults={
        "distance_mi": 1.0,
        "temperature_f": 70.0,
        "humidity": 60.0,
        "pressure_in": 29.92,
        "visibility_mi": 10.0,
        "wind_speed_mph": 5.0,
        "weather_condition": "Clear",
        "wind_direction": "CALM",
        "sunrise_sunset": "Day",
        **dict.fromkeys(FLAG_COLUMNS, False),
    },
    learning_columns=(
        "id", "severity", "start_time", "start_lat", "start_lng", "end_lat", "end_lng", "distance_mi",
        "temperature_f", "humidity", "pressure_in", "visibility_mi", "wind_speed_mph", "weather_condition",
        "wind_direction", "sunrise_sunset", *FLAG_COLUMNS,
    ),
    learning_required=("severity", "start_lat", "start_lng"),
    flags=FLAG_COLUMNS,
)
