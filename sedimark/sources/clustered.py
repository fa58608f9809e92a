"""Tables whose files cover small boxes of place and time, so that a filter on them reads few row groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions.curve import interleaved, scaled
from sedimark.sources.sinks import materialized

_CURVE = "__curve"


@dataclass(frozen=True)
class Clustering:
    """The columns that a table is clustered by, with the bounds between which they vary, and how finely.

    A timestamp's bounds are dates as text. `group_bytes` is the size of a row group: what a filter can leave out.
    """

    columns: Mapping[str, tuple[float | str, float | str]]
    bits: int = 16
    group_bytes: int = 8 << 20
    options: Mapping[str, str] = field(default_factory=dict)

    def key(self) -> Column:
        numbers = []
        for name, (low, high) in self.columns.items():
            if isinstance(low, str):
                value, ends = _seconds(F.col(name)), (_seconds(F.lit(low).cast("timestamp")), _seconds(F.lit(high).cast("timestamp")))
                share = (value - ends[0]) / (ends[1] - ends[0])
                numbers.append(scaled(share, 0.0, 1.0, self.bits))
            else:
                numbers.append(scaled(F.col(name), float(low), float(high), self.bits))
        return interleaved(numbers, self.bits)


def _seconds(value: Column) -> Column:
    return value.cast("timestamp").cast("double")


# The valid range of places, and a span of times that holds all records.
BY_PLACE_AND_TIME = Clustering(
    {"start_lat": (24.0, 50.0), "start_lng": (-130.0, -65.0), "start_time": ("2000-01-01", "2050-01-01")}
)
BY_PLACE = Clustering({"start_lat": (24.0, 50.0), "start_lng": (-130.0, -65.0)}, bits=24)


def write_clustered(df: DataFrame, path: str, by: Clustering = BY_PLACE_AND_TIME, files: int | None = None, mode: str = "overwrite") -> None:
    """Write the rows in the order of the curve, range-partitioned; `files` is by default the session's partitions.

    Rows of one point may lie in several files. The frame is written once before, so that sampling its ranges does not
    evaluate it a second time.
    """
    spread = F.monotonically_increasing_id()
    placed, _ = materialized(df.withColumn(_CURVE, by.key()).withColumn("__spread", spread), "clustered")
    count = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(count, _CURVE, "__spread").sortWithinPartitions(_CURVE, "__spread")
    writer = ranged.drop(_CURVE, "__spread").write.mode(mode).option("parquet.block.size", str(by.group_bytes))
    writer.options(**by.options).parquet(path)


def in_box(df: DataFrame, box: Mapping[str, tuple[float, float]], between: Sequence[str] | None = None, time: str = "start_time") -> DataFrame:
    """Rows whose columns lie in the box, both ends included, and whose time lies between two texts, the end excluded.

    Each condition is a comparison of a column with a constant, which Parquet readers check against row groups.
    """
    found = df
    for name, (low, high) in box.items():
        found = found.where((F.col(name) >= low) & (F.col(name) <= high))
    if between is not None:
        kind = df.schema[time].dataType
        found = found.where((F.col(time) >= F.lit(between[0]).cast(kind)) & (F.col(time) < F.lit(between[1]).cast(kind)))
    return found
