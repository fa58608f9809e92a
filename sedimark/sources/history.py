"""The schema history of dated batches: what each day was stored with, and one scan over days that differ.

Beside the partitions of a batch table lies a record per day with the id of its delivery and its schema. The table's
schema is all days' columns, in the order of the days that bring them, each in the narrowest type that holds every
day's values: int, bigint, double as far as all days have numbers, else text. Days of one stored schema are one scan,
whose columns are cast after they are read; so a Parquet reader never meets a type it did not expect.

A marker lies in the folder while a write runs. Where one is found, the write did not end, so the records may be older
than the data: the days' schemas are then read from the files themselves.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.session import delete_path, list_files, read_text, write_text

BATCH = "situation_date"
_RECORDS, _RUNNING = "_batches", "running-"

# Numbers, each held by all that follow; whole numbers above 2^53 are rounded where a day has fractions.
_NUMBERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType())


class SchemaConflict(ValueError):
    """A column has types in two days that no common type holds."""


@dataclass(frozen=True)
class Batch:
    """What is known of a stored day: `schema` is without the column of the day itself."""

    day: str
    delivery: str
    schema: T.StructType


def widened(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type for values of both; nested types only meet their own kind."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if one in _NUMBERS and other in _NUMBERS:
        wide = _NUMBERS[max(_NUMBERS.index(one), _NUMBERS.index(other))]
        # Float does not hold the integers below it.
        return T.DoubleType() if isinstance(wide, T.FloatType) else wide
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    binary = isinstance(one, T.BinaryType) or isinstance(other, T.BinaryType)
    if binary or not (isinstance(one, T.AtomicType) and isinstance(other, T.AtomicType)):
        raise SchemaConflict(f"column {name} is {one.simpleString()} in one batch and {other.simpleString()} in another")
    return T.StringType()


def merged(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns in the order in which the schemas bring them, in types that hold every schema's values."""

    def join(one: T.StructType, other: T.StructType) -> T.StructType:
        kinds = {f.name: f.dataType for f in one.fields}
        for f in other.fields:
            kinds[f.name] = widened(f.name, kinds[f.name], f.dataType) if f.name in kinds else f.dataType
        return T.StructType([T.StructField(n, k) for n, k in kinds.items()])

    return reduce(join, schemas, T.StructType())


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/{_RECORDS}"


def begin(spark: SparkSession, path: str) -> str:
    """Mark the start of a write; `finish` takes the marker away."""
    marker = f"{_folder(path)}/{_RUNNING}{uuid.uuid4().hex}"
    write_text(spark, marker, "")
    return marker


def finish(spark: SparkSession, path: str, marker: str, days: Iterable[str], schema: T.StructType) -> None:
    """Record the days just written, then end the write that `marker` stands for."""
    plain = T.StructType([f for f in schema.fields if f.name != BATCH])
    for day in days:
        said = {"delivery": uuid.uuid4().hex, "schema": plain.jsonValue()}
        write_text(spark, f"{_folder(path)}/{day}.json", json.dumps(said))
    delete_path(spark, marker)


def forget(spark: SparkSession, path: str, day: str) -> None:
    """Remove a stored day, its record first."""
    delete_path(spark, f"{_folder(path)}/{day}.json")
    delete_path(spark, f"{path.rstrip('/')}/{BATCH}={day}")


def batches(spark: SparkSession, path: str) -> list[Batch]:
    """The stored days in their order. Reads a small file per day; days without record, one file's footer."""
    records = {name: place for name, place in list_files(spark, _folder(path))}
    trusted = not any(name.startswith(_RUNNING) for name in records)
    found = []
    for name, place in sorted(list_files(spark, path, folders=True)):
        key, _, day = name.partition("=")
        if key != BATCH:
            continue
        if trusted and f"{day}.json" in records:
            said = json.loads(read_text(spark, records[f"{day}.json"]))
            found.append(Batch(day, said["delivery"], T.StructType.fromJson(said["schema"])))
        elif list_files(spark, place):
            found.append(Batch(day, "", spark.read.parquet(place).schema))
    return found


def as_schema(rows: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The schema's columns, in its types; those that the rows lack are null. `keep` are columns left as they are."""
    have = {f.name: f.dataType for f in rows.schema.fields}

    def one(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        column = F.col(f"`{f.name}`")
        return column if have[f.name] == f.dataType else column.cast(f.dataType).alias(f.name)

    return rows.select(*map(one, schema.fields), *keep)


def scan(spark: SparkSession, path: str, days: Iterable[str] | None = None, known: list[Batch] | None = None) -> DataFrame:
    """All days, or the named ones, as one frame: the merged columns, then the day.

    The schema is that of all stored days whichever are read. A day without a column has nulls there; days stored with
    one schema are read together.
    """
    stored = batches(spark, path) if known is None else known
    schema = merged(b.schema for b in stored)
    wanted = None if days is None else set(map(str, days))
    groups: dict[str, list[Batch]] = {}
    for batch in stored:
        if wanted is None or batch.day in wanted:
            groups.setdefault(batch.schema.json(), []).append(batch)
    day = T.StructField(BATCH, T.DateType())
    parts = []
    for group in groups.values():
        physical = T.StructType([*group[0].schema.fields, day])
        reader = spark.read.schema(physical)
        if len(group) == len(stored):
            rows = reader.parquet(path)
        else:
            rows = reader.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{BATCH}={b.day}" for b in group])
        parts.append(as_schema(rows, schema, (BATCH,)))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, day]))
    return reduce(DataFrame.unionByName, parts)
