"""Dated batches and the cumulative snapshots they add up to.

Each batch is stored once, as the partition of its date. The snapshot of a day is every partition up to
that day, chosen by partition pruning, instead of a copy of all earlier rows per day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from sedimark.functions import label_of, portable_hash, weighted_label
from sedimark.sources import history
from sedimark.sources.history import BATCH
from sedimark.sources.sinks import observed


def tag_batch(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(BATCH, F.to_date(F.lit(day)))


def spread_over_days(df: DataFrame, weights: Mapping[str, float], keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Give every row one of the days by weight, from its key alone, in the same pass that reads it."""
    hashed = df.withColumn("__digest", portable_hash(keys, seed, "batch"))
    days = [(F.to_date(F.lit(day)), share) for day, share in weights.items()]
    return hashed.withColumn(BATCH, label_of(F.col("__digest"), days)).drop("__digest")


def split_by_weight(
    df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int = 42, purpose: str = "batch"
) -> list[DataFrame]:
    """Disjoint parts that together hold every row; a row's part depends on its key, not on its place."""
    label = weighted_label(keys, {str(i): w for i, w in enumerate(weights)}, seed, purpose)
    return [df.where(label == str(i)) for i in range(len(weights))]


def append_batch(history: DataFrame, batch: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column only one side has is null on the other."""
    return history.unionByName(batch, allowMissingColumns=True)


def write_batches(df: DataFrame, path: str, max_rows_per_file: int = 0, rebalance: bool = False) -> list[str]:
    """Store batches by date. Dates present in `df` are replaced, all others stay: a re-run is safe. Returns the
    dates written.

    By default rows are written where they are, without a shuffle. `rebalance` merges small and splits
    large dates into even files, at the cost of one. The days' schema is recorded beside them, see `history`.
    """
    spark, seen = df.sparkSession, Observation()
    marker = history.begin(spark, path)
    # One value per day.
    days = df.observe(seen, F.collect_set(F.col(BATCH).cast("string")).alias("days"))
    arranged = days.hint("rebalance", BATCH) if rebalance else days
    writer = arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)
    written = sorted(observed(seen).get("days", []))
    history.finish(spark, path, marker, written, df.schema)
    return written


def snapshot(bronze: DataFrame, day: str | dt.date | None = None) -> DataFrame:
    """All rows known on `day`; without a day, the latest state."""
    if day is None:
        return bronze
    return bronze.where(F.col(BATCH) <= F.lit(str(day)).cast("date"))


def growth(bronze: DataFrame) -> DataFrame:
    """Rows added by each batch and rows of each snapshot; ordered by day.

    The running total is over one row per day, after aggregation.
    """
    added = bronze.groupBy(BATCH).agg(F.count(F.lit(1)).alias("added_rows"))
    so_far = Window.orderBy(BATCH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return added.withColumn("snapshot_rows", F.sum("added_rows").over(so_far)).orderBy(BATCH)
