"""Daily batches from a landing folder, with Structured Streaming keeping track of ingested files.

A call is a delivery of one day. Its micro-batches are staged under their ids, and when the stream has ended, the
delivery takes the day's place in Bronze, as a batch job's write does. A ledger beside the checkpoint says which day is
being delivered and whether that was done, so an interrupted call is taken up by the next one: files that the
checkpoint counts as read are in the stage.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sedimark.functions import tidy_names
from sedimark.operators.snapshots import tag_batch, write_batches
from sedimark.session import delete_path, list_files, path_exists, read_text, write_text
from sedimark.sources.files import CORRUPT
from sedimark.sources.history import as_schema, merged
from sedimark.sources.sinks import write_parquet


class Delivery:
    """The ledger and the stage of a landing folder's deliveries, in its progress folder."""

    def __init__(self, spark: SparkSession, progress: str) -> None:
        self.spark, self.root = spark, progress.rstrip("/")
        self.ledger, self.stage, self.checkpoint = (f"{self.root}/{n}" for n in ("ledger.json", "staged", "checkpoint"))

    def state(self) -> dict:
        return json.loads(read_text(self.spark, self.ledger)) if path_exists(self.spark, self.ledger) else {}

    def _note(self, **state) -> None:
        write_text(self.spark, self.ledger, json.dumps(state))

    def open(self, day: str, bronze: str) -> None:
        """Start the delivery of a day. An interrupted one of another day is completed first, one of this day goes on."""
        state = self.state()
        if state.get("published"):
            delete_path(self.spark, self.stage)
        elif state and (state["day"], state["bronze"]) != (day, bronze):
            self.publish()
            delete_path(self.spark, self.stage)
        self._note(day=day, bronze=bronze, published=False)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Stage a micro-batch; one that comes again takes its own place."""
        write_parquet(rows, f"{self.stage}/batch-{batch_id}")

    def publish(self) -> int:
        """Put all staged rows in the place of the day. Returns their number; without any, the day stays as it is."""
        state = self.state()
        parts = [self.spark.read.parquet(place) for _, place in sorted(list_files(self.spark, self.stage, folders=True))]
        rows = 0
        if parts:
            # Batches of an interrupted call may have been read by an earlier schema.
            schema = merged(p.schema for p in parts)
            union = reduce(DataFrame.unionByName, [as_schema(p, schema) for p in parts])
            rows = union.count()
            if rows:
                write_batches(tag_batch(union, state["day"]), state["bronze"], rebalance=True)
        self._note(**{**state, "published": True})
        return rows


def ingest_arrivals(
    spark: SparkSession, landing: str, schema: T.StructType, bronze: str, progress: str, day: str
) -> int:
    """The CSV files that arrived since the last call become the batch of `day` in Bronze.

    Returns the number of rows. A day that was there before is replaced; a call that finds no new files leaves it. Every
    file counts once, also when a call is interrupted and made again. Bronze may be filled by batch jobs as well. Lines
    that do not parse are kept with their text, as in the batch job.
    """
    delivery = Delivery(spark, progress)
    delivery.open(day, bronze)
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(kept).option("header", True)
    lines = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(landing)
    arrivals = (
        tidy_names(lines)
        .writeStream.foreachBatch(delivery.add)
        .option("checkpointLocation", delivery.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    arrivals.awaitTermination()
    rows = delivery.publish()
    delete_path(spark, delivery.stage)
    return rows

