"""Writes that report their row count without a second evaluation of the plan.

The count is taken on the rows handed to the writer, in the tasks that write, which Spark counts once
each even when a task is retried.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from sedimark.session import fresh_path

log = logging.getLogger(__name__)

# Spark's defaults for CSV trim spaces and cut timestamps to milliseconds.
CSV_EXACT = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def observed(seen: Observation) -> dict:
    """What was observed; nothing where adaptive execution found no rows and left the observing step out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        return {}


def _counted(df: DataFrame, save: Callable[[DataFrameWriter], None]) -> int:
    seen = Observation()
    save(df.observe(seen, F.count(F.lit(1)).alias("rows")).write)
    return int(observed(seen).get("rows", 0))


def _arranged(df: DataFrame, files: int | None, even: bool) -> DataFrame:
    if files and even:
        raise ValueError("choose either a number of files or even files")
    if even:
        return df.hint("rebalance")
    return df.coalesce(files) if files else df


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partitions: Sequence[str] = (),
    files: int | None = None,
    even: bool = False,
) -> int:
    """Rows written.

    `files` merges the output into that many files at most, for results of bounded size only: the
    last stage then runs in as many tasks. Others are repartitioned before. `even` lets adaptive execution choose files of even size.
    """
    return _counted(_arranged(df, files, even), lambda w: w.mode(mode).partitionBy(*partitions).parquet(path))


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None, even: bool = False
) -> int:
    """Rows written; see `write_parquet`.

    Reading with the same schema gives the rows back, but for empty text, which reads as null; text with line
    breaks needs a reader with `multi_line`.
    """
    return _counted(_arranged(df, files, even), lambda w: w.mode(mode).options(**CSV_EXACT).csv(path))


def materialized(df: DataFrame, label: str, even: bool = False) -> tuple[DataFrame, int]:
    """The frame as a table written in the shared folder, and its row count.

    Later readers start from the files: nothing before the write runs again, even if executors are lost.
    """
    path = fresh_path(df.sparkSession, label)
    rows = write_parquet(df, path, even=even)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def jdbc_options(connection: Mapping[str, str], table: str, connections: int = 8, batch: int = 10_000) -> dict[str, str]:
    """Writer options: given settings win; the table keeps its definition, connections are limited."""
    if "url" not in connection:
        raise ValueError("a JDBC target needs a url")
    limits = {"truncate": "true", "batchsize": str(batch), "numPartitions": str(connections)}
    return {**limits, **connection, "dbtable": table}


def write_jdbc(df: DataFrame, table: str, connection: Mapping[str, str], mode: str = "overwrite") -> int:
    """Rows sent. `connection` holds url, driver, user, password as the caller got them."""
    options = jdbc_options(connection, table)
    return _counted(df, lambda w: w.format("jdbc").options(**options).mode(mode).save())


def write_or_divert(primary: Callable[[], int], fallback: Callable[[], int] | None, what: str) -> tuple[int, bool]:
    """(rows, whether the fallback was used). A failure without a fallback is raised."""
    try:
        return primary(), False
    except Exception:
        if fallback is None:
            raise
        log.exception("%s failed, using the fallback", what)
        return fallback(), True


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist a frame that several jobs read, and release it afterwards."""
    stored = df.persist(level)
    try:
        yield stored
    finally:
        stored.unpersist()
