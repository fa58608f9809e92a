"""Session construction and the shared folder used for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Cluster sizing (executors, memory, shuffle partitions) stays with spark-submit; these are semantics,
# the adaptive features every job relies on, and plan-building cost.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python call site of every column expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str, master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Session with UTC timestamps and adaptive execution; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Root for written intermediates: the cluster's checkpoint folder.

    Only a local master may fall back to a temporary folder, because there the driver and the
    executors are one machine; anywhere else a missing setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if named:
        return named
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sedimark-"))
    return context.getCheckpointDir()


_OPEN: ContextVar[list[str] | None] = ContextVar("sedimark_intermediates", default=None)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses; see `intermediates` for its removal."""
    path = f"{shared_folder(spark).rstrip('/')}/sedimark/{label}-{uuid.uuid4().hex}"
    made = _OPEN.get()
    if made is not None:
        made.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.listStatus(where) if system.exists(where) else []
    return [entry.getPath().toString() for entry in found if entry.isDirectory()]


def list_files(spark: SparkSession, path: str, folders: bool = False) -> list[tuple[str, str]]:
    """(name, path) of the files, or the folders, that lie directly in a folder; none if it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [entry for entry in system.listStatus(where) if entry.isDirectory() == folders] if system.exists(where) else []
    return [(entry.getPath().getName(), entry.getPath().toString()) for entry in found]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, such as a record of what a job has done."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Own the intermediate tables made inside: they are removed at the end, also after a failure.

    Frames that read them must be done by then, so results are written or gathered inside.
    """
    made: list[str] = []
    token = _OPEN.set(made)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in made:
            delete_path(spark, path)
