"""Catalog tables over written files, created in the session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def column_ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE; every type keeps its own name, nested ones too."""
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")


def register_external(
    spark: SparkSession, table: str, path: str, schema: T.StructType, partitions: Sequence[str] = ()
) -> DataFrame:
    """(Re)create a table over Parquet files that stay where they are when the table is dropped."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    by = f" PARTITIONED BY ({', '.join(map(quoted, partitions))})" if partitions else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {quoted(table)} ({column_ddl(schema)}) USING parquet{by} LOCATION '{location}'")
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")
    return spark.table(table)


def location_of(spark: SparkSession, table: str) -> str | None:
    """Where a table's files lie; None without such a table."""
    if not spark.catalog.tableExists(table):
        return None
    said = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'").first()
    return said["data_type"] if said else None


def _same_columns(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]


def switch_external(spark: SparkSession, table: str, path: str, schema: T.StructType) -> DataFrame:
    """Point a table to other files; it is never absent in between unless its columns change."""
    if location_of(spark, table) is None or not _same_columns(spark, table, schema):
        return register_external(spark, table, path, schema)
    location = path.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def sync_external(
    spark: SparkSession, table: str, path: str, schema: T.StructType, partitions: Sequence[str]
) -> DataFrame:
    """Make a partitioned table show the partitions its folder has now; it is created where it is not there yet."""
    where = location_of(spark, table)
    if where is None or not where.rstrip("/").endswith(path.split(":", 1)[-1].rstrip("/")) or not _same_columns(spark, table, schema):
        return register_external(spark, table, path, schema, partitions)
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a database, without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {quoted(database)}").where("NOT isTemporary")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def describe(spark: SparkSession, table: str) -> DataFrame:
    """col_name, data_type, comment."""
    return spark.sql(f"DESCRIBE TABLE {quoted(table)}")


def peek(spark: SparkSession, table: str, rows: int = 3) -> DataFrame:
    return spark.table(table).limit(rows)


def select_available(df: DataFrame, wanted: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Wanted columns the frame has, with rows whose required columns are present.

    A missing required column is an error; any other missing column is left out.
    """
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"required columns are missing: {absent}")
    chosen = [c for c in wanted if c in df.columns]
    chosen += [c for c in required if c not in chosen]
    filled = df
    for name in required:
        filled = filled.where(F.col(name).isNotNull())
    return filled.select(*chosen)
