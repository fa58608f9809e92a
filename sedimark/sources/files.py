"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.functions import tidy_name
from sedimark.profile import INCIDENTS, RAW_COLUMNS

CORRUPT = "_corrupt_record"


def raw_schema(columns: tuple[str, ...] = RAW_COLUMNS) -> T.StructType:
    """Declared types of the source columns, by the profile's type of their tidy name; else text."""
    kinds = {"int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
    return T.StructType(
        [T.StructField(c, kinds.get(INCIDENTS.types.get(tidy_name(c), ""), T.StringType())) for c in columns]
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header. A schema avoids the extra pass that inference needs; without one it is inferred.

    With a schema, text that does not parse becomes null and the whole line is kept in
    `_corrupt_record`; see `split_corrupt`. `multi_line` reads values that contain line breaks; a file is then
    read by one task, other than by `csv_records.read_csv_records`.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        reader.schema(kept)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all rows without the corrupt-line column, the unreadable lines).

    The second needs a stored or persisted frame: Spark cannot tell bad lines from a pruned CSV scan. It is empty
    for a frame that was read without keeping such lines.
    """
    if CORRUPT not in df.columns:
        return df, df.select(F.lit(None).cast("string").alias(CORRUPT)).limit(0)
    return df.drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
