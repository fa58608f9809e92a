"""Written intermediates of the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimark.session import fresh_path


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The frame, written to the shared folder and read from there.

    Later steps start from the files, which survive lost executors; nothing before runs a second time.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, label: str, compression: str = "snappy", **measures) -> tuple[DataFrame, dict]:
    """`stored`, with aggregates of the rows taken by the tasks that write them."""
    seen = Observation()
    kept = stored(df.observe(seen, *[m.alias(n) for n, m in measures.items()]), label, compression)
    return kept, seen.get


def remove(df: DataFrame) -> None:
    """Delete the files of a stored frame that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_fold(column: str, modulus: int) -> F.Column:
    """crc32 of the key's decimal text, modulo `modulus`; null keys count as the text 'null'."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % modulus
