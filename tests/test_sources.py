import datetime as dt
import logging

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.session import fresh_path, shared_folder
from sedimark.functions import safe_cast
from sedimark.sources import catalog, files, sinks
from sedimark.sources.layout import Layout
from sedimark.streaming.landing import ingest_arrivals

ODD = [
    (1, " padded ", dt.datetime(2024, 1, 1, 0, 0, 7, 179575), 0.1),
    (2, "", None, None),
    (3, 'quote " and, comma', dt.datetime(2024, 1, 1), -1e-300),
    (4, None, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), 1e300),
]
ODD_SCHEMA = "id int, text string, at timestamp_ntz, x double"


def test_csv_gives_back_what_was_written(spark, tmp_path):
    rows = spark.createDataFrame(ODD, ODD_SCHEMA)
    assert sinks.write_csv(rows, str(tmp_path / "c")) == 4
    back, bad = files.split_corrupt(files.read_csv(spark, str(tmp_path / "c"), rows.schema).cache())
    expected = [tuple(None if v == "" else v for v in row) for row in ODD]
    assert sorted(map(tuple, back.collect())) == expected
    assert bad.count() == 0


def test_csv_of_zoned_timestamps(spark, tmp_path):
    rows = spark.sql("SELECT timestamp'2024-01-01 10:00:00.123456' AS at")
    sinks.write_csv(rows, str(tmp_path / "c"))
    back, _ = files.split_corrupt(files.read_csv(spark, str(tmp_path / "c"), rows.schema))
    assert back.first() == rows.first()


def test_unreadable_lines_are_kept_aside(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,n\n1,5\n2,five\n3,7\n")
    lines = files.read_csv(spark, str(tmp_path / "in.csv"), T.StructType.fromDDL("id int, n int")).cache()
    rows, bad = files.split_corrupt(lines)
    assert [tuple(r) for r in rows.collect()] == [(1, 5), (2, None), (3, 7)]
    assert [r[0] for r in bad.collect()] == ["2,five"]


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,n\n1,5\n2,\n")
    assert [f.dataType.simpleString() for f in files.read_csv(spark, str(tmp_path / "in.csv")).schema] == ["int", "int"]


def test_parquet_row_counts(spark, tmp_path):
    rows = spark.range(100).repartition(7)
    assert sinks.write_parquet(rows, str(tmp_path / "a"), files=2) == 100
    assert len(list((tmp_path / "a").glob("*.parquet"))) == 2
    assert sinks.write_parquet(rows, str(tmp_path / "b"), even=True) == 100
    assert sinks.write_parquet(rows.limit(0), str(tmp_path / "a")) == 0
    assert files.read_parquet(spark, str(tmp_path / "a")).count() == 0
    parted = rows.withColumn("p", F.col("id") % 3)
    assert sinks.write_parquet(parted, str(tmp_path / "c"), partitions=["p"]) == 100
    with pytest.raises(ValueError, match="either"):
        sinks.write_parquet(rows, str(tmp_path / "d"), files=1, even=True)


def test_materialized_table(spark):
    made, rows = sinks.materialized(spark.range(10), "t")
    assert rows == 10 and made.count() == 10 and "FileScan" in made._jdf.queryExecution().executedPlan().toString()
    assert fresh_path(spark, "t").startswith(shared_folder(spark))


def test_jdbc_options():
    options = sinks.jdbc_options({"url": "jdbc:x", "batchsize": "5"}, "t")
    assert options == {"url": "jdbc:x", "dbtable": "t", "truncate": "true", "batchsize": "5", "numPartitions": "8"}
    with pytest.raises(ValueError, match="url"):
        sinks.jdbc_options({}, "t")


def test_failed_jdbc_export_goes_to_csv(spark, tmp_path, caplog):
    """No database is needed: the driver class does not exist."""
    rows = spark.range(3)
    target = {"url": "jdbc:none://x", "driver": "no.such.Driver"}

    def send():
        return sinks.write_jdbc(rows, "t", target)

    with caplog.at_level(logging.ERROR):
        done = sinks.write_or_divert(send, lambda: sinks.write_csv(rows, str(tmp_path / "t")), "export of t")
    assert done == (3, True) and "export of t failed" in caplog.text
    with pytest.raises(Exception, match="no.such.Driver"):
        sinks.write_or_divert(send, None, "export of t")


def test_kept_frames_are_released(spark):
    with sinks.kept(spark.range(5)) as rows:
        assert rows.count() == 5 and rows.storageLevel.useMemory
    assert not rows.storageLevel.useMemory


def test_external_table(spark, tmp_path):
    rows = spark.range(6).select("id", F.array("id").alias("list"), (F.col("id") % 2).alias("p"))
    path = str(tmp_path / "it's")
    rows.write.parquet(path)
    catalog.create_database(spark, "sources_test")
    catalog.create_database(spark, "sources_test")
    for _ in range(2):
        table = catalog.register_external(spark, "sources_test.t", path, rows.schema)
    assert table.count() == 6
    assert [r["tableName"] for r in catalog.list_tables(spark, "sources_test").collect()] == ["t"]
    described = {r["col_name"]: r["data_type"] for r in catalog.describe(spark, "sources_test.t").collect()}
    assert described == {"id": "bigint", "list": "array<bigint>", "p": "bigint"}
    assert catalog.peek(spark, "sources_test.t").count() == 3
    spark.sql("DROP TABLE sources_test.t")
    assert spark.read.parquet(path).count() == 6


def test_partitioned_external_table(spark, tmp_path):
    rows = spark.range(6).withColumn("p", F.col("id") % 2)
    path = str(tmp_path / "t")
    rows.write.partitionBy("p").parquet(path)
    catalog.create_database(spark, "sources_test")
    table = catalog.register_external(spark, "sources_test.parted", path, rows.schema, ["p"])
    assert table.where("p = 1").count() == 3


def test_select_available(spark):
    rows = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert catalog.select_available(rows, ["a", "zz"], ["b"]).columns == ["a", "b"]
    assert catalog.select_available(rows, ["a"], ["b"]).count() == 1
    with pytest.raises(ValueError, match="c"):
        catalog.select_available(rows, ["a"], ["c"])


def test_layout():
    layout = Layout("s3://x/root/")
    assert (layout.bronze, layout.silver) == ("s3://x/root/bronze", "s3://x/root/silver")
    assert layout.gold("state_stats") == "s3://x/root/gold/state_stats"


def test_shared_folder_must_be_named_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_folder(Session())


def test_arrivals_are_ingested_once(spark, tmp_path):
    landing, bronze, progress = (str(tmp_path / p) for p in ("landing", "bronze", "progress"))
    (tmp_path / "landing").mkdir()
    schema = T.StructType.fromDDL("ID int, `Temp(F)` double")
    (tmp_path / "landing" / "one.csv").write_text("ID,Temp(F)\n1,1.5\n2,\n")
    assert ingest_arrivals(spark, landing, schema, bronze, progress, "2025-01-01") == 2
    assert ingest_arrivals(spark, landing, schema, bronze, progress, "2025-01-02") == 0
    (tmp_path / "landing" / "two.csv").write_text("ID,Temp(F)\n3,2.5\n")
    assert ingest_arrivals(spark, landing, schema, bronze, progress, "2025-01-02") == 1
    stored = files.read_parquet(spark, bronze)
    found = sorted((r["id"], r["temp_f"], str(r["situation_date"])) for r in stored.collect())
    assert found == [(1, 1.5, "2025-01-01"), (2, None, "2025-01-01"), (3, 2.5, "2025-01-02")]


def test_csv_with_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "one\ntwo"), (2, "plain")], "id int, t string")
    sinks.write_csv(rows, str(tmp_path / "csv"))
    back, _ = files.split_corrupt(files.read_csv(spark, str(tmp_path / "csv"), rows.schema, multi_line=True))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_long_numbers_keep_their_digits(spark):
    rows = spark.createDataFrame([("9007199254740993",), ("5.0",), ("x",)], "n string")
    got = rows.select(safe_cast("n", T.StringType(), "bigint").alias("n")).collect()
    assert [r[0] for r in got] == [9007199254740993, 5, None]
