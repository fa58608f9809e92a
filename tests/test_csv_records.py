import csv
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.plans import catalogue
from sedimark.sources import csv_records, files, sinks
from sedimark.sources.csv_records import read_csv_records, read_records

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


@pytest.fixture()
def small_splits(spark):
    """Splits of some bytes, so that borders fall everywhere."""

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield use
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def written(path, rows, end="\n"):
    with open(path, "w", newline="") as out:
        made = csv.writer(out, lineterminator=end, doublequote=False, escapechar="\\", quoting=csv.QUOTE_ALL)
        made.writerow(["id", "a", "b"])
        made.writerows(rows)


def values(rng):
    pieces = ["x", "yy", "\n", "\n\n", ",", '"', " ", "é", "\r\n", "a long piece of text"]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))


@pytest.mark.parametrize("size", [7, 16, 33, 64, 257, 100_000])
def test_records_at_any_split_border(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    rows = [(i, "v" + values(rng) + "w", "v" + values(rng) + "w") for i in range(60)]
    written(tmp_path / "one.csv", rows[:40])
    written(tmp_path / "two.csv", rows[40:])
    small_splits(size)
    got = read_csv_records(spark, str(tmp_path), SCHEMA)
    assert sorted((r.id, r.a, r.b) for r in got.collect()) == rows
    assert got.where(F.col(files.CORRUPT).isNotNull()).count() == 0
    if size < 100:
        assert got.rdd.getNumPartitions() > 8


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    rows = [(1, "a", "b"), (2, "line\n" * 500, "b\n\nc"), (3, "c", "d\n")]
    written(tmp_path / "long.csv", rows)
    small_splits(100)
    got = sorted((r.id, r.a, r.b) for r in read_csv_records(spark, str(tmp_path), SCHEMA).collect())
    assert got == rows


def test_the_reader_of_one_task_gives_the_same(spark, tmp_path, small_splits):
    """Written by Spark, with nulls, empty text, quotes and escapes."""
    rows = spark.range(300).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 7 > 0, F.concat_ws("\n", F.lit('say "x"'), F.col("id").cast("string"), F.lit("a\\b"))).alias("a"),
        F.when(F.col("id") % 5 > 0, F.lit("p,q")).alias("b"),
    )
    sinks.write_csv(rows.coalesce(1), str(tmp_path / "csv"))
    one = files.read_csv(spark, str(tmp_path / "csv"), SCHEMA, multi_line=True).collect()
    small_splits(200)
    many = read_csv_records(spark, str(tmp_path / "csv"), SCHEMA)
    assert many.columns == ["id", "a", "b", files.CORRUPT]
    assert sorted(many.collect(), key=repr) == sorted(one, key=repr)


def test_unreadable_records_and_line_ends(spark, tmp_path, small_splits):
    (tmp_path / "odd.csv").write_bytes(b'id,a,b\r\n1,"x\r\ny",b\r\nzwei,"c\nd",e\r\n\r\n3,f,g')
    small_splits(9)
    got = sorted((tuple(r) for r in read_csv_records(spark, str(tmp_path), SCHEMA).collect()), key=repr)
    assert got == sorted([(1, "x\r\ny", "b", None), (None, "c\nd", "e", 'zwei,"c\nd",e'), (3, "f", "g", None)], key=repr)


def test_files_without_records(spark, tmp_path):
    Path(tmp_path / "empty.csv").write_text("")
    Path(tmp_path / "header.csv").write_text("id,a,b\n")
    assert read_csv_records(spark, str(tmp_path), SCHEMA).count() == 0
    assert read_records(spark, str(tmp_path)).count() == 1


def test_the_task_that_writes_one_file_makes_no_rows(spark, small, plan, monkeypatch):
    """The join runs in tasks of its own; with `coalesce` it ran whole in the task that writes."""
    seen = []
    inner = sinks.write_csv

    def write_csv(df, path, **how):
        seen.append((plan(sinks._arranged(df, how.get("files"), how.get("even", False))), path))
        return inner(df, path, **how)

    monkeypatch.setattr(sinks, "write_csv", write_csv)
    back = catalogue.csv_line_breaks(spark, small)
    [(text, path)] = seen
    assert len(list(Path(path).glob("*.csv"))) == 1 and back.count() > 0
    assert "Coalesce" not in text and "Exchange SinglePartition" in text.split("Join")[0]


def test_records_of_several_lines_are_not_held():
    split = csv_records._Split("f", 1, 0)
    for _ in range(5):
        batches = split.add(pa.array(['1,"a', 'b"'] * 100), np.ones(200, np.int64))
        assert sum(b.num_rows for b in batches) == 100 and not split.rows and not split.held
    assert split.close() is None
