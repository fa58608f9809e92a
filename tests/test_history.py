import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.operators import snapshots
from sedimark.sources import history

D1, D2, D3 = "2025-01-01", "2025-01-02", "2025-01-03"


def stored(spark, path, *days):
    """Each day's rows as DDL and tuples, written in the order given."""
    for day, ddl, rows in days:
        snapshots.write_batches(snapshots.tag_batch(spark.createDataFrame(rows, ddl), day), str(path))
    return str(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FIRST = (D1, "id bigint, a int, n int", [(1, 10, 5), (2, 20, 6)])
MORE = (D2, "id bigint, a int, n bigint, b string", [(3, 30, 2**40, "x")])
FEWER = (D3, "id bigint, n double", [(4, 0.5)])
ALL = [
    (1, 10, 5.0, None, dt.date(2025, 1, 1)), (2, 20, 6.0, None, dt.date(2025, 1, 1)),
    (3, 30, float(2**40), "x", dt.date(2025, 1, 2)), (4, None, 0.5, None, dt.date(2025, 1, 3)),
]


@pytest.mark.parametrize("order", [(FIRST, MORE, FEWER), (FEWER, MORE, FIRST), (MORE, FIRST, FEWER)])
def test_days_that_differ_in_any_order(spark, tmp_path, order):
    df = history.scan(spark, stored(spark, tmp_path / "b", *order))
    assert df.columns == ["id", "a", "n", "b", "situation_date"]
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "int", "double", "string", "date"]
    assert rows_of(df) == sorted(ALL, key=repr)


def test_a_snapshot_reads_its_days_only(spark, tmp_path, plan):
    path = stored(spark, tmp_path / "b", FIRST, MORE, FEWER)
    early = snapshots.snapshot(history.scan(spark, path), D1)
    assert rows_of(early) == [r for r in ALL if r[4] == dt.date(2025, 1, 1)]
    assert rows_of(history.scan(spark, path, [D2])) == [ALL[2]]
    # The column of a later day is there, and the other days' folders are not listed.
    assert history.scan(spark, path, [D1]).columns[3] == "b"
    assert "PartitionFilters: [isnotnull(situation_date" in plan(early)


def test_days_of_one_schema_are_one_scan(spark, tmp_path, plan):
    path = stored(spark, tmp_path / "b", FIRST, (D2, FIRST[1], [(9, 1, 1)]))
    text = plan(history.scan(spark, path))
    assert "Union" not in text and text.count("FileScan parquet") == 1


def test_a_redelivery_changes_the_schema_of_its_day(spark, tmp_path):
    path = stored(spark, tmp_path / "b", FIRST, FEWER)
    before = {b.day: b.delivery for b in history.batches(spark, path)}
    stored(spark, tmp_path / "b", (D3, "id bigint, n int", [(4, 7)]))
    df = history.scan(spark, path)
    assert dict(df.dtypes)["n"] == "int" and df.count() == 3
    after = {b.day: b.delivery for b in history.batches(spark, path)}
    assert [d for d in after if after[d] != before[d]] == [D3]


def test_records_are_not_trusted_while_a_write_is_open(spark, tmp_path):
    """A write that ended between the data and its record."""
    path = stored(spark, tmp_path / "b", FIRST, MORE)
    history.begin(spark, path)
    spark.createDataFrame([(7, "late")], "id bigint, c string").write.mode("overwrite").parquet(f"{path}/situation_date={D2}")
    df = history.scan(spark, path)
    assert df.columns == ["id", "a", "n", "c", "situation_date"] and df.where("c = 'late'").count() == 1


def test_folders_without_records(spark, tmp_path):
    path = str(tmp_path / "b")
    for day, ddl, rows in (FIRST, MORE, FEWER):
        spark.createDataFrame(rows, ddl).write.parquet(f"{path}/situation_date={day}")
    assert rows_of(history.scan(spark, path)) == sorted(ALL, key=repr)
    assert not (Path(path) / "_batches").exists()


def test_odd_batches(spark, tmp_path):
    assert history.scan(spark, str(tmp_path / "none")).columns == ["situation_date"]
    path = stored(spark, tmp_path / "b", FIRST)
    snapshots.write_batches(spark.createDataFrame([], "id bigint, z string, situation_date date"), path)
    assert history.scan(spark, path).count() == 2 and "z" not in history.scan(spark, path).columns
    snapshots.write_batches(spark.createDataFrame([(1, None)], "id bigint, situation_date date"), path)
    assert history.scan(spark, path).where("situation_date IS NULL").count() == 1


INT, LONG, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize(
    ("one", "other", "wide"),
    [
        (INT, INT, INT), (INT, LONG, LONG), (LONG, DOUBLE, DOUBLE), (T.FloatType(), INT, DOUBLE), (INT, TEXT, TEXT),
        (T.BooleanType(), INT, TEXT), (T.DateType(), T.TimestampType(), TEXT), (T.NullType(), INT, INT),
        (T.DecimalType(10, 2), T.DecimalType(6, 4), T.DecimalType(12, 4)), (T.DecimalType(38, 0), T.DecimalType(6, 4), TEXT),
        (T.ArrayType(INT), T.ArrayType(INT), T.ArrayType(INT)),
    ],
)
def test_widening(one, other, wide):
    assert history.widened("c", one, other) == wide == history.widened("c", other, one)


def test_types_without_a_common_one(spark, tmp_path):
    path = stored(spark, tmp_path / "b", FIRST, (D2, "id bigint, a array<int>", [(1, [1])]))
    with pytest.raises(history.SchemaConflict, match="column a is int in one batch and array<int> in another"):
        history.scan(spark, path)


def test_text_of_widened_values(spark, tmp_path):
    path = stored(spark, tmp_path / "b", FIRST, (D2, "id string, a boolean, n int", [("k", True, 1)]))
    got = rows_of(history.scan(spark, path).select("id", "a", F.col("n")))
    assert got == [("1", "10", 5), ("2", "20", 6), ("k", "true", 1)]
