import math

import pytest
from pyspark.sql import functions as F

from sedimark.operators.cleaning import clean, quality_report
from sedimark.operators.dedup import keep_first, keep_first_sparse
from sedimark.operators.filling import fill_defaults, fill_from_column
from sedimark.operators.validity import require, within
from sedimark.profile import INCIDENTS, RAW_COLUMNS
from sedimark.sources.files import raw_schema
from sedimark.sources.fixtures import PROFILE, incidents_bronze

NAN = float("nan")
SCHEMA = (
    "id string, severity int, state string, start_lat double, start_lng double, start_time timestamp_ntz, "
    "end_lat double, city string, weather_condition string, temperature_f double, copy_no int"
)


def record(spark, *changes):
    import datetime as dt

    base = {
        "id": "a", "severity": 2, "state": " ca ", "start_lat": 30.0, "start_lng": -100.0,
        "start_time": dt.datetime(2024, 1, 1), "end_lat": None, "city": "X", "weather_condition": None,
        "temperature_f": None, "copy_no": 0,
    }
    rows = [tuple({**base, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("column", INCIDENTS.required)
def test_each_required_column(spark, column):
    rows = record(spark, {}, {column: None})
    assert require(rows, INCIDENTS.required).count() == 1


def test_nan_is_present_but_out_of_range(spark):
    rows = record(spark, {"start_lat": NAN})
    assert require(rows, INCIDENTS.required).count() == 1
    assert within(rows, INCIDENTS.ranges).count() == 0


@pytest.mark.parametrize(
    ("column", "inside", "outside"),
    [
        ("severity", [1, 4], [0, 5, None]),
        ("start_lat", [24.0, 50.0], [23.99, 50.01, None]),
        ("start_lng", [-130.0, -65.0], [-130.01, -64.99, None]),
    ],
)
def test_ranges_include_their_ends(spark, column, inside, outside):
    rows = record(spark, *[{column: v} for v in inside + outside])
    kept = [r[0] for r in within(rows, INCIDENTS.ranges).select(column).collect()]
    assert sorted(kept) == sorted(inside)


def test_fill_replaces_null_and_nan(spark):
    rows = spark.createDataFrame([(None, None, "x"), (NAN, "b", None)], "t double, s string, other string")
    filled = fill_defaults(rows, {"t": 1.5, "s": "?"})
    assert [tuple(r) for r in filled.collect()] == [(1.5, "?", "x"), (1.5, "b", None)]


def test_fill_of_a_missing_column(spark):
    rows = spark.createDataFrame([(None,)], "t double")
    with pytest.raises(ValueError, match="gone"):
        fill_defaults(rows, {"gone": 1.0})
    assert fill_defaults(rows, {"gone": 1.0, "t": 2.0}, only_present=True).first()[0] == 2.0


def test_fill_of_numbers_kept_as_text(spark):
    rows = spark.createDataFrame([(None,), ("3",)], "t string")
    assert [r[0] for r in fill_defaults(rows, {"t": 70.0}).collect()] == ["70.0", "3"]


def test_fallback_column(spark):
    rows = record(spark, {}, {"end_lat": 31.0})
    assert [r[0] for r in fill_from_column(rows, {"end_lat": "start_lat"}).select("end_lat").collect()] == [30.0, 31.0]


def test_bad_first_copy_removes_its_good_copy(spark):
    rows = record(spark, {"severity": 9, "copy_no": 0}, {"severity": 2, "copy_no": 1}, {"id": "b"})
    assert [r["id"] for r in clean(rows, PROFILE).collect()] == ["b"]


def test_survivor_does_not_depend_on_layout(spark):
    rows = record(spark, *[{"city": c, "severity": s} for c in "ABC" for s in (3, 1, 2)])
    profile = INCIDENTS
    found = {
        tuple(clean(rows.repartition(n), profile).select("city", "severity").first()) for n in (1, 2, 3, 7)
    }
    assert found == {("A", 1)}


def test_clean_fills_then_normalises(spark):
    row = clean(record(spark, {}), PROFILE).first()
    assert (row["state"], row["weather_condition"], row["temperature_f"], row["end_lat"]) == ("CA", "CLEAR", 70.0, 30.0)


def test_clean_of_clean_is_the_same(spark, silver):
    again = clean(silver, PROFILE)
    assert silver.exceptAll(again).count() == 0 and again.count() == silver.count()


def test_clean_of_nothing(spark):
    assert clean(record(spark, {}).limit(0), PROFILE).count() == 0


def test_strict_cleaning_wants_every_column(spark):
    with pytest.raises(ValueError, match="description"):
        clean(record(spark, {}), PROFILE, strict=True)


def test_missing_required_column_is_an_error(spark):
    with pytest.raises(ValueError, match="state"):
        clean(record(spark, {}).drop("state"), PROFILE)


def test_clean_of_the_raw_source_layout(spark):
    lines = spark.createDataFrame([tuple([None] * len(RAW_COLUMNS))], raw_schema())
    assert len(RAW_COLUMNS) == 46
    made = clean(lines.withColumn("situation_date", F.current_date()), INCIDENTS, strict=True)
    assert len(made.columns) == 47 and made.columns[2:6] == ["severity", "start_time", "end_time", "start_lat"]


def test_quality_report_of_nothing(spark):
    row = quality_report(record(spark, {}).limit(0), PROFILE).first()
    assert (row["initial_rows"], row["final_rows"], row["removed_percent"]) == (0, 0, 0.0)


@pytest.mark.parametrize("profile", [PROFILE, INCIDENTS])
def test_quality_report_agrees_with_clean(spark, small, profile):
    bronze = incidents_bronze(spark, small)
    row = quality_report(bronze, profile).first()
    assert row["initial_rows"] == bronze.count()
    assert row["final_rows"] == clean(bronze, profile).count()
    assert math.isclose(row["removed_percent"], 100 * row["removed_rows"] / row["initial_rows"])


def copies(spark, rows=3000):
    """Key 0 holds a third of all rows; the other keys are unique or come in pairs."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, F.col("id") - F.col("id") % 2)
    return spark.range(rows).select(key.alias("k"), "id", (F.col("id") * 7 % 11).alias("v")).withColumn(
        "k", F.coalesce("k", "id")
    )


def test_sparse_dedup_equals_ranking(spark):
    rows = copies(spark)
    ranked = keep_first(rows, "k", ["v", "id"])
    sparse = keep_first_sparse(rows, "k", ["v", "id"])
    best = {}
    for r in sorted(rows.collect(), key=lambda r: (r["k"], r["v"], r["id"])):
        best.setdefault(r["k"], tuple(r))
    assert sorted(map(tuple, ranked.collect())) == sorted(best.values())
    assert sorted(map(tuple, sparse.collect())) == sorted(best.values())


def test_sparse_dedup_ranks_copies_only(spark, plan):
    text = plan(keep_first_sparse(copies(spark), "k", ["v", "id"]))
    assert "LeftAnti" in text and "LeftSemi" in text
    assert text.index("LeftSemi") > text.index("WindowGroupLimit")


def test_quality_report_does_not_sort_to_aggregate(spark, small, plan):
    assert "SortAggregate" not in plan(quality_report(incidents_bronze(spark, small), PROFILE))


def test_text_that_is_no_number_costs_its_row_only(spark):
    rows = record(spark, {"id": "1"}, {"id": "2"}, {"id": "3"})
    text = rows.withColumn("severity", F.when(F.col("id") == "2", "n/a").otherwise(F.col("severity").cast("string")))
    assert sorted(r["id"] for r in clean(text, PROFILE).collect()) == ["1", "3"]
    report = quality_report(text, PROFILE).first()
    assert (report["initial_rows"], report["distinct_rows"], report["final_rows"]) == (3, 3, 2)


def test_ranking_limits_groups_before_the_shuffle(spark, plan):
    text = plan(keep_first(copies(spark), "k", ["v", "id"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_unread_columns_are_not_shuffled_for_a_total_order(spark, small, plan):
    bronze = incidents_bronze(spark, small)
    needed = plan(clean(bronze, PROFILE).groupBy("state").count())
    assert "city" not in needed and "temperature_f" not in needed
    assert "temperature_f" in plan(clean(bronze, INCIDENTS).groupBy("state").count())
