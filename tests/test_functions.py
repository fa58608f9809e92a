import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimark.functions import (
    below_fraction,
    condition_category,
    normalized,
    portable_hash,
    risk_level,
    tidy_name,
    tidy_names,
    weekday_of,
    weekend_flag,
    weighted_label,
)
from sedimark.operators.cleaning import cast_columns


@pytest.mark.parametrize(
    ("raw", "tidy"),
    [
        ("Temperature(F)", "temperature_f"), ("Humidity(%)", "humidity"), ("A  B", "a_b"), ("_x", "_x"),
        ("a__b", "a_b"), ("ID", "id"), ("x_ ", "x"), ("é1", "_1"),
    ],
)
def test_tidy_name(raw, tidy):
    assert tidy_name(raw) == tidy


@given(st.text(min_size=1, max_size=20))
def test_tidy_name_is_stable_and_plain(raw):
    tidy = tidy_name(raw)
    assert tidy_name(tidy) == tidy
    assert "__" not in tidy and not tidy.endswith("_")
    assert all(c == "_" or (c.isascii() and c.isalnum() and not c.isupper()) for c in tidy)


def test_colliding_names_are_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        tidy_names(spark.createDataFrame([(1, 2)], ["Wind(x)", "wind x"]))


def test_normalized_trims_spaces_only(spark):
    rows = spark.createDataFrame([(" a ",), ("\tb",), ("",), ("mIx",), (None,)], "t string")
    assert [r[0] for r in rows.select(normalized("t")).collect()] == ["A", "\tB", "", "MIX", None]


def test_casts_read_what_they_can(spark):
    rows = spark.createDataFrame(
        [("5", "1.5", "yes", "2024-01-02 03:04:05"), ("5.0", "x", "maybe", "soon"), ("x", None, "false", None)],
        "severity string, lat string, flag string, at string",
    )
    typed = cast_columns(rows, {"severity": "int", "lat": "double", "flag": "boolean", "at": "timestamp"})
    assert [f.dataType.simpleString() for f in typed.schema] == ["int", "double", "boolean", "timestamp"]
    assert [tuple(r) for r in typed.collect()] == [
        (5, 1.5, True, dt.datetime(2024, 1, 2, 3, 4, 5)), (5, None, None, None), (None, None, False, None),
    ]


def test_casts_add_no_projection_chain(spark, plan):
    typed = cast_columns(spark.range(3).withColumn("b", F.lit("1")), {"b": "int"})
    assert plan(typed).count("Project") == 1


def test_weekdays(spark):
    days = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (6, 7, 8)], "t timestamp")
    rows = days.select(weekday_of("t"), weekend_flag("t")).collect()
    assert [tuple(r) for r in rows] == [(7, 1), (1, 1), (2, 0)]
    nothing = spark.createDataFrame([(None,)], "t timestamp")
    assert nothing.select(weekend_flag("t")).first()[0] == 0


def test_risk_levels(spark):
    rows = spark.createDataFrame([(1.99,), (2.0,), (2.99,), (3.0,), (None,)], "m double")
    assert [r[0] for r in rows.select(risk_level("m")).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "LOW"]


def test_condition_categories_ignore_case(spark):
    rows = spark.createDataFrame([(" snow",), ("Rain",), ("FOG ",), ("ice",), ("Clear",), (None,)], "c string")
    found = [r[0] for r in rows.select(condition_category("c")).collect()]
    assert found == ["HIGH", "MEDIUM", "MEDIUM", "HIGH", "LOW", "LOW"]


def test_hash_choice_follows_the_share(spark):
    ids = spark.range(20000)
    share = ids.where(below_fraction(portable_hash(["id"], 1, "t"), 0.3)).count() / 20000
    assert abs(share - 0.3) < 0.02
    assert ids.where(below_fraction(portable_hash(["id"], 1, "t"), 0.0)).count() == 0
    assert ids.where(below_fraction(portable_hash(["id"], 1, "t"), 1.0)).count() == 20000


def test_hash_purposes_are_independent(spark):
    ids = spark.range(20000)
    first = ids.where(below_fraction(portable_hash(["id"], 42, "sample"), 0.2))
    both = first.where(below_fraction(portable_hash(["id"], 42, "split"), 0.5))
    assert abs(both.count() / first.count() - 0.5) < 0.05


def test_labels_need_positive_weights():
    with pytest.raises(ValueError, match="positive"):
        weighted_label(["id"], {"a": 0.0}, 1, "t")


def test_single_label_takes_all(spark):
    assert spark.range(5).select(weighted_label(["id"], {"only": 2.0}, 1, "t")).distinct().first()[0] == "only"
