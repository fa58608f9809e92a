import pytest
from pyspark.sql import functions as F

from sedimark.operators.paging import page_of, page_totals
from sedimark.plans.serving import MARTS, SERVED, open_marts
from sedimark.sources.layout import Layout


@pytest.fixture()
def rows(spark):
    return spark.range(25).select(F.col("id"), (F.col("id") % 4).alias("v"))


@pytest.mark.parametrize("top_rows", [100_000, 0])
@pytest.mark.parametrize(("page", "size"), [(1, 10), (2, 10), (3, 10), (4, 10), (1, 25), (1, 100), (25, 1)])
def test_pages(rows, page, size, top_rows):
    ordered = sorted(rows.collect(), key=lambda r: (-r["v"], r["id"]))
    found = page_of(rows, ["v DESC", "id"], page, size, top_rows=top_rows).collect()
    assert found == ordered[(page - 1) * size : page * size]


def test_far_pages_of_one_value(spark):
    """A single order value must neither lose nor repeat rows across pages."""
    rows = spark.range(1000).select(F.lit(1).alias("v"), "id")
    seen = []
    for page in range(1, 5):
        seen += [r["id"] for r in page_of(rows, ["v"], page, 250, top_rows=0).collect()]
        rows = spark.range(1000).select(F.lit(1).alias("v"), "id")
    assert len(seen) == 1000 and len(set(seen)) == 1000


@pytest.mark.parametrize("top_rows", [10**6, 0, 2000])
def test_pages_of_an_order_that_is_not_total_hold_every_row_once(spark, top_rows):
    rows = spark.range(4000).select((F.col("id") % 5).alias("v"), "id").repartition(7)
    seen = [r["id"] for page in range(1, 9) for r in page_of(rows, ["v"], page, 500, top_rows=top_rows).collect()]
    assert sorted(seen) == list(range(4000))


def test_pages_with_null_order_values(spark):
    rows = spark.createDataFrame([(None,), (2,), (1,), (None,)], "v int")
    down = [r[0] for r in page_of(rows, ["v DESC"], 1, 4).collect()]
    far = [r[0] for r in page_of(rows, ["v DESC"], 1, 4, top_rows=0).collect()]
    assert down == far == [2, 1, None, None]
    assert [r[0] for r in page_of(rows, ["v"], 1, 4).collect()] == [None, None, 1, 2]


@pytest.mark.parametrize(("page", "size"), [(0, 10), (-1, 10), (1, 0), (1, 101)])
def test_bad_pages(rows, page, size):
    with pytest.raises(ValueError, match="page"):
        page_of(rows, ["id"], page, size, max_size=100)


@pytest.mark.parametrize(("page", "size", "pages"), [(1, 10, 3), (9, 10, 3), (1, 25, 1), (1, 24, 2)])
def test_totals(rows, page, size, pages):
    assert tuple(page_totals(rows, page, size).first()) == (page, size, pages, 25)


def test_totals_of_nothing(rows):
    assert tuple(page_totals(rows.limit(0), 1, 10).first()) == (1, 10, 0, 0)


def test_near_pages_use_a_top_k(rows, plan):
    assert "TakeOrderedAndProject" in plan(page_of(rows, ["id"], 2, 10))


def test_filters(spark):
    cities = spark.createDataFrame(
        [("CA", "a", 9, 1.0, 1.0, 1.0), ("TX", "b", 8, 1.0, 1.0, 1.0)],
        "state string, city string, total_accidents bigint, avg_severity double, latitude double, longitude double",
    )
    served = SERVED["cities"]
    assert [r["city"] for r in served.page(cities, state="tx").collect()] == ["b"]
    assert served.page(cities, state="").count() == 2
    assert served.totals(cities, state="tx").first()["total_items"] == 1
    with pytest.raises(ValueError, match="filtered by city"):
        served.page(cities, city="a")


def test_every_mart_is_served_once():
    assert len(MARTS) == len(set(MARTS)) == 7
    assert all(s.default_size <= s.max_size for s in SERVED.values())
    assert {n: (s.default_size, s.max_size) for n, s in SERVED.items()} == {
        "states": (10, 100), "weather": (10, 50), "cities": (20, 100), "time": (24, 50),
        "severity_predictions": (10, 50), "risk_zones": (10, 50), "hotspots": (10, 50),
    }


def test_marts_open_as_views(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for served in SERVED.values():
        spark.range(2).select(*[F.col("id").alias(c) for c in served.columns]).write.parquet(layout.gold(served.mart))
    opened = open_marts(spark, layout)
    assert set(opened) == set(MARTS)
    assert spark.sql("SELECT count(*) FROM ml_risk_zones").first()[0] == 2
