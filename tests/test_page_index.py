from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sedimark.operators.page_index import build_index, indexed, open_index, version_of
from sedimark.operators.paging import page_of
from sedimark.plans.serving import SERVED
from sedimark.sources.layout import Layout


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(1_000).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 5 > 0, F.col("id") * 0.5).alias("x"))
    rows.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("order", [["v DESC", "id"], ["x"], ["x DESC"], ["v"]])
def test_pages_are_those_of_the_frame(table, tmp_path, order):
    index = build_index(table, str(tmp_path / "pages"), "1", order, range_rows=90)
    assert index.rows == 1_000
    for page, size in ((1, 30), (3, 90), (5, 200), (6, 200), (11, 97), (1, 1_000), (34, 30)):
        assert index.page(page, size).collect() == page_of(table, order, page, size).collect()
        assert index.totals(page, size).first()["total_pages"] == -(-1_000 // size)


def test_a_page_reads_its_ranges_only(table, tmp_path, plan):
    index = build_index(table, str(tmp_path / "pages"), "1", ["id"], range_rows=90)
    page = index.page(5, 100)
    touched = {Path(f).parent.name for f in page.inputFiles()}
    assert len(touched) <= 3 and len(index.ranges_of(400, 100)) == len(touched)
    assert touched == {f"__range={r}" for r in index.ranges_of(400, 100)}
    # Nothing but the page's ranges is in the scan.
    assert plan(page).count("FileScan parquet") == 1


def test_the_second_page_writes_nothing(table, tmp_path, monkeypatch):
    path = str(tmp_path / "pages")
    indexed(table, path, version_of(table), ["id"], 90)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*")}
    from sedimark.operators import page_index

    monkeypatch.setattr(page_index, "build_index", lambda *a: 1 / 0)
    again = indexed(table, path, version_of(table), ["id"], 90)
    assert [r.id for r in again.page(2, 10).collect()] == list(range(10, 20))
    assert {p: p.stat().st_mtime_ns for p in Path(path).rglob("*")} == before


def test_another_version_or_order_is_built_anew(spark, table, tmp_path):
    path, order = str(tmp_path / "pages"), ["id"]
    first = indexed(table, path, version_of(table), order)
    assert open_index(spark, path, version_of(table), ["v"]) is None
    table.limit(10).write.mode("append").parquet(str(tmp_path / "table"))
    grown = spark.read.parquet(str(tmp_path / "table"))
    assert version_of(grown) != version_of(table)
    assert indexed(grown, path, version_of(grown), order).rows == first.rows + 10


def test_equal_rows_lie_in_several_ranges(spark, tmp_path):
    rows = spark.range(1_000).select(F.lit(1).alias("v"))
    index = build_index(rows, str(tmp_path / "pages"), "1", ["v"], range_rows=100)
    assert len(index.starts) == 11 and max(b - a for a, b in zip(index.starts, index.starts[1:], strict=False)) < 400
    assert sum(index.page(p, 130).count() for p in range(1, 10)) == 1_000


def test_an_empty_table(spark, tmp_path):
    index = build_index(spark.range(0), str(tmp_path / "pages"), "1", ["id"])
    assert index.page(1, 10).count() == 0 and index.page(1, 10).columns == ["id"] and index.totals(1, 10).first()["total_pages"] == 0


def test_an_unfinished_index_is_not_used(spark, table, tmp_path):
    path = str(tmp_path / "pages")
    build_index(table, path, "1", ["id"])
    (Path(path) / "_pages.json").unlink()
    assert open_index(spark, path, "1", ["id"]) is None


def test_served_marts_have_an_index(spark, tmp_path):
    layout, served = Layout(str(tmp_path)), SERVED["cities"]
    rows = spark.range(500).select(
        F.concat(F.lit("s"), F.col("id") % 9).alias("state"), F.concat(F.lit("c"), "id").alias("city"), (F.col("id") % 50).alias("total_accidents"),
        F.lit(2.0).alias("avg_severity"), F.lit(30.0).alias("latitude"), F.lit(-90.0).alias("longitude"),
    )
    rows.write.parquet(layout.gold(served.mart))
    for page in (1, 4, 25, 26):
        assert served.far_page(spark, layout, page).collect() == served.page(rows, page).collect()
    with pytest.raises(ValueError, match="page"):
        served.far_page(spark, layout, 1, 1_000)


def test_many_ranges_need_no_more_tasks(spark, table, tmp_path):
    """Ranges are cut by the number of the row: neither the tasks nor the sample for the sort grow with their number."""
    context, group = spark.sparkContext, "many-ranges"
    context.setJobGroup(group, group)
    try:
        index = build_index(table, str(tmp_path / "pages"), "1", ["v DESC"], range_rows=10)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert index.starts == tuple(range(0, 1_001, 10))
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= 8
    got = [row for page in range(1, 5) for row in index.page(page, 250).collect()]
    assert got == page_of(table, ["v DESC"], 1, 1_000).collect()
