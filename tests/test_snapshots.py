import pytest
from pyspark.sql import functions as F

from sedimark.operators import snapshots
from sedimark.sources.files import read_parquet
from sedimark.sources.fixtures import incidents_bronze

DAYS = ("2025-01-01", "2025-01-02", "2025-01-03")
WEIGHTS = dict(zip(DAYS, (0.33, 0.33, 0.34), strict=True))


@pytest.fixture()
def stored(spark, small, tmp_path):
    path = str(tmp_path / "bronze")
    snapshots.write_batches(incidents_bronze(spark, small), path)
    return path


def test_parts_are_disjoint_and_complete(spark):
    rows = spark.range(3000)
    parts = snapshots.split_by_weight(rows, [0.33, 0.33, 0.34], ["id"])
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 3000 and min(sizes) > 850
    together = parts[0].union(parts[1]).union(parts[2])
    assert together.distinct().count() == 3000


def test_parts_do_not_depend_on_layout(spark):
    rows = spark.range(2000)
    first = {r[0] for r in snapshots.split_by_weight(rows, [1, 2], ["id"])[0].collect()}
    for n in (1, 3, 16):
        assert first == {r[0] for r in snapshots.split_by_weight(rows.repartition(n), [1, 2], ["id"])[0].collect()}


def test_days_of_a_spread_are_the_parts(spark):
    rows = spark.range(2000)
    spread = snapshots.spread_over_days(rows, WEIGHTS, ["id"])
    parts = snapshots.split_by_weight(rows, list(WEIGHTS.values()), ["id"])
    for day, part in zip(DAYS, parts, strict=True):
        on_day = spread.where(F.col("situation_date") == F.lit(day).cast("date")).select("id")
        assert on_day.exceptAll(part).count() == 0 and on_day.count() == part.count()


def test_snapshots_grow(spark, stored):
    bronze = read_parquet(spark, stored)
    snaps = [snapshots.snapshot(bronze, day) for day in DAYS]
    assert snaps[0].exceptAll(snaps[1]).count() == 0
    assert snaps[1].exceptAll(snaps[2]).count() == 0
    assert snaps[2].count() == snapshots.snapshot(bronze).count() == 1053
    grown = [r["snapshot_rows"] for r in snapshots.growth(bronze).collect()]
    assert grown == [s.count() for s in snaps]


def test_snapshot_prunes_partitions(spark, stored, plan):
    text = plan(snapshots.snapshot(read_parquet(spark, stored), DAYS[0]))
    assert "PartitionFilters: [isnotnull(situation_date" in text


def test_rerun_replaces_its_day_only(spark, stored):
    bronze = read_parquet(spark, stored)
    before = {r["situation_date"]: r["count"] for r in bronze.groupBy("situation_date").count().collect()}
    again = snapshots.tag_batch(spark.range(5).withColumn("city", F.lit("new")), DAYS[1])
    snapshots.write_batches(again, stored)
    counted = read_parquet(spark, stored).groupBy("situation_date").count()
    after = {r["situation_date"]: r["count"] for r in counted.collect()}
    changed = [d for d in before if before[d] != after[d]]
    assert [str(d) for d in changed] == [DAYS[1]] and after[changed[0]] == 5


def test_rebalanced_write_holds_the_same_rows(spark, small, tmp_path):
    rows = incidents_bronze(spark, small)
    path = str(tmp_path / "even")
    snapshots.write_batches(rows, path, rebalance=True)
    stored = read_parquet(spark, path)
    assert stored.select(rows.columns).exceptAll(rows).count() == 0 and stored.count() == rows.count()


def test_writing_batches_needs_no_shuffle(spark):
    rows = snapshots.spread_over_days(spark.range(10), WEIGHTS, ["id"])
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_append_matches_names_not_positions(spark):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("b", 2.5, 2)], "s string, extra double, n int")
    both = snapshots.append_batch(left, right)
    assert sorted(map(tuple, both.collect())) == [(1, "a", None), (2, "b", 2.5)]


def test_append_keeps_repeated_rows(spark):
    rows = spark.range(3)
    assert snapshots.append_batch(rows, rows).count() == 6
