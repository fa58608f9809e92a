from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sedimark.operators import snapshots
from sedimark.operators.cleaning import clean
from sedimark.plans import daily, jobs, marts
from sedimark.plans.catalogue import comparable
from sedimark.profile import INCIDENTS
from sedimark.sources import catalog, files, history
from sedimark.sources.fixtures import PROFILE, incidents_bronze
from sedimark.sources.layout import Layout

DAYS = ("2025-01-01", "2025-01-02", "2025-01-03")
BUCKETS = 4


class Daily:
    """A Bronze that days are delivered to, and the Silver kept by the day from it."""

    def __init__(self, spark, root, profile=PROFILE):
        self.spark, self.profile = spark, profile
        self.settings = jobs.Settings(Layout(str(root)), profile=profile, table=f"daily_test.s_{abs(hash(str(root)))}")

    def deliver(self, rows):
        snapshots.write_batches(rows, self.settings.layout.bronze)

    def refine(self):
        return daily.refine_daily(self.spark, self.settings, BUCKETS)

    def check(self):
        """Silver is what cleaning all of Bronze at once gives."""
        whole = clean(history.scan(self.spark, self.settings.layout.bronze), self.profile)
        kept = catalog.read_table(self.spark, self.settings.table)
        assert kept.columns == whole.columns
        assert kept.count() == whole.count()
        assert kept.exceptAll(whole).count() == 0


@pytest.fixture()
def bronze(spark, small):
    return incidents_bronze(spark, small)


def on(rows, *days):
    return rows.where(F.col("situation_date").isin(*[F.lit(d).cast("date") for d in days]))


def test_days_one_by_one_and_redelivered(spark, bronze, tmp_path):
    kept = Daily(spark, tmp_path)
    for i, day in enumerate(DAYS):
        kept.deliver(on(bronze, day))
        done = kept.refine()
        assert done["changed"] == [day] and set(done["written"]) <= set(DAYS[: i + 1])
        kept.check()
    assert kept.refine() == {"changed": [], "written": []}
    # Fewer rows: keys lose their winner, and copies of other days take its place.
    kept.deliver(on(bronze, DAYS[1]).where("id % 3 = 0").withColumn("city", F.lit("AGAIN")))
    done = kept.refine()
    assert done["changed"] == [DAYS[1]] and DAYS[2] in done["written"] and DAYS[0] not in done["written"]
    kept.check()
    # The day as it was first: the copies lose again.
    kept.deliver(on(bronze, DAYS[1]))
    kept.refine()
    kept.check()
    assert len(list(Path(kept.settings.layout.key_states).iterdir())) == 1


@pytest.mark.parametrize("order", [(2, 1, 0), (1, 2, 0)])
def test_days_in_any_order(spark, bronze, tmp_path, order):
    kept = Daily(spark, tmp_path)
    for i in order:
        kept.deliver(on(bronze, DAYS[i]))
        kept.refine()
    kept.check()


def test_the_default_order_of_days(spark, bronze, tmp_path):
    """The first day wins; rows of one day are told apart by all their columns."""
    profile = INCIDENTS
    kept = Daily(spark, tmp_path, profile)
    rows = bronze.drop("copy_no")
    twice = rows.unionByName(rows.where("id % 4 = 0").withColumn("city", F.lit("A"))).unionByName(
        on(rows, DAYS[0]).where("id % 5 = 0").withColumn("situation_date", F.lit(DAYS[2]).cast("date"))
    )
    for i in (1, 0, 2):
        kept.deliver(on(twice, DAYS[i]))
        kept.refine()
        kept.check()
    kept.deliver(on(twice, DAYS[0]).where("id % 2 = 0"))
    kept.refine()
    kept.check()


def test_a_tie_break_that_does_not_decide_is_an_error(spark, bronze, tmp_path):
    kept = Daily(spark, tmp_path, PROFILE.with_tie_break("copy_no"))
    kept.deliver(on(bronze, DAYS[0]))
    with pytest.raises(ValueError, match="total tie-break"):
        kept.refine()


def test_a_day_that_goes_and_one_without_survivors(spark, bronze, tmp_path):
    kept = Daily(spark, tmp_path)
    kept.deliver(bronze)
    kept.refine()
    history.forget(spark, kept.settings.layout.bronze, DAYS[0])
    assert kept.refine()["changed"] == [DAYS[0]]
    kept.check()
    kept.deliver(on(bronze, DAYS[1]).withColumn("severity", F.lit(9)))
    kept.refine()
    kept.check()
    assert [b.day for b in history.batches(spark, kept.settings.layout.silver_daily)] == [DAYS[2]]


def test_new_columns_rebuild_silver(spark, bronze, tmp_path):
    kept = Daily(spark, tmp_path)
    kept.deliver(on(bronze, DAYS[0]).drop("humidity"))
    kept.refine()
    kept.check()
    kept.deliver(on(bronze, DAYS[1]))
    assert kept.refine()["written"] == list(DAYS[:2])
    kept.check()


@pytest.mark.parametrize("broken", ["write_batches", "sync_external"])
def test_a_failed_run_is_made_good(spark, bronze, tmp_path, monkeypatch, broken):
    kept = Daily(spark, tmp_path)
    kept.deliver(on(bronze, DAYS[1], DAYS[2]))
    kept.refine()
    kept.deliver(on(bronze, DAYS[1]).where("id % 3 = 0"))
    with monkeypatch.context() as failing:
        failing.setattr(daily.snapshots if broken == "write_batches" else daily.catalog, broken, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.refine()
    # Meanwhile, another delivery of the day takes the withdrawal back.
    snapshots.write_batches(on(bronze, DAYS[1]), kept.settings.layout.bronze)
    kept.refine()
    kept.check()


def test_a_new_day_reads_no_silver_and_moves_no_state(spark, bronze, tmp_path, monkeypatch):
    """Silver is not read, and the key state is joined where it lies."""
    kept = Daily(spark, tmp_path)
    kept.deliver(on(bronze, DAYS[0], DAYS[1]))
    kept.refine()
    kept.deliver(on(bronze, DAYS[2]))
    plans, real = [], daily._write_state

    def spied(path, table, parts, buckets):
        plans.extend(p.repartition(buckets, "key")._jdf.queryExecution().executedPlan().toString() for p in parts)
        return real(path, table, parts, buckets)

    monkeypatch.setattr(daily, "_write_state", spied)
    scans = []
    monkeypatch.setattr(daily.history, "scan", lambda s, path, *a, real=history.scan: scans.append(path) or real(s, path, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept.refine()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(scans) == {kept.settings.layout.bronze}
    new, known = plans
    # One exchange each: that of the day's candidates.
    assert known.count("Exchange hashpartitioning") == 1 and new.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in known
    kept.check()


def test_marts_by_the_day(spark, bronze, tmp_path):
    kept = Daily(spark, tmp_path)
    layout = kept.settings.layout
    kept.deliver(on(bronze, DAYS[0], DAYS[1]))
    kept.refine()
    daily.build_marts_daily(spark, kept.settings)
    kept.deliver(on(bronze, DAYS[2]))
    kept.deliver(on(bronze, DAYS[1]).where("id % 3 = 0"))
    done = kept.refine()
    stamps = {b.day: b.delivery for b in history.batches(spark, layout.partials("cities"))}
    written = daily.build_marts_daily(spark, kept.settings)
    after = {b.day: b.delivery for b in history.batches(spark, layout.partials("cities"))}
    assert {d for d in after if after[d] != stamps.get(d)} == set(done["written"])
    silver = catalog.read_table(spark, kept.settings.table)
    whole = {
        "state_stats": marts.STATE_STATS, "time_patterns": marts.TIME_PATTERNS, "weather_analysis": marts.WEATHER_ANALYSIS,
        "city_hotspots": marts.city_hotspots(),
    }
    for name, summary in whole.items():
        got, want = comparable(files.read_parquet(spark, layout.gold(name))), comparable(summary.of(silver))
        assert got.columns == want.columns and got.count() == want.count() == written[name]
        assert got.exceptAll(want).count() == 0
    # Nothing changed: no partial sum is made again.
    assert daily._update_partials(spark, layout) == []
    history.forget(spark, layout.bronze, DAYS[0])
    kept.refine()
    daily.build_marts_daily(spark, kept.settings)
    total = files.read_parquet(spark, layout.gold("state_stats")).agg(F.sum("total_accidents")).first()[0]
    assert total == catalog.read_table(spark, kept.settings.table).count()


def test_sketches_of_any_days(spark, bronze, tmp_path):
    kept = Daily(spark, tmp_path)
    kept.deliver(bronze.withColumn("city", F.concat("city", (F.col("id") % 300).cast("string"))))
    kept.refine()
    daily.build_marts_daily(spark, kept.settings)
    silver = catalog.read_table(spark, kept.settings.table)
    for days in (DAYS, DAYS[:1], DAYS[1:]):
        about = {r.state: r.cities for r in daily.city_sketches(spark, kept.settings.layout, days).collect()}
        exact = on(silver, *days).groupBy("state").agg(F.countDistinct("city").alias("n")).collect()
        assert len(about) == len(exact)
        assert all(abs(about[r.state] - r.n) <= 0.05 * r.n + 0.5 for r in exact)


def test_an_unfinished_mart_is_made_good(spark, bronze, tmp_path, monkeypatch):
    kept = Daily(spark, tmp_path)
    kept.deliver(bronze)
    kept.refine()
    with monkeypatch.context() as failing:
        failing.setattr(daily.snapshots, "write_batches", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily.build_marts_daily(spark, kept.settings)
    assert daily._update_partials(spark, kept.settings.layout) == list(DAYS)


def test_settings_are_those_of_the_jobs(spark, bronze, tmp_path):
    """Learning reads the table whichever job made it."""
    kept = Daily(spark, tmp_path)
    kept.deliver(bronze)
    kept.refine()
    said = jobs.learn(spark, replace(kept.settings, sample_rows=300))
    assert said["risk_zones"] == 5 and said["samples"] == 300
