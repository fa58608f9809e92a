from dataclasses import replace
from pathlib import Path

import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
import scale_check
from sedimark.functions import tidy_name
from sedimark.operators import snapshots
from sedimark.operators.cleaning import quality_report
from sedimark.plans import jobs, marts
from sedimark.plans.catalogue import comparable
from sedimark.plans.serving import MARTS, open_marts
from sedimark.profile import INCIDENTS, RAW_COLUMNS
from sedimark.sources import catalog, files, sinks
from sedimark.sources.fixtures import PROFILE, incidents_bronze
from sedimark.session import shared_folder
from sedimark.sources.layout import Layout
from sedimark.streaming.landing import ingest_arrivals


@pytest.fixture(scope="module")
def settings(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    raw = incidents_bronze(spark, small).drop("situation_date")
    sinks.write_csv(raw, str(root / "source"))
    return jobs.Settings(
        Layout(str(root / "tables")), str(root / "source"), raw.schema, profile=PROFILE, table="jobs_test.silver"
    )


@pytest.fixture(scope="module")
def done(spark, settings):
    return jobs.run_all(spark, settings)


def test_reports_of_the_jobs(done):
    assert done["refine"]["final_rows"] == 544
    assert done["learn"]["samples"] == sum(done["learn"]["class_distribution"].values()) == 544
    assert done["learn"]["risk_zones"] == 5 and done["learn"]["severity_accuracy"] > 0.5
    assert done["marts"]["time_patterns"] == 165
    assert {m: rows for m, (rows, _) in done["export"].items() if m in done["marts"]} == done["marts"]


def test_refine_reports_what_the_quality_query_says(spark, settings, done):
    bronze, _ = files.split_corrupt(files.read_parquet(spark, settings.layout.bronze))
    assert {**quality_report(bronze, PROFILE).first().asDict(), "corrupt_lines": 0} == done["refine"]


def test_every_mart_is_written_and_exported(spark, settings, done):
    for mart in MARTS:
        stored = files.read_parquet(spark, settings.layout.gold(mart))
        lines = files.read_csv(spark, settings.layout.export(mart), stored.schema).cache()
        exported, bad = files.split_corrupt(lines)
        assert stored.count() == exported.count() == done["export"][mart][0]
        assert bad.count() == 0


def test_marts_match_sql(spark, settings, small, done):
    con, sql = connect(small), contract.oracle_sql()
    for mart in ("state_stats", "time_patterns", "weather_analysis", "city_hotspots"):
        stored = comparable(files.read_parquet(spark, settings.layout.gold(mart)))
        assert differences(stored, con, sql[mart]) == []
    hotspots = comparable(files.read_parquet(spark, settings.layout.gold("ml_hotspots")))
    assert differences(hotspots, con, sql["grid_hotspots"]) == []
    silver = catalog.read_table(spark, settings.table).drop("copy_no")
    assert differences(silver, con, sql["pipeline_silver"]) == []


def test_jobs_can_run_again(spark, settings, done):
    jobs.ingest(spark, settings)
    assert jobs.refine(spark, settings)["final_rows"] == 544
    assert jobs.build_marts(spark, settings) == done["marts"]


def test_refine_an_earlier_day(spark, settings, done, tmp_path):
    first = replace(settings, layout=Layout(str(tmp_path)), table="jobs_test.first_day")
    bronze = files.read_parquet(spark, settings.layout.bronze)
    snapshots.write_batches(bronze, first.layout.bronze)
    rows = jobs.refine(spark, first, as_of="2025-01-01")["final_rows"]
    assert 0 < rows < 544


def test_unreachable_database_diverts_to_csv(spark, settings, done):
    target = {"url": "jdbc:none://x", "driver": "no.such.Driver"}
    sent = jobs.export(spark, replace(settings, jdbc=target))
    assert all(diverted for _, diverted in sent.values())
    with pytest.raises(Exception, match="no.such.Driver"):
        jobs.export(spark, replace(settings, jdbc=target, csv_fallback=False))


def test_a_failing_job_ends_the_run(spark, settings, tmp_path):
    with pytest.raises(Exception, match="missing.csv"):
        jobs.run_all(spark, replace(settings, source=str(tmp_path / "missing.csv")))


def test_full_source_layout(spark, small, tmp_path, monkeypatch):
    """46 source columns by their raw names, default profile and schema."""
    monkeypatch.setattr(scale_check, "SF_DIR", small)
    sinks.write_csv(scale_check.source_rows(spark, 2000), str(tmp_path / "source"))
    full = jobs.Settings(Layout(str(tmp_path / "tables")), str(tmp_path / "source"), table="jobs_test.full")
    jobs.ingest(spark, full)
    report = jobs.refine(spark, full)
    assert report["initial_rows"] == 2000 and 0 < report["final_rows"] < report["distinct_rows"]
    silver = catalog.read_table(spark, full.table)
    assert silver.columns == [*[tidy_name(c) for c in RAW_COLUMNS], "situation_date"]
    assert len(silver.columns) == 47
    kinds = {f.name: f.dataType.simpleString() for f in silver.schema}
    assert all(kinds[c] == t for c, t in INCIDENTS.types.items())
    filled = [*INCIDENTS.required, *INCIDENTS.defaults, *INCIDENTS.fallbacks]
    assert set(silver.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled]).first()) == {0}
    assert silver.select("id").distinct().count() == silver.count() == report["final_rows"]
    assert set(jobs.build_marts(spark, full)) == {"state_stats", "time_patterns", "weather_analysis", "city_hotspots"}
    weather = marts.weather_table(silver)
    assert len(weather.columns) == 11 and weather.count() == report["final_rows"]


def test_unreadable_source_lines_stay_in_bronze(spark, tmp_path):
    (tmp_path / "source.csv").write_text("ID,Severity\na,2\nb,two\nc,3\n")
    schema = T.StructType.fromDDL("ID string, Severity int")
    settings = jobs.Settings(Layout(str(tmp_path / "tables")), str(tmp_path / "source.csv"), schema)
    jobs.ingest(spark, settings)
    rows, bad = files.split_corrupt(files.read_parquet(spark, settings.layout.bronze))
    assert rows.count() == 3 and [r[0] for r in bad.collect()] == ["b,two"]


def left_over(spark):
    folder = Path(shared_folder(spark).removeprefix("file:")) / "sedimark"
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_only_the_classifier_is_sampled(spark, settings, done, tmp_path):
    before = left_over(spark)
    sampled = replace(settings, layout=Layout(str(tmp_path)), sample_rows=300)
    said = jobs.learn(spark, sampled)
    assert said["samples"] == 300 and sum(said["class_distribution"].values()) == 544
    zones = files.read_parquet(spark, sampled.layout.gold("ml_risk_zones"))
    assert zones.agg(F.sum("accident_count")).first()[0] == 544
    spots = comparable(files.read_parquet(spark, sampled.layout.gold("ml_hotspots")))
    silver = catalog.read_table(spark, settings.table)
    assert sorted(spots.collect()) == sorted(comparable(marts.grid_hotspots().of(silver)).collect())
    assert left_over(spark) == before


def test_jobs_leave_no_intermediates(spark, settings, done):
    before = left_over(spark)
    jobs.refine(spark, settings)
    jobs.build_marts(spark, settings)
    assert left_over(spark) == before
    # What the table shows, and what it showed before.
    assert len(list(Path(settings.layout.silver).iterdir())) == 2


def test_too_few_rows_for_a_model_still_export(spark, settings, done, tmp_path):
    few = replace(settings, layout=Layout(str(tmp_path)), table="jobs_test.few")
    silver = catalog.read_table(spark, settings.table).limit(60)
    sinks.write_parquet(silver, few.layout.silver)
    catalog.register_external(spark, few.table, few.layout.silver, silver.schema)
    said = jobs.learn(spark, few)
    assert "severity_accuracy" not in said and said["risk_zones"] == 5
    jobs.build_marts(spark, few)
    sent = jobs.export(spark, few)
    assert sent["ml_severity_predictions"] == (None, False)
    assert all(rows is not None for mart, (rows, _) in sent.items() if mart != "ml_severity_predictions")
    assert set(open_marts(spark, few.layout)) == set(MARTS) - {"ml_severity_predictions"}


def test_narrow_table_gives_zones_and_hotspots(spark, settings, done, tmp_path):
    narrow = replace(settings, layout=Layout(str(tmp_path)), table="jobs_test.narrow")
    silver = catalog.read_table(spark, settings.table).select("severity", "start_lat", "start_lng")
    sinks.write_parquet(silver, narrow.layout.silver)
    catalog.register_external(spark, narrow.table, narrow.layout.silver, silver.schema)
    said = jobs.learn(spark, narrow)
    assert said["samples"] == 0 and said["risk_zones"] == 5 and said["hotspots"] > 0


def test_learned_marts_take_the_fallback(spark, settings, done, tmp_path):
    (tmp_path / "blocked").write_text("")
    spare = str(tmp_path / "spare")
    blocked = replace(settings, layout=Layout(str(tmp_path / "blocked")), ml_fallback=spare, sample_rows=1)
    assert jobs.learn(spark, blocked)["risk_zones"] == 5
    assert files.read_parquet(spark, Layout(spare).gold("ml_risk_zones")).count() == 5
    with pytest.raises(Exception, match="blocked"):
        jobs.learn(spark, replace(blocked, ml_fallback=None))


def test_arrivals_are_refined(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    lines = ["ID,Severity,State,Start_Lat,Start_Lng,Start_Time"]
    lines += [f"{i},2,ca,30.0,-100.0,2024-01-01 00:00:00" for i in range(5)] + ["9,two,ca,30.0,-100.0,2024-01-01 00:00:00"]
    (tmp_path / "landing" / "one.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType.fromDDL(
        "ID string, Severity int, State string, Start_Lat double, Start_Lng double, Start_Time timestamp"
    )
    settings = jobs.Settings(Layout(str(tmp_path / "tables")), table="jobs_test.arrived")
    progress = str(tmp_path / "progress")
    ingest_arrivals(spark, str(tmp_path / "landing"), schema, settings.layout.bronze, progress, "2025-01-01")
    report = jobs.refine(spark, settings)
    assert (report["initial_rows"], report["final_rows"], report["corrupt_lines"]) == (6, 5, 1)


def test_table_without_a_database(spark, settings, done):
    plain = replace(settings, table="silver_without_database")
    jobs.refine(spark, plain)
    assert "silver_without_database" not in [r[0] for r in spark.sql("SHOW DATABASES").collect()]
    assert catalog.read_table(spark, plain.table).count() == 544
    spark.sql("DROP TABLE silver_without_database")
    jobs.refine(spark, settings)


def test_even_files_per_day(spark, settings, done):
    for day in Path(settings.layout.bronze).glob("situation_date=*"):
        assert len(list(day.glob("*.parquet"))) == 1
