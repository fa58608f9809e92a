"""Every operator as a query over the driver tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions import (
    condition_category,
    normalized,
    risk_level,
    tidy_names,
    weekend_flag,
)
from sedimark.learning import features, severity, zones
from sedimark.operators import snapshots
from sedimark.operators.cleaning import cast_columns, clean, quality_report
from sedimark.operators.dedup import keep_first, keep_first_sparse
from sedimark.operators.filling import fill_defaults, fill_from_column
from sedimark.operators.page_index import indexed, version_of
from sedimark.operators.paging import page_of
from sedimark.operators.sampling import bounded_sample, train_test
from sedimark.operators.validity import require, within
from sedimark.plans import daily, jobs, marts
from sedimark.plans.serving import SERVED, open_marts
from sedimark.session import fresh_path
from sedimark.sources import catalog, files, history, sinks
from sedimark.sources.clustered import BY_PLACE_AND_TIME, in_box, write_clustered
from sedimark.sources.csv_records import read_csv_records
from sedimark.sources.fixtures import PROFILE, incidents_bronze, incidents_silver
from sedimark.sources.layout import Layout
from sedimark.streaming.landing import ingest_arrivals

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AVERAGES = ("avg_severity", "avg_temperature", "latitude", "longitude", "hotspot_score", "removed_percent")


def query(name: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name or run.__name__] = run
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Averages rounded to six digits: sums of doubles depend on the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in AVERAGES if c in df.columns})


# --- scans, renames, filters, fills, casts -------------------------------------------------------


@query()
def csv_scan_typed(spark: SparkSession, folder: str) -> DataFrame:
    bronze = incidents_bronze(spark, folder)
    path = fresh_path(spark, "csv")
    sinks.write_csv(bronze, path)
    rows, _ = files.split_corrupt(files.read_csv(spark, path, bronze.schema))
    return rows


@query()
def clean_column_names(spark: SparkSession, folder: str) -> DataFrame:
    raw = incidents_bronze(spark, folder).select(
        F.col("id").alias("ID"),
        F.col("copy_no").alias("Copy  No"),
        F.col("temperature_f").alias("Temperature(F)"),
        F.col("humidity").alias("Humidity(%)"),
        F.col("wind_speed_mph").alias("Wind_Speed(mph)"),
        F.col("start_lat").alias("Start_Lat"),
    )
    return tidy_names(raw)


@query()
def required_not_null(spark: SparkSession, folder: str) -> DataFrame:
    kept = require(incidents_bronze(spark, folder), PROFILE.required)
    return kept.select("id", "copy_no", "severity", "state", "start_time", "start_lat", "start_lng")


@query("fill_from_column")
def fill_from_other_column(spark: SparkSession, folder: str) -> DataFrame:
    filled = fill_from_column(incidents_bronze(spark, folder), PROFILE.fallbacks)
    return filled.select("id", "copy_no", "end_lat", "end_lng")


@query("fill_defaults")
def fill_constants(spark: SparkSession, folder: str) -> DataFrame:
    bronze = incidents_bronze(spark, folder)
    filled = fill_defaults(bronze, PROFILE.defaults, only_present=True)
    return filled.select("id", "copy_no", *[c for c in PROFILE.defaults if c in bronze.columns])


@query()
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    bronze = incidents_bronze(spark, folder)
    return bronze.select("id", "copy_no", *[normalized(c).alias(c) for c in PROFILE.uppercase])


@query()
def range_and_bbox(spark: SparkSession, folder: str) -> DataFrame:
    return within(incidents_bronze(spark, folder), PROFILE.ranges).select("id", "copy_no", *PROFILE.ranges)


@query()
def cast_types(spark: SparkSession, folder: str) -> DataFrame:
    """Text back to types: whole numbers with decimals, unreadable numbers, flags, timestamps."""
    bronze = incidents_bronze(spark, folder)
    text = bronze.select(
        "id",
        "copy_no",
        F.concat(F.col("severity").cast("string"), F.lit(".0")).alias("severity"),
        *[F.col(c).cast("string").alias(c) for c in ("start_lat", "start_lng", "distance_mi")],
        F.when(F.col("id") % 10 == 0, "n/a").otherwise(F.col("temperature_f").cast("string")).alias("temperature_f"),
        *[F.col(c).cast("string").alias(c) for c in ("junction", "crossing", "start_time")],
    )
    kinds = {c: t for c, t in PROFILE.types.items() if c in text.columns}
    return cast_columns(text, {**kinds, "start_time": "timestamp_ntz"})


@query()
def bool_to_int(spark: SparkSession, folder: str) -> DataFrame:
    bronze = incidents_bronze(spark, folder)
    flags = [c for c in PROFILE.flags if c in bronze.columns]
    return bronze.select("id", "copy_no", *[F.col(c).cast("int").alias(c) for c in flags])


@query()
def available_columns(spark: SparkSession, folder: str) -> DataFrame:
    silver = incidents_silver(spark, folder)
    wanted = ("id", "severity", "start_lat", "start_lng", "start_time", "no_such_column")
    return catalog.select_available(silver, wanted, PROFILE.learning_required)


# --- deduplication, cleaning, quality ------------------------------------------------------------


@query()
def dedup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return keep_first(incidents_bronze(spark, folder), "id", ["copy_no"])


@query()
def dedup_sparse(spark: SparkSession, folder: str) -> DataFrame:
    return keep_first_sparse(incidents_bronze(spark, folder), "id", ["copy_no"])


@query()
def dedup_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """Three keys, each with a third of all rows."""
    hot = incidents_bronze(spark, folder).withColumn("grp", F.col("id") % 3)
    kept = keep_first(hot, "grp", ["id", "copy_no"])
    return kept.select("grp", F.col("id").alias("first_id"), "severity")


@query("quality_report")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(quality_report(incidents_bronze(spark, folder), PROFILE))


@query()
def clean_silver(spark: SparkSession, folder: str) -> DataFrame:
    return incidents_silver(spark, folder)


# --- batches and snapshots -----------------------------------------------------------------------


def _stored_bronze(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    bronze = incidents_bronze(spark, folder)
    path = fresh_path(spark, "bronze")
    snapshots.write_batches(bronze, path)
    return bronze, path


@query()
def split_parts(spark: SparkSession, folder: str) -> DataFrame:
    bronze = incidents_bronze(spark, folder).drop(snapshots.BATCH)
    return snapshots.spread_over_days(bronze, jobs.DAYS, ["id"]).select("id", "copy_no", snapshots.BATCH)


@query()
def union_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of a split, put together again by column name although one part has its own order."""
    bronze = incidents_bronze(spark, folder).select("id", "copy_no", "city", snapshots.BATCH)
    first, second, third = snapshots.split_by_weight(bronze, list(jobs.DAYS.values()), ["id"])
    turned = second.select(*reversed(second.columns))
    return snapshots.append_batch(snapshots.append_batch(first, turned), third)


@query()
def snapshot_as_of(spark: SparkSession, folder: str) -> DataFrame:
    _, path = _stored_bronze(spark, folder)
    return snapshots.snapshot(files.read_parquet(spark, path), "2025-01-02")


@query()
def snapshot_growth(spark: SparkSession, folder: str) -> DataFrame:
    _, path = _stored_bronze(spark, folder)
    return snapshots.growth(files.read_parquet(spark, path))


@query()
def snapshot_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """One day is delivered again: its partition is replaced, the other days stay."""
    bronze, path = _stored_bronze(spark, folder)
    again = bronze.where(F.col(snapshots.BATCH) == F.lit("2025-01-02").cast("date"))
    snapshots.write_batches(again, path)
    stored = files.read_parquet(spark, path).groupBy(snapshots.BATCH)
    return stored.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"))


# --- marts ---------------------------------------------------------------------------------------


@query()
def state_stats(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(marts.STATE_STATS.of(incidents_silver(spark, folder)))


@query()
def time_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(marts.TIME_PATTERNS.of(incidents_silver(spark, folder)))


@query()
def weather_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(marts.WEATHER_ANALYSIS.of(incidents_silver(spark, folder)))


@query()
def city_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(marts.city_hotspots().of(incidents_silver(spark, folder)))


@query()
def grid_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(marts.grid_hotspots().of(incidents_silver(spark, folder)))


@query()
def shared_city_sums(spark: SparkSession, folder: str) -> DataFrame:
    """State and city mart from one aggregation."""
    sums = marts.city_sums(incidents_silver(spark, folder))
    shown = ("total_accidents", "avg_severity")
    states = marts.state_stats_from(sums).select(
        F.lit("state").alias("mart"), "state", F.lit(None).cast("string").alias("city"), *shown
    )
    cities = marts.city_hotspots_from(sums).select(F.lit("city").alias("mart"), "state", "city", *shown)
    return comparable(states.unionByName(cities))


@query()
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return marts.CLASS_DISTRIBUTION.of(incidents_silver(spark, folder))


@query("weekend_flag")
def weekend(spark: SparkSession, folder: str) -> DataFrame:
    return incidents_silver(spark, folder).select("id", weekend_flag("start_time").alias("is_weekend"))


@query()
def weather_category(spark: SparkSession, folder: str) -> DataFrame:
    of_events = (("HIGH", ("ERROR",)), ("MEDIUM", ("CLICK", "VIEW")))
    return incidents_silver(spark, folder).select(
        "id",
        "weather_condition",
        condition_category("weather_condition").alias("weather_severity"),
        condition_category("weather_condition", of_events).alias("event_severity"),
    )


@query()
def weather_table(spark: SparkSession, folder: str) -> DataFrame:
    return marts.weather_table(incidents_silver(spark, folder))


@query()
def risk_level_by_state(spark: SparkSession, folder: str) -> DataFrame:
    states = marts.STATE_STATS.of(incidents_silver(spark, folder))
    return comparable(states.select("state", "avg_severity", risk_level("avg_severity").alias("risk_level")))


@query()
def summary(spark: SparkSession, folder: str) -> DataFrame:
    sums = marts.city_sums(incidents_silver(spark, folder))
    return marts.summary_row(marts.state_stats_from(sums), marts.city_hotspots_from(sums))


# --- served pages --------------------------------------------------------------------------------


@query()
def page_states(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.STATE_STATS.of(incidents_silver(spark, folder))
    return comparable(SERVED["states"].page(mart, page=2))


@query()
def page_weather(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.WEATHER_ANALYSIS.of(incidents_silver(spark, folder))
    return comparable(SERVED["weather"].page(mart, page=2, size=4))


@query()
def page_cities(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.city_hotspots().of(incidents_silver(spark, folder))
    return comparable(SERVED["cities"].page(mart, page=2))


@query()
def page_cities_filtered(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.city_hotspots().of(incidents_silver(spark, folder))
    return comparable(SERVED["cities"].page(mart, state="nation_10"))


@query()
def page_time(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.TIME_PATTERNS.of(incidents_silver(spark, folder))
    return comparable(SERVED["time"].page(mart, page=2))


@query()
def page_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.grid_hotspots().of(incidents_silver(spark, folder))
    return comparable(SERVED["hotspots"].page(mart, page=2))


@query()
def page_info(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.city_hotspots().of(incidents_silver(spark, folder))
    return SERVED["cities"].totals(mart, page=2)


@query()
def page_deep(spark: SparkSession, folder: str) -> DataFrame:
    """A far page, by an index written once: a second one reads its ranges only."""
    path = fresh_path(spark, "served")
    sinks.write_parquet(incidents_silver(spark, folder).select("id", "start_time", "distance_mi"), path)
    rows, order = files.read_parquet(spark, path), ["distance_mi DESC", "id"]
    place, version = fresh_path(spark, "pages"), version_of(rows)
    indexed(rows, place, version, order, range_rows=400)
    return indexed(rows, place, version, order).page(page=2, size=500)


@query()
def page_far(spark: SparkSession, folder: str) -> DataFrame:
    """A far page without an index, cut by counting sorted ranges instead of a top-k."""
    rows = incidents_silver(spark, folder).select("id", "start_time", "distance_mi")
    return page_of(rows, ["distance_mi DESC", "id"], page=2, size=500, top_rows=0)


@query()
def box_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a box of place and time, from files that lie along a curve through both."""
    path = fresh_path(spark, "clustered")
    write_clustered(incidents_silver(spark, folder), path, replace(BY_PLACE_AND_TIME, group_bytes=1 << 18))
    box = {"start_lat": (30.0, 36.0), "start_lng": (-110.0, -95.0)}
    return in_box(files.read_parquet(spark, path), box, ("2024-01-05", "2024-01-25")).select("id", "start_lat", "start_lng", "start_time", "severity")


# --- sinks and catalog ---------------------------------------------------------------------------


@query()
def mart_parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "mart")
    sinks.write_parquet(marts.STATE_STATS.of(incidents_silver(spark, folder)), path, files=2)
    return comparable(files.read_parquet(spark, path))


@query()
def mart_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.city_hotspots().of(incidents_silver(spark, folder))
    path = fresh_path(spark, "export")
    sinks.write_csv(mart, path, files=1)
    rows, _ = files.split_corrupt(files.read_csv(spark, path, mart.schema))
    return comparable(rows)


@query()
def external_table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    silver = incidents_silver(spark, folder)
    path = fresh_path(spark, "silver")
    sinks.write_parquet(silver, path)
    catalog.create_database(spark, "sedimark_queries")
    table = "sedimark_queries." + path.rsplit("/", 1)[-1].replace("-", "_")
    return catalog.register_external(spark, table, path, silver.schema)


@query()
def serving_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A mart read by SQL text through a temporary view, with a bound parameter."""
    mart = marts.city_hotspots().of(incidents_silver(spark, folder))
    mart.createOrReplaceTempView("city_hotspots")
    found = spark.sql("SELECT * FROM city_hotspots WHERE state = upper(:state)", args={"state": "nation_10"})
    return comparable(found)


# --- sampling and learning -----------------------------------------------------------------------


@query("bounded_sample")
def sample_of_bounded_size(spark: SparkSession, folder: str) -> DataFrame:
    rows = incidents_silver(spark, folder).select("id", "severity")
    return bounded_sample(rows, 300, ["id"])


@query()
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = train_test(incidents_silver(spark, folder).select("id"), ["id"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query()
def ml_features(spark: SparkSession, folder: str) -> DataFrame:
    prepared = features.prepare(incidents_silver(spark, folder), PROFILE)
    return prepared.select("id", "severity", *features.available(prepared, features.SEVERITY_INPUTS))


@dataclass(frozen=True)
class Learned:
    prepared: DataFrame
    severity: severity.SeverityRun
    zones: PipelineModel


@cache
def _learned(spark: SparkSession, folder: str) -> Learned:
    """Both models of a folder, fitted once per session and shared by the queries below."""
    prepared = jobs.learning_rows(incidents_silver(spark, folder), PROFILE).persist()
    with severity.training_sample(prepared, PROFILE.key, severity.SAMPLE_ROWS) as sample:
        run = severity.train_severity(sample)
    if run is None:
        raise RuntimeError("too few incidents to train on")
    return Learned(prepared, run, zones.fit_zones(zones.zone_columns(prepared)))


@query()
def severity_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _learned(spark, folder).severity.predictions


@query()
def severity_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return _learned(spark, folder).severity.metrics


@query()
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return severity.feature_importance(_learned(spark, folder).severity, top=5)


@query()
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _learned(spark, folder).severity.confusion


@query()
def risk_zones(spark: SparkSession, folder: str) -> DataFrame:
    found = _learned(spark, folder)
    return zones.zone_profile(zones.assign_zones(found.zones, found.prepared))


@query()
def page_risk_zones(spark: SparkSession, folder: str) -> DataFrame:
    return SERVED["risk_zones"].page(risk_zones(spark, folder), size=3)


@query()
def page_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return SERVED["severity_predictions"].page(severity_predictions(spark, folder), page=2)


@query()
def score_all(spark: SparkSession, folder: str) -> DataFrame:
    """All cleaned incidents scored with a model that was saved and loaded again."""
    path = fresh_path(spark, "model")
    severity.save_model(_learned(spark, folder).severity.model, path)
    prepared = features.prepare(incidents_silver(spark, folder), PROFILE)
    return severity.score(severity.load_model(path), prepared).select("id", "severity", "prediction")


# --- whole jobs ----------------------------------------------------------------------------------


def _settings(spark: SparkSession, folder: str, label: str) -> jobs.Settings:
    """Jobs over a CSV file that holds the raw incidents without a batch date."""
    raw = incidents_bronze(spark, folder).drop(snapshots.BATCH)
    source = fresh_path(spark, "landing")
    sinks.write_csv(raw, source)
    root = fresh_path(spark, label)
    table = "sedimark_jobs." + root.rsplit("/", 1)[-1].replace("-", "_")
    return jobs.Settings(Layout(root), source, raw.schema, profile=PROFILE, table=table)


@query()
def pipeline_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Ingest and refine."""
    settings = _settings(spark, folder, "pipeline")
    jobs.ingest(spark, settings)
    jobs.refine(spark, settings)
    return catalog.read_table(spark, settings.table).drop("copy_no")


@query()
def pipeline_state_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Ingest, refine, build the marts."""
    settings = _settings(spark, folder, "pipeline")
    jobs.ingest(spark, settings)
    jobs.refine(spark, settings)
    jobs.build_marts(spark, settings)
    return comparable(files.read_parquet(spark, settings.layout.gold("state_stats")))


@query()
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """All jobs; one row with what they report."""
    settings = _settings(spark, folder, "run")
    done = jobs.run_all(spark, settings)
    learned, exported = done["learn"], done["export"]
    row = (
        done["refine"]["final_rows"],
        learned["samples"],
        learned.get("severity_accuracy"),
        learned["risk_zones"],
        learned["hotspots"],
        sum(done["marts"].values()),
        sum(rows or 0 for rows, _ in exported.values()),
    )
    return spark.createDataFrame(
        [row],
        "silver_rows bigint, samples bigint, severity_accuracy double, risk_zones bigint, hotspots bigint, "
        "mart_rows bigint, exported_rows bigint",
    )


# --- exact figures of the learned results and further branches -----------------------------------------


@query()
def job_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    """Hotspots that the learning job wrote, while its classifier saw 300 rows only."""
    settings = replace(_settings(spark, folder, "hotspots"), sample_rows=300)
    jobs.ingest(spark, settings)
    jobs.refine(spark, settings)
    jobs.learn(spark, settings)
    return comparable(files.read_parquet(spark, settings.layout.gold("ml_hotspots")))


@query()
def confusion_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows per label, as the confusion counts have them."""
    return confusion_matrix(spark, folder).groupBy("severity").agg(F.sum("count").alias("test_rows"))


@query()
def severity_test_figures(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics that do not depend on the model, and that accuracy and F1 are shares."""
    bounded = F.col("accuracy").between(0, 1) & F.col("weighted_f1").between(0, 1)
    return severity_accuracy(spark, folder).select("test_rows", F.round("majority_share", 6).alias("majority_share"), bounded.alias("bounded"))


@query()
def accuracy_recomputed(spark: SparkSession, folder: str) -> DataFrame:
    """The reported accuracy, which every row carries, against the share of right predictions among the rows."""
    right = F.avg((F.col("prediction") == F.col("severity")).cast("double"))
    same = F.abs(right - F.max("accuracy")) < 1e-9
    return severity_predictions(spark, folder).agg(F.count(F.lit(1)).alias("test_rows"), same.alias("same"))


@query()
def importance_planted(spark: SparkSession, folder: str) -> DataFrame:
    """The input that the fixture derives severity from is the most important one."""
    return severity.feature_importance(_learned(spark, folder).severity, top=1).select("feature")


@query()
def prediction_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Label and place of every predicted row; the prediction is one of the labels."""
    known = F.col("prediction").isin(1.0, 2.0, 3.0, 4.0) & F.col("training_timestamp").isNotNull()
    return severity_predictions(spark, folder).select("severity", "start_lat", "start_lng", "model_type", known.alias("known"))


@query()
def importance_total(spark: SparkSession, folder: str) -> DataFrame:
    every = severity.feature_importance(_learned(spark, folder).severity)
    return every.agg(F.count(F.lit(1)).alias("inputs"), F.round(F.sum("importance"), 6).alias("total"))


@query()
def zone_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Records and severity over all zones together."""
    return risk_zones(spark, folder).agg(
        F.count(F.lit(1)).alias("zones"),
        F.sum("accident_count").alias("accidents"),
        F.round(F.sum(F.col("accident_count") * F.col("avg_severity")), 3).alias("severity"),
        F.bool_and(F.col("center_lat").between(24, 50) & F.col("center_lng").between(-130, -65)).alias("inside"),
    )


@query()
def score_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    return score_all(spark, folder).select("id", "severity", F.col("prediction").isin(1.0, 2.0, 3.0, 4.0).alias("known"))


@query()
def page_risk_zones_shape(spark: SparkSession, folder: str) -> DataFrame:
    """The zone page holds the largest zones, largest first."""
    zone_rows = risk_zones(spark, folder).orderBy(F.col("accident_count").desc(), "risk_zone").limit(3)
    page = page_risk_zones(spark, folder).select("risk_zone", "accident_count")
    return page.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(page.exceptAll(zone_rows.select("risk_zone", "accident_count")).count()).cast("bigint").alias("strangers"),
    )


@query()
def page_predictions_shape(spark: SparkSession, folder: str) -> DataFrame:
    """The second page of predictions, ordered by label within one training time."""
    return page_predictions(spark, folder).agg(F.count(F.lit(1)).alias("rows"), F.min("severity").alias("least"))


@query()
def run_figures(spark: SparkSession, folder: str) -> DataFrame:
    """The exact figures of the run summary."""
    return run_summary(spark, folder).drop("severity_accuracy")


@query()
def job_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and incidents of the four marts that the job wrote, read through their views."""
    settings = _settings(spark, folder, "marts")
    jobs.ingest(spark, settings)
    jobs.refine(spark, settings)
    jobs.build_marts(spark, settings)
    open_marts(spark, settings.layout)
    four = ("state_stats", "time_patterns", "weather_analysis", "city_hotspots")
    counts = [
        f"SELECT '{m}' AS mart, count(*) AS rows, cast(sum(total_accidents) AS bigint) AS accidents FROM {m}" for m in four
    ]
    return spark.sql(" UNION ALL ".join(counts))


@query()
def landing_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Files from a landing folder, ingested as a stream, refined."""
    raw = incidents_bronze(spark, folder).drop(snapshots.BATCH)
    landing, root = fresh_path(spark, "arrivals"), fresh_path(spark, "arrived")
    sinks.write_csv(raw, landing)
    table = "sedimark_jobs." + root.rsplit("/", 1)[-1].replace("-", "_")
    settings = jobs.Settings(Layout(root), profile=PROFILE, table=table)
    ingest_arrivals(spark, landing, raw.schema, settings.layout.bronze, f"{root}/progress", "2025-01-01")
    jobs.refine(spark, settings)
    return catalog.read_table(spark, settings.table).drop("copy_no")


@query()
def clean_text_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Severity as text, unreadable in every tenth record."""
    bronze = incidents_bronze(spark, folder)
    text = F.when(F.col("id") % 10 == 0, "n/a").otherwise(F.col("severity").cast("string"))
    return clean(bronze.withColumn("severity", text), PROFILE).drop("copy_no")


@query()
def cast_long_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers above 2^53 keep their digits."""
    large = F.lit(9007199254740993).cast("bigint") + F.col("id")
    text = incidents_bronze(spark, folder).select("id", "copy_no", large.cast("string").alias("large"))
    return cast_columns(text, {"large": "bigint"})


@query()
def csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Text with line breaks, written as one CSV file and read back, each split of the file by itself."""
    broken = F.concat_ws("\n", "state", "city", "weather_condition")
    rows = incidents_bronze(spark, folder).select("id", "copy_no", broken.alias("lines"))
    path = fresh_path(spark, "lines")
    # Gathered by a shuffle: the rows are made by many tasks, the one that writes the file makes none.
    sinks.write_csv(rows.repartition(1), path)
    back, _ = files.split_corrupt(read_csv_records(spark, path, rows.schema))
    return back


@query()
def csv_line_breaks_whole(spark: SparkSession, folder: str) -> DataFrame:
    """The same, each file read by one task."""
    broken = F.concat_ws("\n", "state", "city", "weather_condition")
    rows = incidents_bronze(spark, folder).select("id", "copy_no", broken.alias("lines"))
    path = fresh_path(spark, "lines")
    sinks.write_csv(rows, path)
    back, _ = files.split_corrupt(files.read_csv(spark, path, rows.schema, multi_line=True))
    return back


@query()
def risk_level_by_distance(spark: SparkSession, folder: str) -> DataFrame:
    """Groups whose mean severity lies in each of the three levels."""
    bands = incidents_silver(spark, folder).groupBy(F.floor(F.col("distance_mi") / 20).cast("bigint").alias("band"))
    rated = bands.agg(F.avg("severity").alias("avg_severity"))
    return comparable(rated.select("band", "avg_severity", risk_level("avg_severity").alias("risk_level")))


@query()
def weather_category_words(spark: SparkSession, folder: str) -> DataFrame:
    """Conditions of every category, in the profile's own list."""
    words = F.array(*[F.lit(w) for w in ("SNOW", "ICE", "RAIN", "FOG", "CLEAR")])
    silver = incidents_silver(spark, folder)
    named = silver.select("id", F.element_at(words, (F.col("id") % 5 + 1).cast("int")).alias("weather_condition"))
    return named.withColumn("weather_severity", condition_category("weather_condition"))


@query()
def snapshot_redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """A day is delivered again with fewer, changed rows: they take the place of the old ones."""
    bronze, path = _stored_bronze(spark, folder)
    again = bronze.where((F.col(snapshots.BATCH) == F.lit("2025-01-02").cast("date")) & (F.col("id") % 3 == 0))
    snapshots.write_batches(again.withColumn("city", F.lit("AGAIN")), path)
    stored = files.read_parquet(spark, path).groupBy(snapshots.BATCH)
    changed = F.coalesce(F.col("city") == "AGAIN", F.lit(False))
    return stored.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.count_if(changed).alias("changed")
    )


# --- days that differ, days kept up to date ---------------------------------------------------------------


def _day(rows: DataFrame, day: str) -> DataFrame:
    return rows.where(F.col(snapshots.BATCH) == F.lit(day).cast("date"))


@query()
def snapshot_evolved(spark: SparkSession, folder: str) -> DataFrame:
    """Days with one column more, one fewer and wider types, the last day delivered first."""
    bronze = incidents_bronze(spark, folder).select("id", "copy_no", "severity", "city", "junction", "distance_mi", snapshots.BATCH)
    path = fresh_path(spark, "evolved")
    third = _day(bronze, "2025-01-03").withColumn("severity", F.col("severity") + F.lit(0.5)).withColumn("junction", F.col("junction").cast("string"))
    snapshots.write_batches(third, path)
    snapshots.write_batches(_day(bronze, "2025-01-01").drop("distance_mi"), path)
    snapshots.write_batches(_day(bronze, "2025-01-02").drop("city").withColumn("severity", F.col("severity").cast("bigint")), path)
    return history.scan(spark, path)


def _by_day(spark: SparkSession, folder: str, label: str, redelivered: bool) -> jobs.Settings:
    """Silver kept by the day: three deliveries, the second day last; then that day again, with fewer, changed rows."""
    bronze = incidents_bronze(spark, folder)
    root = fresh_path(spark, label)
    table = "sedimark_jobs." + root.rsplit("/", 1)[-1].replace("-", "_")
    settings = jobs.Settings(Layout(root), profile=PROFILE, table=table)
    for day in ("2025-01-01", "2025-01-03", "2025-01-02"):
        snapshots.write_batches(_day(bronze, day), settings.layout.bronze)
        daily.refine_daily(spark, settings, buckets=8)
        if day == "2025-01-03":
            daily.build_marts_daily(spark, settings)
    if redelivered:
        again = _day(bronze, "2025-01-02").where("id % 3 = 0").withColumn("city", F.lit("AGAIN"))
        snapshots.write_batches(again, settings.layout.bronze)
        daily.refine_daily(spark, settings, buckets=8)
    return settings


@query()
def silver_by_day(spark: SparkSession, folder: str) -> DataFrame:
    settings = _by_day(spark, folder, "by_day", redelivered=False)
    return catalog.read_table(spark, settings.table).drop("copy_no")


@query()
def silver_redelivered(spark: SparkSession, folder: str) -> DataFrame:
    settings = _by_day(spark, folder, "again", redelivered=True)
    return catalog.read_table(spark, settings.table).drop("copy_no")


@query()
def marts_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The four marts from partial sums per day, after days were added and one was delivered again."""
    settings = _by_day(spark, folder, "day_marts", redelivered=True)
    daily.build_marts_daily(spark, settings)
    none = F.lit(None).cast("string")
    figures = {
        "state_stats": (F.col("state"), none, F.col("cities_count").cast("double")),
        "time_patterns": (F.col("hour").cast("string"), F.col("day_of_week").cast("string"), F.lit(None).cast("double")),
        "weather_analysis": (F.col("weather_condition"), none, F.round("avg_temperature", 6)),
        "city_hotspots": (F.col("state"), F.col("city"), F.round(F.col("latitude") + F.col("longitude"), 5)),
    }
    made = None
    for mart, (first, second, figure) in figures.items():
        rows = files.read_parquet(spark, settings.layout.gold(mart)).select(
            F.lit(mart).alias("mart"), first.alias("k1"), second.alias("k2"), "total_accidents",
            F.round("avg_severity", 6).alias("avg_severity"), figure.alias("figure"),
        )
        made = rows if made is None else made.unionByName(rows)
    return made


@query()
def cities_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Different cities per state from stored sketches, over two of the days; whether they are close to the exact number."""
    settings = _by_day(spark, folder, "sketched", redelivered=False)
    daily.build_marts_daily(spark, settings)
    days = ("2025-01-01", "2025-01-03")
    about = daily.city_sketches(spark, settings.layout, days).withColumnRenamed("cities", "about")
    rows = catalog.read_table(spark, settings.table).where(F.col(snapshots.BATCH).isin(*[F.lit(d).cast("date") for d in days]))
    exact = rows.groupBy("state").agg(F.countDistinct("city").alias("cities"))
    close = F.abs(F.col("about") - F.col("cities")) <= F.col("cities") * 0.05 + 0.5
    return exact.join(about, "state").select("state", "cities", close.alias("close"))


@query()
def landing_redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Streamed days, one delivered again, beside a day written by a batch job."""
    raw = incidents_bronze(spark, folder)
    landing, root = fresh_path(spark, "arrivals"), fresh_path(spark, "arrived")
    bronze = f"{root}/bronze"
    schema = raw.drop(snapshots.BATCH).schema
    snapshots.write_batches(_day(raw, "2025-01-03"), bronze)
    deliveries = (
        ("2025-01-01", _day(raw, "2025-01-01")), ("2025-01-02", _day(raw, "2025-01-02")),
        ("2025-01-01", _day(raw, "2025-01-01").where("id % 3 = 0")),
    )
    for i, (day, rows) in enumerate(deliveries):
        sinks.write_csv(rows.drop(snapshots.BATCH), f"{landing}/part={i}")
        ingest_arrivals(spark, f"{landing}/part=*", schema, bronze, f"{root}/progress", day)
    stored = history.scan(spark, bronze).groupBy(snapshots.BATCH)
    return stored.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.sum("severity").alias("severity"))
