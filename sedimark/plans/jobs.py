"""The jobs from source file to exported marts. Each one reads and writes tables of a `Layout`."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.functions import tidy_name, tidy_names
from sedimark.learning import features, severity, zones
from sedimark.operators import snapshots
from sedimark.operators.cleaning import clean, quality_report
from sedimark.plans import marts
from sedimark.plans.serving import MARTS, mart_path
from sedimark.profile import INCIDENTS, RecordProfile
from sedimark.session import delete_path, intermediates, list_folders
from sedimark.sources import catalog, files, history, sinks
from sedimark.sources.layout import Layout

log = logging.getLogger(__name__)

# Simulated batch days with their shares, files per mart.
DAYS = {"2025-01-01": 0.33, "2025-01-02": 0.33, "2025-01-03": 0.34}
MART_FILES = 2
SILVER_TABLE = "incidents_db.silver"

# Marts with a row per scored record; all others have a top-k or a small key domain.
UNBOUNDED_MARTS = ("ml_severity_predictions",)


@dataclass(frozen=True)
class Settings:
    """Where the jobs read and write.

    `sample_rows` is the number of labelled rows used to fit the severity classifier (None: all); nothing else
    is sampled. `even_files` shuffles each ingested day into files of even size, instead of one file per
    input split and day. `ml_fallback` is a second root for the learned marts, used when writing one fails.
    """

    layout: Layout
    source: str | None = None
    schema: T.StructType | None = None
    days: Mapping[str, float] | None = None
    profile: RecordProfile = INCIDENTS
    table: str = SILVER_TABLE
    sample_rows: int | None = severity.SAMPLE_ROWS
    jdbc: Mapping[str, str] | None = None
    csv_fallback: bool = True
    even_files: bool = True
    ml_fallback: str | None = None


class Tally:
    """Counts the rows between the steps of cleaning while they pass."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def lines(self, rows: DataFrame) -> DataFrame:
        bad = F.count_if(F.col(files.CORRUPT).isNotNull()) if files.CORRUPT in rows.columns else F.lit(0).cast("bigint")
        counts = [F.count(F.lit(1)).alias("rows"), (bad if files.CORRUPT in rows.columns else F.sum(bad)).alias("corrupt")]
        return rows.observe(self.seen.setdefault("initial_rows", Observation()), *counts)

    def watch(self, step: str, rows: DataFrame) -> DataFrame:
        return rows.observe(self.seen.setdefault(step, Observation()), F.count(F.lit(1)).alias("rows"))

    def figures(self, final: int) -> dict[str, Any]:
        """The quality report's figures, and the number of corrupt lines."""
        seen = {step: sinks.observed(o) for step, o in self.seen.items()}
        initial, required, distinct = (int(seen[s].get("rows", 0)) for s in ("initial_rows", "required_rows", "distinct_rows"))
        removed = initial - final
        return {
            "initial_rows": initial, "required_rows": required, "distinct_rows": distinct, "final_rows": final,
            "duplicate_rows": required - distinct, "removed_rows": removed,
            "removed_percent": removed * 100.0 / initial if initial else 0.0,
            "corrupt_lines": int(seen["initial_rows"].get("corrupt") or 0),
        }


def ingest(spark: SparkSession, settings: Settings) -> None:
    """Source CSV to dated Bronze partitions, in one pass.

    Lines that do not parse stay in Bronze with their text, see `files.split_corrupt`.
    """
    schema = settings.schema or files.raw_schema()
    lines = files.read_csv(spark, settings.source, schema)
    key = next(c for c in lines.columns if tidy_name(c) == settings.profile.key)
    dated = snapshots.spread_over_days(lines, settings.days or DAYS, [key])
    snapshots.write_batches(tidy_names(dated), settings.layout.bronze, rebalance=settings.even_files)


def refine(spark: SparkSession, settings: Settings, as_of: str | None = None) -> dict[str, Any]:
    """Bronze snapshot to the cleaned Silver table; returns the quality report and the number of corrupt lines.

    Silver is written to a new folder, then the table is switched to it. The folder it showed before stays until the
    next run, for readers that are at work; a failed write leaves the table as it was. The figures are taken by the tasks
    that clean and write, in one pass over Bronze.
    """
    layout = settings.layout
    lines = snapshots.snapshot(history.scan(spark, layout.bronze), as_of)
    tally = Tally()
    bronze, _ = files.split_corrupt(tally.lines(lines))
    silver = clean(bronze, settings.profile, watch=tally.watch)
    path = layout.silver_version(uuid.uuid4().hex)
    written = sinks.write_parquet(silver, path)
    database, dot, _ = settings.table.rpartition(".")
    if dot:
        catalog.create_database(spark, database)
    before = catalog.location_of(spark, settings.table) or ""
    catalog.switch_external(spark, settings.table, path, silver.schema)
    for older in list_folders(spark, layout.silver):
        if older.rsplit("/", 1)[-1] not in (path.rsplit("/", 1)[-1], before.rsplit("/", 1)[-1]):
            delete_path(spark, older)
    figures = tally.figures(written)
    # Tasks that ran again after a loss of executors are counted twice; the stored number of lines, which the files'
    # footers hold, tells. The figures are then taken by a query.
    if figures["initial_rows"] != lines.count():
        plain, corrupt = files.split_corrupt(lines)
        figures = {**quality_report(plain, settings.profile).first().asDict(), "corrupt_lines": corrupt.count()}
    return figures


def learning_rows(silver: DataFrame, profile: RecordProfile) -> DataFrame:
    """The available columns of every cleaned record, prepared for learning."""
    return features.prepare(catalog.select_available(silver, profile.learning_columns, profile.learning_required), profile)


def learn(spark: SparkSession, settings: Settings) -> dict[str, Any]:
    """Train both models, write their marts and the hotspots; returns the run summary.

    Classes, zones and hotspots are those of all of Silver; only the classifier is fitted on a bounded
    sample. A table without the key or with few columns gives zones and hotspots, but no severity model.
    """

    def write(df: DataFrame, mart: str, **options: Any) -> int:
        def to(layout: Layout) -> int:
            return sinks.write_parquet(df, layout.gold(mart), **options)

        spare = settings.ml_fallback and Layout(settings.ml_fallback)
        return sinks.write_or_divert(lambda: to(settings.layout), (lambda: to(spare)) if spare else None, f"writing {mart}")[0]

    layout, profile = settings.layout, settings.profile
    prepared = learning_rows(catalog.read_table(spark, settings.table), profile)
    with intermediates(spark):
        classes = {row["severity"]: row["count"] for row in marts.CLASS_DISTRIBUTION.of(prepared).collect()}
        summary: dict[str, Any] = {"samples": 0, "class_distribution": classes}
        with severity.training_sample(prepared, profile.key, settings.sample_rows) as sample:
            run = severity.train_severity(sample, (profile.key,)) if sample is not None else None
            if run is not None:
                summary["samples"] = sample.count()
                write(run.predictions, "ml_severity_predictions", even=True)
                severity.save_model(run.model, layout.model("severity"))
                summary["severity_accuracy"] = run.accuracy
        # Only what K-means and the profile of its zones read.
        with sinks.kept(zones.zone_columns(prepared)) as placed:
            profiled = zones.zone_profile(zones.assign_zones(zones.fit_zones(placed), placed))
            summary["risk_zones"] = write(profiled, "ml_risk_zones", files=MART_FILES)
        summary["hotspots"] = write(marts.grid_hotspots().of(prepared), "ml_hotspots", files=MART_FILES)
    return summary


def build_marts(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """The four aggregate marts; the state and the city mart share one aggregation of Silver."""
    layout = settings.layout
    silver = catalog.read_table(spark, settings.table)
    written = {}
    with sinks.kept(marts.city_sums(silver)) as cities:
        results = {
            "state_stats": marts.state_stats_from(cities),
            "city_hotspots": marts.city_hotspots_from(cities),
            "time_patterns": marts.TIME_PATTERNS.of(silver),
            "weather_analysis": marts.WEATHER_ANALYSIS.of(silver),
        }
        for name, result in results.items():
            written[name] = sinks.write_parquet(result, layout.gold(name), files=MART_FILES)
    return written


def export(spark: SparkSession, settings: Settings) -> dict[str, tuple[int | None, bool]]:
    """Every mart to the JDBC target, or to CSV where none is given or it fails.

    Returns rows and whether CSV took the place of JDBC, per mart; rows is None for a mart that was not built.
    """
    sent: dict[str, tuple[int | None, bool]] = {}
    for mart in MARTS:
        place = mart_path(spark, settings.layout, mart, settings.ml_fallback)
        if place is None:
            log.warning("%s was not built and is not exported", mart)
            sent[mart] = (None, False)
            continue
        rows = files.read_parquet(spark, place)

        def to_csv(rows: DataFrame = rows, mart: str = mart) -> int:
            bounded = mart not in UNBOUNDED_MARTS
            return sinks.write_csv(rows, settings.layout.export(mart), files=1 if bounded else None, even=not bounded)

        if settings.jdbc is None:
            sent[mart] = (to_csv(), False)
            continue

        def to_jdbc(rows: DataFrame = rows, mart: str = mart) -> int:
            return sinks.write_jdbc(rows, mart, settings.jdbc)

        sent[mart] = sinks.write_or_divert(to_jdbc, to_csv if settings.csv_fallback else None, f"export of {mart}")
    return sent


def run_all(spark: SparkSession, settings: Settings) -> dict[str, Any]:
    """Ingest, refine, learn, build marts, export; the first failure ends the run."""
    done: dict[str, Any] = {}
    for name, job in (
        ("ingest", ingest), ("refine", refine), ("learn", learn), ("marts", build_marts), ("export", export),
    ):
        log.info("job %s starts", name)
        done[name] = job(spark, settings)
    return done
