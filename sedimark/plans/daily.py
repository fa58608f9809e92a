"""Silver and the marts kept up to date by the day: a new or redelivered batch costs its own rows, not the history.

Silver is a batch table itself: a record lies in the partition of the day it survived from. Beside it is the key state, a
table bucketed by the key with each key's day and tie-break values. The winners of the changed days are merged against
it. Keys whose winner was in a changed day lose it first and are ranked again from the other days of Bronze. Only days
that gain or lose a winner are then written, from Bronze and the new state; Silver is never read.

Every write of a day gets an id (see `history`), so the marts know which days changed since they were built: the partial
sums of those days are made anew, and a mart adds up all days' partial sums.

A ledger names the state that holds, the deliveries it was made from and days whose Silver may be unfinished. It is the
last thing written, and a job that failed is simply run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimark.operators import snapshots
from sedimark.operators.cleaning import clean, ranked_rows
from sedimark.operators.dedup import keep_first
from sedimark.plans import marts
from sedimark.plans.jobs import MART_FILES, Settings
from sedimark.profile import RecordProfile
from sedimark.session import delete_path, intermediates, list_folders, path_exists, read_text, write_text
from sedimark.sources import catalog, files, history, sinks
from sedimark.sources.history import BATCH
from sedimark.sources.layout import Layout

KEY_BUCKETS = 64


@dataclass(frozen=True)
class Ledger:
    """What the last completed run made: state, the deliveries in it, Bronze's schema; and days left unfinished."""

    state: str | None = None
    deliveries: dict[str, str] = field(default_factory=dict)
    schema: str = ""
    pending: tuple[str, ...] = ()

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ledger:
        return Ledger(**json.loads(read_text(spark, path))) if path_exists(spark, path) else Ledger()

    def save(self, spark: SparkSession, path: str) -> None:
        write_text(spark, path, json.dumps(asdict(self)))


def deciding_columns(profile: RecordProfile) -> list[str]:
    """The tie-break columns that decide between rows of different days."""
    if profile.tie_break_is_total:
        return list(profile.tie_break)
    if BATCH not in profile.tie_break:
        raise ValueError(f"keeping Silver by the day needs a total tie-break, or one that has {BATCH}")
    return list(profile.tie_break[: profile.tie_break.index(BATCH) + 1])


def _winners(rows: DataFrame, profile: RecordProfile) -> DataFrame:
    """(key, by, day): the first row of each key, with the values that compare it to rows of other days."""
    filled, rules, order = ranked_rows(rows, profile)
    first = keep_first(filled, rules.key, order)
    return first.select(F.col(rules.key).alias("key"), F.struct(*deciding_columns(rules)).alias("by"), F.col(BATCH).alias("day"))


def _state(spark: SparkSession, settings: Settings, path: str, schema: Any, buckets: int) -> DataFrame:
    """The stored key state as a bucketed table of this session, so that joins by key do not move it."""
    table = f"{settings.table}_keys_{path.rsplit('-', 1)[-1]}"
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {catalog.quoted(table)} ({catalog.column_ddl(schema)}) USING parquet "
        f"CLUSTERED BY (key) INTO {int(buckets)} BUCKETS LOCATION '{location}'"
    )
    return spark.table(table)


def _forget_state(spark: SparkSession, settings: Settings, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {catalog.quoted(settings.table + '_keys_' + path.rsplit('-', 1)[-1])}")
    delete_path(spark, path)


def merged_state(old: DataFrame | None, candidates: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of new keys, and those of the keys known before, with `touched`: the days that gain or lose a winner."""
    won = candidates.withColumn("touched", F.array("day"))
    if old is None:
        return won, None
    mine = candidates.select(F.col("key"), F.col("by").alias("by2"), F.col("day").alias("day2")).hint("shuffle_hash")
    better = F.col("by2").isNotNull() & (F.col("by2") < F.col("by"))
    known = old.join(mine, "key", "left").select(
        "key", F.when(better, F.col("by2")).otherwise(F.col("by")).alias("by"),
        F.when(better, F.col("day2")).otherwise(F.col("day")).alias("day"),
        F.when(better, F.array("day", "day2")).otherwise(F.array().cast("array<date>")).alias("touched"),
    )
    return won.join(old.select("key"), "key", "left_anti"), known


def _write_state(path: str, table: str, parts: Sequence[DataFrame], buckets: int) -> set[str]:
    """Each part as a file per bucket; returns the days touched. Parts that lie in buckets already are not moved."""
    days: set[str] = set()
    for part in parts:
        seen = Observation()
        told = part.withColumn("touched", F.transform("touched", lambda d: d.cast("string")))
        sets = [F.collect_set(F.get("touched", F.lit(i))).alias(f"t{i}") for i in range(2)]
        placed = told.repartition(buckets, "key").observe(seen, *sets).drop("touched")
        placed.write.format("parquet").mode("append").option("path", path).bucketBy(buckets, "key").saveAsTable(table)
        said = sinks.observed(seen)
        days.update(said.get("t0", []), said.get("t1", []))
    return days


def refine_daily(spark: SparkSession, settings: Settings, buckets: int = KEY_BUCKETS) -> dict[str, Any]:
    """Bring Silver up to the present Bronze; returns the days that changed there and the days written in Silver.

    The first run, and one after Bronze's columns changed, takes all days. A day is taken again when it was delivered
    again; a day that Bronze no longer has is withdrawn. The rows are those of `clean` over all of Bronze.
    """
    layout, profile = settings.layout, settings.profile
    stored = history.batches(spark, layout.bronze)
    bronze_schema = history.merged(b.schema for b in stored).json()
    present = {b.day: b.delivery for b in stored}
    ledger = Ledger.load(spark, layout.silver_ledger)
    if ledger.schema != bronze_schema:
        ledger = Ledger(ledger.state, schema=bronze_schema, pending=tuple(d.day for d in history.batches(spark, layout.silver_daily)))
        fresh = True
    else:
        fresh = ledger.state is None
    changed = [d for d in present if ledger.deliveries.get(d) != present[d]]
    gone = [d for d in ledger.deliveries if d not in present]
    if not (changed or gone or ledger.pending):
        return {"changed": [], "written": []}

    def bronze(days: Sequence[str]) -> DataFrame:
        return files.split_corrupt(history.scan(spark, layout.bronze, days, stored))[0]

    database, dot, _ = settings.table.rpartition(".")
    if dot:
        catalog.create_database(spark, database)
    with intermediates(spark):
        candidates = _winners(bronze(changed), profile)
        old = None
        if not fresh:
            was = _state(spark, settings, ledger.state, candidates.schema, buckets)
            lost = F.col("day").isin(*[F.lit(d).cast("date") for d in [*changed, *gone]])
            old = was.where(~lost)
            rest = [d for d in present if d not in changed]
            if rest and any(d in ledger.deliveries for d in [*changed, *gone]):
                # Keys without a winner now are ranked again among the days that did not change.
                withdrawn = was.where(lost).select(F.col("key").alias(profile.key))
                again = _winners(bronze(rest).join(withdrawn, profile.key, "left_semi"), profile)
                candidates = keep_first(candidates.unionByName(again), "key", ["by"])
        candidates, _ = sinks.materialized(candidates, "key-candidates")
        version = uuid.uuid4().hex
        path, table = layout.key_state(version), f"{settings.table}_keys_{version}"
        new, known = merged_state(old, candidates)
        touched = _write_state(path, table, [p for p in (new, known) if p is not None], buckets)
        written = sorted({*touched, *changed, *gone, *ledger.pending})
        Ledger(ledger.state, ledger.deliveries, ledger.schema if not fresh else "", tuple(written)).save(spark, layout.silver_ledger)

        state = spark.table(table).select(F.col("key").alias(profile.key), F.col("day").alias(BATCH))
        state = state.where(F.col(BATCH).isin(*[F.lit(d).cast("date") for d in written]))

        def survivors(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
            return keep_first(rows, [key, BATCH], order).join(state, [key, BATCH], "left_semi")

        days = [d for d in written if d in present]
        silver = clean(bronze(days), profile, survivors)
        filled = snapshots.write_batches(silver, layout.silver_daily, rebalance=True)
    for day in set(written) - set(filled):
        history.forget(spark, layout.silver_daily, day)
    catalog.sync_external(spark, settings.table, layout.silver_daily, silver.schema, [BATCH])
    Ledger(path, present, bronze_schema).save(spark, layout.silver_ledger)
    for older in list_folders(spark, layout.key_states):
        if older.rsplit("-", 1)[-1] != version:
            _forget_state(spark, settings, older)
    return {"changed": sorted([*changed, *gone]), "written": written}


# The finest keys and the sums that the marts are made of.
PARTIALS = {
    "cities": (
        {"state": "state", "city": "city"},
        {
            "rows": "count(*)", "severity": "sum(severity)", "rated": "count(severity)", "lat": "sum(start_lat)",
            "lng": "sum(start_lng)", "located": "count(start_lat)",
        },
    ),
    "hours": (
        {"hour": "hour(start_time)", "day_of_week": "dayofweek(start_time)"},
        {"rows": "count(*)", "severity": "sum(severity)", "rated": "count(severity)"},
    ),
    "conditions": (
        {"weather_condition": "weather_condition"},
        {
            "rows": "count(*)", "severity": "sum(severity)", "rated": "count(severity)", "temperature": "sum(temperature_f)",
            "measured": "count(temperature_f)",
        },
    ),
    "sketches": ({"state": "state"}, {"cities": "hll_sketch_agg(city, 12)"}),
}


def _update_partials(spark: SparkSession, layout: Layout) -> list[str]:
    """Partial sums of the Silver days written since they were last made; returns those days."""
    silver = history.batches(spark, layout.silver_daily)
    present = {b.day: b.delivery for b in silver}
    ledger = Ledger.load(spark, layout.partials_ledger)
    changed = [d for d in present if ledger.deliveries.get(d) != present[d] or d in ledger.pending]
    gone = [d for d in {*ledger.deliveries, *ledger.pending} if d not in present]
    if not (changed or gone):
        return []
    Ledger(deliveries=ledger.deliveries, pending=(*changed, *gone)).save(spark, layout.partials_ledger)
    if changed:
        with sinks.kept(history.scan(spark, layout.silver_daily, changed, silver).select(*MART_COLUMNS, BATCH)) as rows:
            for name, (keys, sums) in PARTIALS.items():
                grouped = rows.groupBy(BATCH, *[F.expr(e).alias(k) for k, e in keys.items()])
                made = grouped.agg(*[F.expr(e).alias(s) for s, e in sums.items()])
                filled = snapshots.write_batches(made, layout.partials(name), rebalance=True)
                for day in set(changed) - set(filled):
                    history.forget(spark, layout.partials(name), day)
    for name in PARTIALS:
        for day in gone:
            history.forget(spark, layout.partials(name), day)
    Ledger(deliveries=present).save(spark, layout.partials_ledger)
    return sorted([*changed, *gone])


MART_COLUMNS = ("state", "city", "severity", "start_lat", "start_lng", "start_time", "weather_condition", "temperature_f")


def summed(spark: SparkSession, layout: Layout, name: str, days: Sequence[str] | None = None) -> DataFrame:
    """The partial sums added up over all days, or the named ones."""
    keys, sums = PARTIALS[name]
    rows = history.scan(spark, layout.partials(name), days)
    return rows.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])


def city_sketches(spark: SparkSession, layout: Layout, days: Sequence[str] | None = None) -> DataFrame:
    """state, cities: about how many different cities each state has in the days, from their stored sketches."""
    rows = history.scan(spark, layout.partials("sketches"), days)
    return rows.groupBy("state").agg(F.hll_sketch_estimate(F.hll_union_agg("cities")).alias("cities"))


def _average(sums: str, rows: str):
    return F.try_divide(sums, rows)


def build_marts_daily(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """The four aggregate marts from partial sums per day; only days written since are read from Silver."""
    layout = settings.layout
    _update_partials(spark, layout)
    hours, conditions = summed(spark, layout, "hours"), summed(spark, layout, "conditions")
    written = {}
    with sinks.kept(summed(spark, layout, "cities")) as cities:
        results = {
            "state_stats": marts.state_stats_from(cities),
            "city_hotspots": marts.city_hotspots_from(cities),
            "time_patterns": hours.select(
                "hour", "day_of_week", F.col("rows").alias("total_accidents"), _average("severity", "rated").alias("avg_severity")
            ),
            "weather_analysis": conditions.where("weather_condition IS NOT NULL").select(
                "weather_condition", F.col("rows").alias("total_accidents"), _average("severity", "rated").alias("avg_severity"),
                _average("temperature", "measured").alias("avg_temperature"),
            ).orderBy(F.col("total_accidents").desc(), "weather_condition"),
        }
        for name, result in results.items():
            written[name] = sinks.write_parquet(result, layout.gold(name), files=MART_FILES)
    return written
