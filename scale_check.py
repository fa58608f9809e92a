"""Run all jobs over a source file of the size of the logged baseline run (7.7 million rows, about 3 GB).

The file is made from the driver's `events`, `customer` and `nation` tables: every incident is repeated
with new keys and shifted times and places until the wanted number of rows is reached, in the 46 columns
of the source layout. Prints the seconds of each job as one JSON line, and writes them with the settings and the
jobs' reports to a file in the work folder.

    python scale_check.py WORK_FOLDER [ROWS]
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark import build_session
from sedimark.functions import tidy_name
from sedimark.plans import jobs
from sedimark.profile import FLAG_COLUMNS, RAW_COLUMNS
from sedimark.sources import sinks
from sedimark.sources.fixtures import incidents_bronze
from sedimark.sources.layout import Layout

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BASELINE_ROWS = 7_728_394


def source_rows(spark: SparkSession, rows: int) -> DataFrame:
    once = incidents_bronze(spark, SF_DIR).drop("copy_no", "situation_date")
    repeats = -(-rows // once.count())
    many = once.repartition(64).withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    made = many.select(
        F.concat(F.lit("A-"), F.col("id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.lit("Source2").alias("source"),
        "severity",
        F.expr("timestampadd(MINUTE, turn * 61, start_time)").cast("timestamp").alias("start_time"),
        F.expr("timestampadd(MINUTE, turn * 61 + 29, start_time)").cast("timestamp").alias("end_time"),
        (F.col("start_lat") + F.col("turn") % 10 * 0.01).alias("start_lat"),
        (F.col("start_lng") + F.col("turn") % 10 * 0.01).alias("start_lng"),
        "end_lat",
        "end_lng",
        "distance_mi",
        F.concat_ws(
            " ", F.lit("Accident on the road near exit"), F.col("id").cast("string"), F.lit("with delays in"), "city"
        ).alias("description"),
        F.concat(F.lit("Street "), (F.col("id") % 9973).cast("string")).alias("street"),
        F.concat_ws("-", "city", (F.col("turn") % 80).cast("string")).alias("city"),
        F.concat(F.lit("County "), (F.col("id") % 300).cast("string")).alias("county"),
        "state",
        F.lpad((F.col("id") % 99999).cast("string"), 5, "0").alias("zipcode"),
        F.lit("US").alias("country"),
        F.lit("US/Eastern").alias("timezone"),
        F.concat(F.lit("K"), (F.col("id") % 900).cast("string")).alias("airport_code"),
        F.col("start_time").cast("timestamp").alias("weather_timestamp"),
        "temperature_f",
        F.col("temperature_f").alias("wind_chill_f"),
        "humidity",
        "pressure_in",
        "visibility_mi",
        "wind_direction",
        "wind_speed_mph",
        (F.col("id") % 100 / 100.0).alias("precipitation_in"),
        "weather_condition",
        *[
            (F.col("id") % (n + 3) == 0).alias(flag) if flag not in many.columns else F.col(flag)
            for n, flag in enumerate(FLAG_COLUMNS)
        ],
        "sunrise_sunset",
        F.col("sunrise_sunset").alias("civil_twilight"),
        F.col("sunrise_sunset").alias("nautical_twilight"),
        F.col("sunrise_sunset").alias("astronomical_twilight"),
    )
    return made.select(*[F.col(tidy_name(c)).alias(c) for c in RAW_COLUMNS]).limit(rows)


def main() -> None:
    work = sys.argv[1]
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else BASELINE_ROWS
    conf = {
        "spark.sql.shuffle.partitions": str(4 * int(CPUS)),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.local.dir": f"{work}/local",
        "spark.sql.warehouse.dir": f"{work}/warehouse",
        "spark.checkpoint.dir": f"{work}/checkpoints",
    }
    spark = build_session("scale", f"local[{CPUS}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    source = f"{work}/source-{rows}"
    if not os.path.exists(f"{source}/_SUCCESS"):
        sinks.write_csv(source_rows(spark, rows), source)
    settings = jobs.Settings(Layout(f"{work}/run-{int(time.time())}"), source)
    seconds, said = {}, {}
    for name in ("ingest", "refine", "learn", "build_marts", "export"):
        start = time.perf_counter()
        said[name] = getattr(jobs, name)(spark, settings)
        seconds[name] = round(time.perf_counter() - start, 1)
        print(name, seconds[name], said[name], file=sys.stderr)
    result = {"rows": rows, "cpus": int(CPUS), "seconds": seconds, "total": round(sum(seconds.values()), 1), "conf": conf, "said": said}
    with open(f"{work}/scale-{int(time.time())}.json", "w") as out:
        json.dump(result, out, default=str)
    print(json.dumps({k: v for k, v in result.items() if k != "said"}))
    spark.stop()


if __name__ == "__main__":
    main()
