"""DuckDB SQL that must give the same rows as the Spark queries of the same name.

Every statement starts from the same two views over the driver tables: `incidents_bronze` and
`incidents_silver`.
"""

from __future__ import annotations

VIEWS = """
WITH base AS (
  SELECT e.event_id, e.ts, e.event_type, e.value, e.user_id, n.n_name, c.c_mktsegment
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
one AS (
  SELECT event_id AS id, ts AS start_time,
    CASE WHEN value >= 150 THEN 5 WHEN value >= 80 THEN 4 WHEN value >= 40 THEN 3
         WHEN value >= 10 THEN 2 ELSE 1 END AS severity,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE ' ' || lower(n_name) || ' ' END AS state,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE c_mktsegment END AS city,
    20 + (user_id * 7919 % 320) / 10.0E0 AS start_lat,
    -135 + (user_id * 104729 % 750) / 10.0E0 + (event_id % 4) * 0.03E0 AS start_lng,
    CASE WHEN event_id % 5 < 2 THEN NULL ELSE 20 + (user_id * 7919 % 320) / 10.0E0 + 0.01E0 END AS end_lat,
    CASE WHEN event_id % 5 < 2 THEN NULL ELSE -135 + (user_id * 104729 % 750) / 10.0E0 END AS end_lng,
    value AS distance_mi,
    CASE WHEN event_id % 9 = 0 THEN NULL ELSE 20 + value % 80 END AS temperature_f,
    CASE WHEN event_id % 8 = 0 THEN NULL ELSE 30.0E0 + event_id % 60 END AS humidity,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 29.0E0 + (event_id % 20) / 10.0E0 END AS pressure_in,
    CASE WHEN event_id % 12 = 0 THEN NULL ELSE 1.0E0 + event_id % 10 END AS visibility_mi,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 0.5E0 * (event_id % 40) END AS wind_speed_mph,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN ' ' || event_type || ' '
         ELSE event_type END AS weather_condition,
    CASE WHEN event_id % 14 = 0 THEN NULL ELSE substr('nesw', CAST(event_id % 4 + 1 AS INT), 1) END
      AS wind_direction,
    CASE WHEN event_id % 15 = 0 THEN NULL WHEN hour(ts) BETWEEN 6 AND 18 THEN 'Day' ELSE 'Night' END
      AS sunrise_sunset,
    event_id % 3 = 0 AS junction, event_type = 'error' AS traffic_signal,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 2 = 0 END AS crossing,
    CASE WHEN event_id % 100 < 33 THEN DATE '2025-01-01' WHEN event_id % 100 < 66 THEN DATE '2025-01-02'
         ELSE DATE '2025-01-03' END AS situation_date,
    0 AS copy_no
  FROM base),
incidents_bronze AS (
  SELECT * FROM one
  UNION ALL
  SELECT id, start_time, 4, state, 'COPY', start_lat, start_lng, end_lat, end_lng, distance_mi,
    temperature_f, humidity, pressure_in, visibility_mi, wind_speed_mph, weather_condition, wind_direction,
    sunrise_sunset, junction, traffic_signal, crossing, DATE '2025-01-03', 1
  FROM one WHERE id % 19 = 0),
required AS (
  SELECT * FROM incidents_bronze
  WHERE id IS NOT NULL AND severity IS NOT NULL AND state IS NOT NULL
    AND start_lat IS NOT NULL AND start_lng IS NOT NULL AND start_time IS NOT NULL),
filled AS (
  SELECT id, start_time, severity, upper(trim(state)) AS state, city, start_lat, start_lng,
    coalesce(end_lat, start_lat) AS end_lat, coalesce(end_lng, start_lng) AS end_lng, distance_mi,
    coalesce(temperature_f, 70.0E0) AS temperature_f, coalesce(humidity, 60.0E0) AS humidity,
    coalesce(pressure_in, 29.92E0) AS pressure_in, coalesce(visibility_mi, 10.0E0) AS visibility_mi,
    coalesce(wind_speed_mph, 5.0E0) AS wind_speed_mph,
    upper(trim(coalesce(weather_condition, 'Clear'))) AS weather_condition,
    upper(trim(coalesce(wind_direction, 'CALM'))) AS wind_direction,
    coalesce(sunrise_sunset, 'Day') AS sunrise_sunset, junction, traffic_signal, crossing, situation_date,
    row_number() OVER (PARTITION BY id ORDER BY copy_no) AS rn
  FROM required),
incidents_silver AS (
  SELECT * EXCLUDE (rn) FROM filled
  WHERE rn = 1 AND severity BETWEEN 1 AND 4
    AND start_lat BETWEEN 24.0 AND 50.0 AND start_lng BETWEEN -130.0 AND -65.0),
state_stats AS (
  SELECT state, count(*) AS total_accidents, round(avg(severity), 6) AS avg_severity,
    count(DISTINCT city) AS cities_count
  FROM incidents_silver GROUP BY state),
time_patterns AS (
  SELECT CAST(hour(start_time) AS INTEGER) AS hour, CAST(dayofweek(start_time) + 1 AS INTEGER) AS day_of_week,
    count(*) AS total_accidents, round(avg(severity), 6) AS avg_severity
  FROM incidents_silver GROUP BY ALL),
weather_analysis AS (
  SELECT weather_condition, count(*) AS total_accidents, round(avg(severity), 6) AS avg_severity,
    round(avg(temperature_f), 6) AS avg_temperature
  FROM incidents_silver WHERE weather_condition IS NOT NULL GROUP BY weather_condition),
city_hotspots AS (
  SELECT state, city, count(*) AS total_accidents, round(avg(severity), 6) AS avg_severity,
    round(avg(start_lat), 6) AS latitude, round(avg(start_lng), 6) AS longitude
  FROM incidents_silver GROUP BY state, city HAVING count(*) >= 50
  ORDER BY total_accidents DESC, state, city NULLS FIRST LIMIT 200),
ml_hotspots AS (
  SELECT round(start_lat, 1) AS lat_grid, round(start_lng, 1) AS lng_grid, count(*) AS total_accidents,
    round(avg(severity), 6) AS avg_severity, CAST(sum(severity) AS DOUBLE) AS hotspot_score
  FROM incidents_silver GROUP BY ALL HAVING count(*) >= 5
  ORDER BY hotspot_score DESC, lat_grid, lng_grid LIMIT 50)
"""

SILVER_COLUMNS = (
    "id, start_time, severity, state, city, start_lat, start_lng, end_lat, end_lng, distance_mi, temperature_f, "
    "humidity, pressure_in, visibility_mi, wind_speed_mph, weather_condition, wind_direction, sunrise_sunset, "
    "junction, traffic_signal, crossing, situation_date"
)

def _digest(purpose: str) -> str:
    return f"md5(concat_ws('|', '{purpose}-42', CAST(id AS VARCHAR)))"


def _bound(share: float) -> str:
    """Hex text below which `share` of all digests lie."""
    return f"{int(share * 16**12):012x}"


DAY_BY_DIGEST = f"""CASE WHEN {_digest('batch')} < '{_bound(0.33)}' THEN DATE '2025-01-01'
    WHEN {_digest('batch')} < '{_bound(0.66)}' THEN DATE '2025-01-02' ELSE DATE '2025-01-03' END"""

RISK = "CASE WHEN {0} >= 3 THEN 'HIGH' WHEN {0} >= 2 THEN 'MEDIUM' ELSE 'LOW' END"

FEATURES = """
SELECT id, severity, start_lat, start_lng, distance_mi, temperature_f, humidity, pressure_in, visibility_mi,
  wind_speed_mph, CAST(coalesce(crossing, false) AS INTEGER) AS crossing, CAST(junction AS INTEGER) AS junction,
  CAST(traffic_signal AS INTEGER) AS traffic_signal, CAST(hour(start_time) AS INTEGER) AS hour,
  CAST(dayofweek(start_time) + 1 AS INTEGER) AS day_of_week
FROM incidents_silver"""

# The rows the classifier is fitted and tested on, and those of its test part.
SAMPLED = f"(SELECT * FROM incidents_silver ORDER BY {_digest('sample')}, id LIMIT 150000)"
TESTED = f"(SELECT * FROM {SAMPLED} WHERE {_digest('split')} >= '{_bound(0.8)}')"

BODIES = {
    "csv_scan_typed": "SELECT * FROM incidents_bronze",
    "clean_column_names": "SELECT id, copy_no, temperature_f, humidity, wind_speed_mph, start_lat FROM incidents_bronze",
    "required_not_null": "SELECT id, copy_no, severity, state, start_time, start_lat, start_lng FROM required",
    "fill_from_column": """SELECT id, copy_no, coalesce(end_lat, start_lat) AS end_lat,
        coalesce(end_lng, start_lng) AS end_lng FROM incidents_bronze""",
    "fill_defaults": """SELECT id, copy_no, coalesce(temperature_f, 70.0E0) AS temperature_f,
        coalesce(humidity, 60.0E0) AS humidity, coalesce(pressure_in, 29.92E0) AS pressure_in,
        coalesce(visibility_mi, 10.0E0) AS visibility_mi, coalesce(wind_speed_mph, 5.0E0) AS wind_speed_mph,
        coalesce(weather_condition, 'Clear') AS weather_condition,
        coalesce(wind_direction, 'CALM') AS wind_direction, coalesce(sunrise_sunset, 'Day') AS sunrise_sunset
        FROM incidents_bronze""",
    "normalize_text": """SELECT id, copy_no, upper(trim(state)) AS state,
        upper(trim(weather_condition)) AS weather_condition, upper(trim(wind_direction)) AS wind_direction
        FROM incidents_bronze""",
    "range_and_bbox": """SELECT id, copy_no, severity, start_lat, start_lng FROM incidents_bronze
        WHERE severity BETWEEN 1 AND 4 AND start_lat BETWEEN 24.0 AND 50.0
          AND start_lng BETWEEN -130.0 AND -65.0""",
    "dedup_by_key": """SELECT * FROM incidents_bronze
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY copy_no) = 1""",
    "dedup_sparse": """SELECT * FROM incidents_bronze
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY copy_no) = 1""",
    "dedup_hot_key": """SELECT id % 3 AS grp, id AS first_id, severity FROM incidents_bronze
        QUALIFY row_number() OVER (PARTITION BY id % 3 ORDER BY id, copy_no) = 1""",
    "quality_report": """SELECT i AS initial_rows, r AS required_rows, d AS distinct_rows, f AS final_rows,
          r - d AS duplicate_rows, i - f AS removed_rows, round((i - f) * 100.0E0 / i, 6) AS removed_percent
        FROM (SELECT (SELECT count(*) FROM incidents_bronze) AS i, (SELECT count(*) FROM required) AS r,
          (SELECT count(DISTINCT id) FROM required) AS d, (SELECT count(*) FROM incidents_silver) AS f)""",
    "cast_types": """SELECT id, copy_no, severity, start_lat, start_lng, distance_mi,
        CASE WHEN id % 10 = 0 THEN NULL ELSE temperature_f END AS temperature_f, junction, crossing, start_time
        FROM incidents_bronze""",
    "bool_to_int": """SELECT id, copy_no, CAST(junction AS INTEGER) AS junction,
        CAST(traffic_signal AS INTEGER) AS traffic_signal, CAST(crossing AS INTEGER) AS crossing
        FROM incidents_bronze""",
    "clean_silver": "SELECT * FROM incidents_silver",
    "split_parts": f"""SELECT id, copy_no, {DAY_BY_DIGEST} AS situation_date FROM incidents_bronze""",
    "union_parts": "SELECT id, copy_no, city, situation_date FROM incidents_bronze",
    "snapshot_as_of": """SELECT * FROM incidents_bronze WHERE situation_date <= DATE '2025-01-02'""",
    "snapshot_growth": """SELECT situation_date, added_rows,
          CAST(sum(added_rows) OVER (ORDER BY situation_date) AS BIGINT) AS snapshot_rows
        FROM (SELECT situation_date, count(*) AS added_rows FROM incidents_bronze GROUP BY situation_date)""",
    "snapshot_rerun": """SELECT situation_date, count(*) AS rows, count(DISTINCT id) AS ids
        FROM incidents_bronze GROUP BY situation_date""",
    "state_stats": "SELECT * FROM state_stats",
    "time_patterns": "SELECT * FROM time_patterns",
    "weather_analysis": "SELECT * FROM weather_analysis",
    "city_hotspots": "SELECT * FROM city_hotspots",
    "grid_hotspots": "SELECT * FROM ml_hotspots",
    "shared_city_sums": """SELECT 'state' AS mart, state, NULL AS city, total_accidents, avg_severity
          FROM state_stats
        UNION ALL SELECT 'city', state, city, total_accidents, avg_severity FROM city_hotspots""",
    "class_distribution": "SELECT severity, count(*) AS count FROM incidents_silver GROUP BY severity",
    "weekend_flag": """SELECT id, CASE WHEN dayofweek(start_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
        FROM incidents_silver""",
    "weather_category": """SELECT id, weather_condition, 'LOW' AS weather_severity,
          CASE WHEN weather_condition = 'ERROR' THEN 'HIGH'
            WHEN weather_condition IN ('CLICK', 'VIEW') THEN 'MEDIUM' ELSE 'LOW' END AS event_severity
        FROM incidents_silver""",
    "weather_table": """SELECT id, temperature_f, humidity, pressure_in, visibility_mi, wind_direction,
        wind_speed_mph, weather_condition FROM incidents_silver""",
    "risk_level_by_state": f"""SELECT state, avg_severity, {RISK.format('avg_severity')} AS risk_level
        FROM state_stats""",
    "summary": """SELECT (SELECT CAST(sum(total_accidents) AS BIGINT) FROM state_stats) AS total_accidents,
        (SELECT count(*) FROM state_stats) AS total_states, (SELECT count(*) FROM city_hotspots) AS total_cities""",
    "page_states": "SELECT * FROM state_stats ORDER BY total_accidents DESC, state LIMIT 10 OFFSET 10",
    "page_weather": """SELECT * FROM weather_analysis
        ORDER BY total_accidents DESC, weather_condition LIMIT 4 OFFSET 4""",
    "page_cities": """SELECT * FROM city_hotspots
        ORDER BY total_accidents DESC, state, city NULLS FIRST LIMIT 20 OFFSET 20""",
    "page_cities_filtered": """SELECT * FROM city_hotspots WHERE state = 'NATION_10'
        ORDER BY total_accidents DESC, state, city NULLS FIRST LIMIT 20""",
    "page_time": "SELECT * FROM time_patterns ORDER BY total_accidents DESC, hour, day_of_week LIMIT 24 OFFSET 24",
    "page_hotspots": "SELECT * FROM ml_hotspots ORDER BY hotspot_score DESC, lat_grid, lng_grid LIMIT 10 OFFSET 10",
    "page_info": """SELECT 2 AS page, 20 AS size, CAST(ceil(count(*) / 20.0) AS BIGINT) AS total_pages,
        count(*) AS total_items FROM city_hotspots""",
    "page_deep": """SELECT id, start_time, distance_mi FROM incidents_silver
        ORDER BY distance_mi DESC, id LIMIT 500 OFFSET 500""",
    "mart_parquet_roundtrip": "SELECT * FROM state_stats",
    "mart_csv_roundtrip": "SELECT * FROM city_hotspots",
    "external_table_roundtrip": "SELECT * FROM incidents_silver",
    "serving_sql": """SELECT state, city, total_accidents, avg_severity, latitude, longitude
        FROM city_hotspots WHERE state = 'NATION_10'""",
    "bounded_sample": f"SELECT id, severity FROM incidents_silver ORDER BY {_digest('sample')}, id LIMIT 300",
    "available_columns": "SELECT id, severity, start_lat, start_lng, start_time FROM incidents_silver",
    "train_test_split": f"""SELECT id, CASE WHEN {_digest('split')} < '{_bound(0.8)}' THEN 'train' ELSE 'test' END AS part
        FROM incidents_silver""",
    "ml_features": FEATURES,
    "pipeline_silver": f"""SELECT {SILVER_COLUMNS.replace('situation_date', DAY_BY_DIGEST + ' AS situation_date')}
        FROM incidents_silver""",
    "pipeline_state_stats": "SELECT * FROM state_stats",
    "job_hotspots": "SELECT * FROM ml_hotspots",
    "confusion_totals": f"SELECT severity, count(*) AS test_rows FROM {TESTED} GROUP BY severity",
    "severity_test_figures": f"""SELECT CAST(sum(n) AS BIGINT) AS test_rows, round(max(n) / sum(n), 6) AS majority_share,
        true AS bounded FROM (SELECT count(*) AS n FROM {TESTED} GROUP BY severity)""",
    "prediction_rows": f"""SELECT severity, start_lat, start_lng, 'severity_prediction' AS model_type, true AS known
        FROM {TESTED}""",
    "importance_total": "SELECT CAST(13 AS BIGINT) AS inputs, 1.0E0 AS total",
    "zone_totals": """SELECT CAST(5 AS BIGINT) AS zones, count(*) AS accidents,
        round(CAST(sum(severity) AS DOUBLE), 3) AS severity, true AS inside FROM incidents_silver""",
    "score_all_rows": "SELECT id, severity, true AS known FROM incidents_silver",
    "page_risk_zones_shape": "SELECT CAST(3 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS strangers",
    "page_predictions_shape": f"""SELECT count(*) AS rows, min(severity) AS least
        FROM (SELECT severity FROM {TESTED} ORDER BY severity LIMIT 10 OFFSET 10)""",
    "run_figures": f"""SELECT s AS silver_rows, n AS samples, CAST(5 AS BIGINT) AS risk_zones, h AS hotspots,
          m AS mart_rows, m + t + 5 + h AS exported_rows
        FROM (SELECT (SELECT count(*) FROM incidents_silver) AS s, (SELECT count(*) FROM {SAMPLED}) AS n,
          (SELECT count(*) FROM ml_hotspots) AS h, (SELECT count(*) FROM {TESTED}) AS t,
          (SELECT count(*) FROM state_stats) + (SELECT count(*) FROM time_patterns)
            + (SELECT count(*) FROM weather_analysis) + (SELECT count(*) FROM city_hotspots) AS m)""",
    "job_marts": " UNION ALL ".join(
        f"SELECT '{m}' AS mart, count(*) AS rows, CAST(sum(total_accidents) AS BIGINT) AS accidents FROM {m}"
        for m in ("state_stats", "time_patterns", "weather_analysis", "city_hotspots")
    ),
    "landing_to_silver": f"""SELECT {SILVER_COLUMNS.replace('situation_date', "DATE '2025-01-01' AS situation_date")}
        FROM incidents_silver""",
    "clean_text_rows": "SELECT * FROM incidents_silver WHERE id % 10 <> 0",
    "cast_long_numbers": "SELECT id, copy_no, 9007199254740993 + id AS large FROM incidents_bronze",
    "csv_line_breaks": """SELECT id, copy_no, nullif(concat_ws(chr(10), state, city, weather_condition), '') AS lines
        FROM incidents_bronze""",
    "risk_level_by_distance": f"""SELECT CAST(floor(distance_mi / 20) AS BIGINT) AS band,
        round(avg(severity), 6) AS avg_severity, {RISK.format('avg(severity)')} AS risk_level
        FROM incidents_silver GROUP BY 1""",
    "weather_category_words": """SELECT id, ['SNOW', 'ICE', 'RAIN', 'FOG', 'CLEAR'][id % 5 + 1] AS weather_condition,
        ['HIGH', 'HIGH', 'MEDIUM', 'MEDIUM', 'LOW'][id % 5 + 1] AS weather_severity FROM incidents_silver""",
    "snapshot_redelivered": """SELECT situation_date, count(*) AS rows, count(DISTINCT id) AS ids,
          count(*) FILTER (situation_date = DATE '2025-01-02') AS changed
        FROM incidents_bronze WHERE situation_date <> DATE '2025-01-02' OR id % 3 = 0 GROUP BY situation_date""",
    "csv_line_breaks_whole": """SELECT id, copy_no, nullif(concat_ws(chr(10), state, city, weather_condition), '') AS lines
        FROM incidents_bronze""",
    "accuracy_recomputed": f"SELECT count(*) AS test_rows, true AS same FROM {TESTED}",
    "importance_planted": "SELECT 'distance_mi' AS feature",
    "page_far": """SELECT id, start_time, distance_mi FROM incidents_silver
        ORDER BY distance_mi DESC, id LIMIT 500 OFFSET 500""",
    "box_scan": """SELECT id, start_lat, start_lng, start_time, severity FROM incidents_silver
        WHERE start_lat BETWEEN 30 AND 36 AND start_lng BETWEEN -110 AND -95
          AND start_time >= '2024-01-05' AND start_time < '2024-01-25'""",
    "snapshot_evolved": """SELECT id, copy_no,
          CASE WHEN situation_date = DATE '2025-01-03' THEN severity + 0.5E0 ELSE severity::DOUBLE END AS severity,
          CASE WHEN situation_date = DATE '2025-01-02' THEN NULL ELSE city END AS city, junction::VARCHAR AS junction,
          CASE WHEN situation_date = DATE '2025-01-01' THEN NULL ELSE distance_mi END AS distance_mi, situation_date
        FROM incidents_bronze""",
    "silver_by_day": "SELECT * FROM incidents_silver",
    "cities_sketched": """SELECT state, count(DISTINCT city) AS cities, true AS close FROM incidents_silver
        WHERE situation_date <> DATE '2025-01-02' GROUP BY state""",
    "landing_redelivered": """SELECT situation_date, count(*) AS rows, count(DISTINCT id) AS ids,
          CAST(sum(severity) AS BIGINT) AS severity FROM incidents_bronze
        WHERE situation_date <> DATE '2025-01-01' OR id % 3 = 0 GROUP BY situation_date""",
}


# The second day as it was delivered again, in the place of what came before.
AGAIN = VIEWS.replace("required AS (\n  SELECT * FROM incidents_bronze", """redelivered AS (
  SELECT * REPLACE (CASE WHEN situation_date = DATE '2025-01-02' THEN 'AGAIN' ELSE city END AS city) FROM incidents_bronze
  WHERE situation_date <> DATE '2025-01-02' OR id % 3 = 0),
required AS (
  SELECT * FROM redelivered""")

BODIES_AGAIN = {
    "silver_redelivered": "SELECT * FROM incidents_silver",
    "marts_by_day": """SELECT 'state_stats' AS mart, state AS k1, NULL::VARCHAR AS k2, total_accidents, avg_severity,
          CAST(cities_count AS DOUBLE) AS figure FROM state_stats
        UNION ALL SELECT 'time_patterns', hour::VARCHAR, day_of_week::VARCHAR, total_accidents, avg_severity, NULL FROM time_patterns
        UNION ALL SELECT 'weather_analysis', weather_condition, NULL, total_accidents, avg_severity, avg_temperature
          FROM weather_analysis
        UNION ALL SELECT 'city_hotspots', state, city, total_accidents, avg_severity, round(lat + lng, 5)
          FROM (SELECT state, city, count(*) AS total_accidents, round(avg(severity), 6) AS avg_severity,
              avg(start_lat) AS lat, avg(start_lng) AS lng
            FROM incidents_silver GROUP BY state, city HAVING count(*) >= 50
            ORDER BY total_accidents DESC, state, city NULLS FIRST LIMIT 200)""",
}


def statements() -> dict[str, str]:
    again = {name: f"{AGAIN}\n{body}" for name, body in BODIES_AGAIN.items()}
    return {**{name: f"{VIEWS}\n{body}" for name, body in BODIES.items()}, **again}
