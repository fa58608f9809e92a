import pytest
from pyspark.sql import functions as F

from sedimark.operators.summaries import Summary
from sedimark.plans import marts
from sedimark.sources.fixtures import incidents_silver

DATA = "/root/testdata"


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_each_mart_counts_every_record(spark, scale):
    silver = incidents_silver(spark, f"{DATA}/sf{scale}").persist()
    rows = silver.count()
    assert rows == {"0.001": 544, "0.01": 6712, "0.1": 66722}[scale]
    weighted = set()
    for mart in (marts.STATE_STATS, marts.TIME_PATTERNS, marts.WEATHER_ANALYSIS):
        made = mart.of(silver).agg(
            F.sum("total_accidents").alias("n"), F.sum(F.expr("total_accidents * avg_severity")).alias("s")
        ).first()
        assert made["n"] == rows
        weighted.add(round(made["s"] / rows, 9))
    assert len(weighted) == 1
    silver.unpersist()


def test_marts_do_not_depend_on_layout(spark, silver):
    for mart in (marts.STATE_STATS, marts.city_hotspots(min_rows=1), marts.grid_hotspots(min_rows=1)):
        found = [
            [tuple(r)[:3] for r in mart.of(silver.repartition(n)).collect()] for n in (1, 7)
        ]
        assert found[0] == found[1]


def test_hotspots_hold_their_promises(silver):
    rows = marts.grid_hotspots().of(silver).collect()
    assert 0 < len(rows) <= 50
    scores = [r["hotspot_score"] for r in rows]
    assert scores == sorted(scores, reverse=True)
    assert all(r["total_accidents"] >= 5 for r in rows)
    assert all(abs(r["hotspot_score"] - r["total_accidents"] * r["avg_severity"]) < 1e-9 for r in rows)


def test_cities_hold_their_promises(spark):
    rows = marts.city_hotspots().of(incidents_silver(spark, f"{DATA}/sf0.1")).collect()
    sizes = [r["total_accidents"] for r in rows]
    assert len(rows) == 150 and min(sizes) >= 50 and sizes == sorted(sizes, reverse=True)


def test_cells_round_half_away_from_zero(spark):
    schema = "start_lat double, start_lng double, severity int"
    places = spark.createDataFrame([(0.25, -80.25, 1), (0.15, -118.35, 1)], schema)
    cells = marts.grid_hotspots(min_rows=1).of(places).select("lat_grid", "lng_grid")
    assert sorted(map(tuple, cells.collect())) == [(0.2, -118.4), (0.3, -80.3)]


def test_rows_without_city_form_one_group_and_are_not_counted_as_city(spark):
    rows = spark.createDataFrame(
        [("A", None, 1), ("A", None, 2), ("A", "x", 3)], "state string, city string, severity int"
    ).withColumns({"start_lat": F.lit(1.0), "start_lng": F.lit(2.0)})
    assert marts.STATE_STATS.of(rows).first()["cities_count"] == 1
    assert {tuple(r)[:3] for r in marts.city_hotspots(min_rows=1).of(rows).collect()} == {("A", None, 2), ("A", "x", 1)}
    shared = marts.state_stats_from(marts.city_sums(rows)).first()
    assert tuple(shared) == ("A", 3, 2.0, 1)


def test_shared_sums_give_both_marts(silver):
    sums = marts.city_sums(silver)
    for shared, direct in (
        (marts.state_stats_from(sums), marts.STATE_STATS.of(silver)),
        (marts.city_hotspots_from(sums, min_rows=5), marts.city_hotspots(min_rows=5).of(silver)),
    ):
        assert shared.columns == direct.columns
        assert [t.dataType for t in shared.schema] == [t.dataType for t in direct.schema]
        for a, b in zip(shared.collect(), direct.collect(), strict=True):
            assert [round(x, 9) if isinstance(x, float) else x for x in a] == [
                round(x, 9) if isinstance(x, float) else x for x in b
            ]


def test_empty_marts(silver):
    nothing = silver.limit(0)
    assert marts.STATE_STATS.of(nothing).count() == 0
    row = marts.summary_row(marts.STATE_STATS.of(nothing), marts.city_hotspots().of(nothing)).first()
    assert tuple(row) == (None, 0, 0)


def test_top_rows_use_a_top_k(silver, plan):
    assert "TakeOrderedAndProject" in plan(marts.city_hotspots().of(silver))
    assert "TakeOrderedAndProject" in plan(marts.grid_hotspots().of(silver))


def test_marts_read_their_columns_only(spark, tmp_path, silver, plan):
    path = str(tmp_path / "silver")
    silver.write.parquet(path)
    text = plan(marts.WEATHER_ANALYSIS.of(spark.read.parquet(path)))
    assert "ReadSchema: struct<severity:int,temperature_f:double,weather_condition:string>" in text
    assert "PushedFilters: [IsNotNull(weather_condition)]" in text


def test_groups_are_combined_before_the_shuffle(silver, plan):
    text = plan(marts.TIME_PATTERNS.of(silver))
    assert "partial_count" in text and text.index("partial_count") > text.index("Exchange hashpartitioning")


def test_summary_row(silver):
    states, cities = marts.STATE_STATS.of(silver), marts.city_hotspots(min_rows=10).of(silver)
    assert tuple(marts.summary_row(states, cities).first()) == (544, states.count(), cities.count())


def test_summary_filters_before_and_after(spark):
    rows = spark.range(10).withColumn("k", F.col("id") % 3)
    made = Summary(keys={"k": "k"}, measures={"n": "count(*)"}, where="id > 0", having="n > 2", order=("k DESC",))
    assert [tuple(r) for r in made.of(rows).collect()] == [(2, 3), (1, 3), (0, 3)]


def test_equal_scores_are_settled_by_place(spark):
    """11 records with sum 15 and 5 with sum 15: count times average would differ in the last digit."""
    severities = [2] * 4 + [1] * 7
    rows = [(30.0, -100.0, s) for s in severities] + [(29.0, -100.0, 3)] * 5
    spots = marts.grid_hotspots(top=1).of(spark.createDataFrame(rows, "start_lat double, start_lng double, severity int"))
    assert [tuple(r) for r in spots.select("lat_grid", "hotspot_score").collect()] == [(29.0, 15.0)]
