from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import fixtures
from gridstone.functions import geo
from gridstone.operators import clean
from gridstone.plans import density, hotspots, silver, weather

RUN = datetime(2025, 11, 1)


def test_incidents(spark):
    rows = {r.crime_id: r for r in silver.silver_incidents(fixtures.incidents(spark), fixtures.postcodes(spark), RUN).collect()}
    assert len(rows) == 9
    assert {c for c, r in rows.items() if not r.is_valid_location} == {130539447, 130540161}
    assert {c: r.postcode for c, r in rows.items() if r.postcode} == {130825955: "SK1 1EB"}
    first = rows[130549789]
    assert first.month == date(2025, 8, 1) and first.outcome_date == date(2025, 8, 1) and first.has_outcome
    assert rows[130551342].outcome_date is None and not rows[130551342].has_outcome
    assert first.ingestion_timestamp == fixtures.RUNS[0] and first.source_system == "uk_police_api"


def test_assets(spark):
    rows = {r.id: r for r in silver.silver_assets(fixtures.elements(spark), fixtures.postcodes(spark), RUN).collect()}
    assert sorted(rows) == list(range(1, 10))
    assert rows[1].operator == "op" and rows[1].metadata_quality_score == 1.0 and rows[1].osm_id == 1
    assert [rows[i].metadata_quality_score for i in (2, 3, 4, 5)] == [0.75, 0.5, 0.25, 0.0]
    assert [rows[i].quality_tier for i in (1, 2, 3, 4, 5)] == ["high", "high", "medium", "medium", "basic"]
    assert rows[2].length_meters > 1000 and all(rows[i].length_meters is None for i in (1, 3, 4, 5, 6, 7))
    assert (rows[5].lat, rows[5].lon) == (53.36, -2.12) and (rows[7].lat, rows[7].lon) == (53.40, -2.15)
    assert rows[4].lat is None and rows[6].lat is None and not rows[6].has_coordinates and rows[6].easting_bng is None
    assert rows[8].is_valid_location and not rows[9].is_valid_location and not rows[6].is_valid_location
    assert rows[1].postcode == "SK1 1EB" and rows[6].postcode is None


def test_outward_codes_serve_when_there_are_no_full_postcodes(spark):
    outward = fixtures.postcodes(spark).where("postcode_type = 'outward_code'")
    assert [r.postcode for r in silver.reference_places(outward).collect()] == ["SK1"]
    assert {r.postcode for r in silver.reference_places(fixtures.postcodes(spark)).collect()} == {p[0] for p in fixtures.FULL_POSTCODES}


def test_reference_without_grid_coordinates_is_projected(spark):
    bare = fixtures.postcodes(spark).drop("eastings", "northings")
    rows = {r.postcode: r for r in silver.reference_places(bare).collect()}
    assert abs(rows["SK1 1EB"].eastings - 389590) <= 3


def test_weather(spark):
    rows = silver.silver_weather(fixtures.weather(spark), RUN)
    assert rows.count() == 3 and rows.where("has_complete_data").count() == 0  # no pressure in these rows
    days = {str(r.date): r for r in weather.daily_stats(rows).collect()}
    wet, fair = days["2025-10-26"], days["2025-10-28"]
    assert wet.avg_temperature == pytest.approx(6.225) and wet.temperature_range == pytest.approx(3.83)
    assert (wet.avg_humidity, wet.dominant_weather, wet.comfort_level) == (84.0, "Rain", "uncomfortable")
    assert (fair.avg_temperature, fair.dominant_weather, fair.comfort_level) == (12.25, "Clouds", "moderate")
    assert wet.total_rainfall_mm == 0.0
    months = weather.monthly_trends(weather.daily_stats(rows)).collect()
    assert [(m.year_month, m.month_name, m.season, m.total_days) for m in months] == [("2025-10", "October", "Autumn", 2)]
    assert silver.silver_weather(fixtures.weather(spark), RUN, keys=("weather_id",)).count() == 3


def test_weather_accepts_other_column_names(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 7.0, 1.5)], "timestamp string, temperature_celsius double, rain_1h_mm double")
    names = weather.SILVER_COLUMNS | {"time": "timestamp", "temperature": "temperature_celsius"}
    day = weather.daily_stats(df.withColumn("timestamp", F.to_timestamp("timestamp")), names).first()
    assert (day.avg_temperature, day.total_rainfall_mm, day.avg_humidity) == (7.0, 1.5, None)


def test_places(spark):
    rows = {r.postcode: r for r in silver.silver_places(fixtures.postcodes(spark), RUN).collect()}
    assert len(rows) == 6 and rows["SK1"].quality_score == 0.5 and rows["SK1 1EB"].quality_score == 1.0
    assert rows["SK1 1EB"].easting_bng == 389590


def test_cell_counts_add_up_and_nulls_stay_one_group(spark):
    assets = silver.silver_assets(fixtures.elements(spark), fixtures.postcodes(spark), RUN)
    cells = density.infrastructure_density(assets.withColumn("infrastructure_type", F.lit("pole")), run_time=RUN)
    rows = cells.collect()
    assert sum(r.infrastructure_count for r in rows) == 9
    assert [r.infrastructure_count for r in rows if r.grid_cell_id is None] == [2]
    assert all(r.analysis_date == RUN.date() for r in rows)


def test_hotspot_levels_follow_density(spark):
    df = spark.createDataFrame(
        [(100, 100, "a", date(2025, 1, 1))] * 5 + [(100, 100, "b", date(2025, 1, 1))] * 3 + [(100, 100, "c", date(2025, 1, 1)), (100, 100, "c", date(2025, 2, 1))],
        "easting_bng long, northing_bng long, category string, month date",
    )
    rows = {r.category: r for r in hotspots.crime_hotspots(df).collect()}
    assert {c: r.hotspot_level for c, r in rows.items()} == {"a": "high", "b": "medium", "c": "low"}
    assert rows["c"].months_with_crimes == 2 and rows["c"].density_per_km2 == 8.0


def test_dedup_is_idempotent_and_keeps_null_keys_once(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (5, 9), (5, 3)], "k int, ingestion_timestamp int")
    once = clean.keep_first(df, ["k"])
    assert sorted((r.k or 0, r.ingestion_timestamp) for r in once.collect()) == [(0, 1), (5, 3)]
    assert sorted(clean.keep_first(once, ["k"]).collect(), key=repr) == sorted(once.collect(), key=repr)


def test_nearest_step_keeps_every_row(spark):
    left = geo.with_bng(clean.numbers_from_text(fixtures.incidents(spark)))
    assert silver.nearest_join(left, silver.place_index(fixtures.postcodes(spark), 1000)).count() == 27
