import pytest
from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone.plans import correlation, postcode
from gridstone.operators import summarise

DENSITY = "grid_center_easting double, grid_center_northing double, infrastructure_type string, infrastructure_count long, avg_quality_score double, density_per_km2 double"
HOTSPOTS = "grid_center_easting double, grid_center_northing double, category string, crime_count long, density_per_km2 double, hotspot_level string"


@pytest.fixture(scope="module")
def grids(spark):
    infra = [(500.0, 500.0, "pole", 20, 0.2, 20.0), (500.0, 500.0, "cable", 10, 0.4, 10.0), (1500.0, 500.0, "pole", 3, 0.9, 3.0), (None, None, "pole", 4, 0.5, 4.0)]
    crime = [(250.0, 250.0, "a", 6, 24.0, "high"), (750.0, 250.0, "a", 1, 4.0, "low"), (2250.0, 250.0, "b", 2, 8.0, "low")]
    return spark.createDataFrame(infra, DENSITY), spark.createDataFrame(crime, HOTSPOTS)


def test_cells_meet_on_their_centres(grids):
    rows = {r.grid_cell_id: r for r in correlation.correlation(*grids).collect()}
    both = rows["grid_500.0_500.0"]
    assert (both.total_infrastructure_count, both.total_crime_count, both.infrastructure_types, both.crime_categories) == (30, 7, ["cable", "pole"], ["a"])
    assert both.risk_level == "high_risk" and both.max_hotspot_score == 1.0 and both.crime_density_1km == 7.0
    assert both.avg_quality_score == pytest.approx(0.3) and both.correlation_score == pytest.approx(0.3 * 0.56)
    assert both.correlation_level == "low" and both.infrastructure_vulnerability == pytest.approx(0.56 * 0.7)
    assert both.safety_index == pytest.approx(0.3 * 0.44) and both.infrastructure_diversity_score == 0.2
    alone = rows["grid_2500.0_500.0"]
    assert (alone.total_infrastructure_count, alone.infrastructure_types, alone.is_crime_hotspot, alone.infrastructure_vulnerability) == (0, None, False, 0.0)
    assert rows["grid_1500.0_500.0"].crime_categories is None and len(rows) == 4 and rows[None].total_infrastructure_count == 4


def test_corner_anchor_leaves_cells_one_sided(grids):
    rows = correlation.joined_cells(*grids, anchor="corner").collect()
    assert len(rows) == 5 and not any(r.total_infrastructure_count and r.total_crime_count for r in rows)


def test_zones_are_ranked_and_told_what_to_do(spark, grids):
    zones = correlation.high_risk_zones(correlation.correlation(*grids)).collect()
    assert [(z.priority_rank, z.grid_cell_id, z.recommended_action) for z in zones] == [(1, "grid_500.0_500.0", K.ACTION_URGENT)]


def test_reports_of_cells(grids):
    cells = correlation.correlation(*grids)
    assert sum(r.cells for r in correlation.level_distribution(cells, "risk_level").collect()) == 4
    row = correlation.coverage(cells).first()
    assert (row.total_cells, row.cells_with_infra, row.cells_with_crime, row.crime_percent) == (4, 3, 2, 50.0)


ASSETS = "postcode string, infrastructure_type string, metadata_quality_score double, quality_tier string, has_coordinates boolean, has_bng_coords boolean"


def test_infrastructure_summary(spark):
    rows = [("A", "power", 1.0, "high", True, True), ("A", "pole", 0.0, "basic", True, False), ("A", "pole", 0.5, "medium", False, False), (None, "power", 1.0, "high", True, True)]
    got = postcode.infrastructure_summary(spark.createDataFrame(rows, ASSETS)).collect()
    assert len(got) == 1
    a = got[0]
    assert (a.total_infrastructure_count, a.power_count, a.gas_count, a.infrastructure_type_count) == (3, 1, 0, 2)
    assert (a.high_quality_percent, a.coordinate_coverage_percent, a.with_bng_coords_count) == (33.3, 66.7, 1)
    assert a.infrastructure_diversity_score == pytest.approx(2 / 6)
    own = postcode.infrastructure_summary(spark.createDataFrame(rows, ASSETS), K.OBSERVED_TYPES).first()
    assert own.pole_count == 2


def test_crime_summary_patterns(spark):
    rows = [("A", "violent-crime", "x"), ("A", "burglary", None), ("A", "anti-social-behaviour", None), ("A", "bicycle-theft", "y")]
    df = spark.createDataFrame(rows, "postcode string, category string, outcome_category string")
    plain, feed = postcode.crime_summary(df).first(), postcode.crime_summary(df, K.INCIDENT_GROUPS_FEED).first()
    assert (plain.violence_count, plain.antisocial_count, plain.theft_count, plain.crime_severity_score) == (0, 0, 1, 0.75)
    assert (feed.violence_count, feed.antisocial_count, feed.crime_severity_score) == (1, 1, 1.75)
    assert plain.outcome_rate_percent == 50.0


def _profile(spark, crime_rows):
    places = spark.createDataFrame(
        [(p, "D", "W", None, None, None, None, 1, 1, 0.5) for p in ("A", "B", "C")],
        "postcode string, admin_district string, admin_ward string, parish string, constituency string, region string, country string, easting_bng long, northing_bng long, quality_score double",
    )
    infra = postcode.infrastructure_summary(spark.createDataFrame([("A", "power", 0.0, "basic", True, True)], ASSETS))
    crime = postcode.crime_summary(spark.createDataFrame(crime_rows, "postcode string, category string, outcome_category string"))
    return postcode.area_profile(places, infra, crime)


def test_area_profile(spark):
    profile = _profile(spark, [("A", "burglary", None)] * 4 + [("B", "burglary", None)] + [("Z", "burglary", None)] * 9)
    rows = {r.postcode: r for r in profile.collect()}
    assert (rows["A"].area_risk_score, rows["A"].risk_classification, rows["A"].safety_index) == (100.0, "high_risk", 0.0)
    assert (rows["B"].area_risk_score, rows["B"].risk_classification) == (12.5, "low_risk")
    assert (rows["C"].total_crime_count, rows["C"].area_risk_score, rows["C"].crime_categories) == (0, 0.0, None)
    assert [r.postcode for r in postcode.high_risk_postcodes(profile).collect()] == ["A"]
    cover = postcode.coverage(profile).first()
    assert (cover.total_postcodes, cover.with_crime, cover.infra_percent) == (3, 2, 33.3)
    assert postcode.top_districts(profile, "total_crime_count").first().total == 5
    assert {r.risk_classification: r.postcodes for r in postcode.risk_distribution(profile).collect()} == {"high_risk": 1, "low_risk": 1, "minimal_risk": 1}


def test_area_profile_without_any_crime(spark):
    assert {r.normalized_crime_risk for r in _profile(spark, []).collect()} == {0.0}


@pytest.mark.parametrize("n", [0, 1, 500])
def test_global_rank_equals_one_sorted_list(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 7).alias("v"))
    got = {r.id: r["rank"] for r in summarise.global_rank(df, [F.desc("v"), F.asc("id")]).collect()}
    order = sorted(range(n), key=lambda i: (-(i % 7), i))
    assert got == {i: k for k, i in enumerate(order, 1)}


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0] * 40 + [5.0, 9.0, 1.0], [float((i * 37) % 101) for i in range(300)]])
def test_quantiles_equal_pandas(spark, values):
    import pandas as pd

    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = summarise.describe(df, ["v"]).first()
    want = pd.Series(values).describe()
    assert (row.n, row.p25, row.p50, row.p75, row.max) == (want["count"], want["25%"], want["50%"], want["75%"], want["max"])


def test_gold_plans_have_the_shapes_of_their_tables(spark, small):
    from gridstone import schemas
    from gridstone.plans import correlation, density, hotspots, postcode, silver, weather
    from gridstone.workload import plans, views

    at = plans.RUN_TIME
    assets, incidents = plans.unplaced_assets(spark, small), plans.unplaced_incidents(spark, small)
    cells = correlation.correlation(density.infrastructure_density(assets), hotspots.crime_hotspots(incidents), run_time=at)
    placed = assets.withColumns({c: F.lit("x") for c in ("postcode", "admin_ward")}).withColumns({c: F.lit(True) for c in ("has_coordinates", "has_bng_coords")})
    made = {
        "infrastructure_density": density.infrastructure_density(assets, run_time=at), "crime_hotspots": hotspots.crime_hotspots(incidents, run_time=at),
        "weather_daily": weather.daily_stats(silver.silver_weather(views.bronze_weather(spark, small), at, order_by=views.INGESTED)),
        "spatial_correlation": cells, "high_risk_zones": correlation.high_risk_zones(cells),
        "postcode_profile": postcode.area_profile(silver.silver_places(views.bronze_places(spark, small), at), postcode.infrastructure_summary(placed),
                                                  postcode.crime_summary(incidents.withColumn("postcode", F.lit("x"))), at),
    }
    tables = {t.name: t for t in schemas.TABLES if t.layer == "gold"}
    assert set(made) == set(tables)
    for name, df in made.items():
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.struct(tables[name].schema).fields], name
        assert "COMMENT" in schemas.create_table_sql(tables[name]).split("USING")[0]
