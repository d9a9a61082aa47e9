"""Queries for the silver and gold tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone.plans import correlation, density, hotspots, postcode, silver, weather
from gridstone.workload import oracle
from gridstone.workload.oracle import stable
from gridstone.workload.registry import flag, listed, query, six, text
from gridstone.workload.views import INGESTED, bronze_assets, bronze_incidents, bronze_places, bronze_weather

RUN_TIME = datetime(2025, 1, 1)


def assets_frame(spark, sf):
    return silver.silver_assets(bronze_assets(spark, sf), bronze_places(spark, sf), RUN_TIME, INGESTED)


def incidents_frame(spark, sf):
    return silver.silver_incidents(bronze_incidents(spark, sf), bronze_places(spark, sf), RUN_TIME, INGESTED)


def unplaced_assets(spark, sf):
    """Silver elements for gold tables that do not need the postcode."""
    from gridstone.functions import classify, geo
    from gridstone.operators import clean, quality

    points = geo.with_bng(silver.repaired_assets(clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True)))
    scored = points.withColumn("metadata_quality_score", quality.completeness_score(points, K.ASSET_METADATA_FIELDS))
    return scored.withColumn("quality_tier", classify.quality_tier(F.col("metadata_quality_score")))


def unplaced_incidents(spark, sf):
    from gridstone.functions import geo
    from gridstone.operators import clean

    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    return geo.with_bng(clean.parse_dates(clean.numbers_from_text(first), months=["month"]))


def density_frame(spark, sf):
    return density.infrastructure_density(unplaced_assets(spark, sf))


def hotspots_frame(spark, sf):
    return hotspots.crime_hotspots(unplaced_incidents(spark, sf))


def daily_frame(spark, sf):
    return weather.daily_stats(silver.silver_weather(bronze_weather(spark, sf), RUN_TIME, order_by=INGESTED))


def cells_frame(spark, sf):
    return correlation.correlation(density_frame(spark, sf), hotspots_frame(spark, sf))


def profile_frame(spark, sf):
    places = bronze_places(spark, sf)
    index = silver.place_index(places, max(K.ASSET_PLACE_RADIUS_M, K.INCIDENT_PLACE_RADIUS_M))  # one for both radii
    assets = silver.silver_assets(bronze_assets(spark, sf), index, RUN_TIME, INGESTED)
    incidents = silver.silver_incidents(bronze_incidents(spark, sf), index, RUN_TIME, INGESTED)
    return postcode.area_profile(silver.silver_places(places, RUN_TIME), postcode.infrastructure_summary(assets), postcode.crime_summary(incidents))


@query("silver_assets", f"select id, id as osm_id, type, infrastructure_type, {stable('lat')} as lat, {stable('lon')} as lon, easting_bng, northing_bng, round(length_meters + 1e-9, 3) as length_meters, "
       "operator, material, postcode, admin_district, admin_ward, metadata_quality_score, quality_tier, (postcode is not null)::int as has_postcode, is_valid_location::int as is_valid_location, "
       "name, substance, diameter, location, source_api, data_layer, (lat is not null and lon is not null)::int as has_coordinates, (easting_bng is not null and northing_bng is not null)::int as has_bng_coords, "
       "cast(ingestion_timestamp as varchar) as ingested from (select *, 'overpass_api' as source_api, 'silver' as data_layer from assets)")
def silver_assets(spark, sf):
    return assets_frame(spark, sf).select(
        "id", "osm_id", "type", "infrastructure_type", six("lat"), six("lon"), "easting_bng", "northing_bng",
        F.round(F.col("length_meters") + 1e-9, 3).alias("length_meters"), "operator", "material", "postcode", "admin_district", "admin_ward",
        "metadata_quality_score", "quality_tier", flag("has_postcode"), flag("is_valid_location"), "name", "substance", "diameter", "location",
        F.col("source_system").alias("source_api"), "data_layer", flag("has_coordinates"), flag("has_bng_coords"), text("ingestion_timestamp", "ingested"),
    )


@query("silver_incidents", f"select crime_id, category, cast(month as varchar) as month, {stable('lat')} as lat, {stable('lon')} as lon, easting_bng, northing_bng, postcode, admin_district, admin_ward, "
       "cast(outcome_date as varchar) as outcome_date, (outcome_category is not null)::int as has_outcome, (street_name is not null)::int as has_street, is_valid_location::int as is_valid_location from incidents")
def silver_incidents(spark, sf):
    return incidents_frame(spark, sf).select(
        "crime_id", "category", text("month"), six("lat"), six("lon"), "easting_bng", "northing_bng", "postcode", "admin_district", "admin_ward",
        text("outcome_date"), flag("has_outcome"), flag("has_street"), flag("is_valid_location"),
    )


_WEATHER_COLUMNS = ("country", "timezone_offset", "weather_main", "temp_celsius", "feels_like_celsius", "pressure_hpa", "humidity_percent", "visibility_meters", "wind_speed_ms",
                    "wind_direction_deg", "clouds_percent", "rain_1h_mm", "snow_1h_mm")


@query("silver_weather", f"select location_name, cast(datetime as varchar) as datetime, cast(ingestion_timestamp as varchar) as ingested, weather_id::int as weather_id, {', '.join(_WEATHER_COLUMNS)}, "
       f"{stable('lat')} as lat, {stable('lon')} as lon, cast(round_even(e, 0) as bigint) as easting_bng, cast(round_even(n, 0) as bigint) as northing_bng, 1 as has_complete_data, 'openweather_api' as source_system, 'silver' as data_layer "
       "from weather_first w join weather_first_bng g using (source_seq)", **oracle.projected("weather_first", "source_seq"))
def silver_weather(spark, sf):
    rows = silver.silver_weather(bronze_weather(spark, sf), RUN_TIME, order_by=INGESTED)
    return rows.select("location_name", text("datetime"), text("ingestion_timestamp", "ingested"), "weather_id", *_WEATHER_COLUMNS, six("lat"), six("lon"), "easting_bng", "northing_bng",
                       flag("has_complete_data"), "source_system", "data_layer")


@query("silver_places", f"select postcode, postcode_type, constituency, easting_bng, northing_bng, {stable('quality_score')} as quality_score from places")
def silver_places(spark, sf):
    rows = silver.silver_places(bronze_places(spark, sf), RUN_TIME)
    return rows.select("postcode", "postcode_type", "constituency", "easting_bng", "northing_bng", six("quality_score"))


@query("gold_infrastructure_density", f"select grid_cell_id, grid_center_easting, grid_center_northing, infrastructure_type, infrastructure_count, {stable('avg_quality_score')} as avg_quality_score, quality_tiers, density_per_km2 from density")
def gold_density(spark, sf):
    return density_frame(spark, sf).select("grid_cell_id", "grid_center_easting", "grid_center_northing", "infrastructure_type", "infrastructure_count",
                                           six("avg_quality_score"), listed("quality_tiers"), "density_per_km2")


@query("gold_infrastructure_stats", "select infrastructure_type, count(*) as total_count, count(distinct (easting_bng // 1000) * 100000 + northing_bng // 1000) as grid_cells_covered, "
       f"{stable('avg(metadata_quality_score)')} as avg_quality, count(*) filter (quality_tier = 'high') as high_quality_count, count(*) filter (quality_tier = 'medium') as medium_quality_count, "
       "count(*) filter (quality_tier = 'basic') as basic_quality_count from assets group by 1")
def gold_stats(spark, sf):
    stats = density.infrastructure_stats(unplaced_assets(spark, sf))
    return stats.withColumn("avg_quality", six("avg_quality"))


@query("gold_crime_hotspots", "select grid_cell_id, grid_center_easting, grid_center_northing, category, crime_count, months_with_crimes::int as months_with_crimes, crime_months, density_per_km2, hotspot_level from hotspots")
def gold_hotspots(spark, sf):
    return hotspots_frame(spark, sf).select("grid_cell_id", "grid_center_easting", "grid_center_northing", "category", "crime_count", "months_with_crimes",
                                            listed("crime_months"), "density_per_km2", "hotspot_level")


@query("gold_crime_stats", "select category, count(*) as total_crimes, count(distinct (easting_bng // 500) * 100000 + northing_bng // 500) as grid_cells_affected, "
       "count(distinct month) as months_observed, count(distinct postcode) as postcodes_affected from incidents group by 1")
def gold_crime_stats(spark, sf):
    return hotspots.crime_stats(incidents_frame(spark, sf))


_DAILY = ("avg_temperature", "min_temperature", "max_temperature", "avg_feels_like", "avg_humidity", "min_humidity", "max_humidity", "avg_pressure", "min_pressure",
          "max_pressure", "avg_wind_speed", "max_wind_speed", "avg_wind_direction", "avg_cloud_coverage", "avg_visibility", "total_rainfall_mm",
          "max_hourly_rainfall_mm", "total_snowfall_mm", "temperature_range")


@query("gold_weather_daily", "select cast(date as varchar) as date, dominant_weather, observation_count, comfort_level, " + ", ".join(f"{stable(c)} as {c}" for c in _DAILY) + " from daily")
def gold_daily(spark, sf):
    return daily_frame(spark, sf).select(text("date"), "dominant_weather", "observation_count", "comfort_level", *[six(c) for c in _DAILY])


_MONTHLY = ("avg_temperature", "avg_min_temperature", "avg_max_temperature", "avg_temperature_range", "extreme_min_temperature", "extreme_max_temperature", "avg_humidity",
            "avg_pressure", "avg_wind_speed", "max_wind_speed", "total_rainfall_mm", "total_snowfall_mm", "avg_daily_rainfall_mm", "avg_cloud_coverage", "avg_visibility")
_MONTHLY_KEPT = ("year", "month", "year_month", "month_name", "season", "rainy_days", "snowy_days", "comfortable_days", "uncomfortable_days", "extreme_days", "total_days",
                 "rainy_days_percent", "comfortable_days_percent")


@query("gold_weather_monthly", "select " + ", ".join(_MONTHLY_KEPT) + ", " + ", ".join(f"{stable(c)} as {c}" for c in _MONTHLY) + " from monthly")
def gold_monthly(spark, sf):
    return weather.monthly_trends(daily_frame(spark, sf)).select(*_MONTHLY_KEPT, *[six(c) for c in _MONTHLY])


@query("gold_correlation", "select grid_cell_id, grid_easting, grid_northing, total_infrastructure_count::bigint as total_infrastructure_count, infrastructure_types, total_crime_count::bigint as total_crime_count, crime_categories, "
       f"max_hotspot_score, correlation_level, risk_level, total_crime_count::double as crime_density_1km, {stable('correlation_score')} as correlation_score, {stable('infrastructure_vulnerability')} as infrastructure_vulnerability, {stable('safety_index')} as safety_index from cells")
def gold_correlation(spark, sf):
    return cells_frame(spark, sf).select("grid_cell_id", "grid_easting", "grid_northing", "total_infrastructure_count", listed("infrastructure_types"), "total_crime_count",
                                         listed("crime_categories"), "max_hotspot_score", "correlation_level", "risk_level", "crime_density_1km",
                                         six("correlation_score"), six("infrastructure_vulnerability"), six("safety_index"))


@query("gold_correlation_corner", "select 'cells' as what, (select count(*) from infra_cells) + (select count(*) from crime_cells) as n, 0 as both_sided")
def gold_correlation_corner(spark, sf):
    """With the corner anchor the two grids never meet."""
    cells = correlation.joined_cells(density_frame(spark, sf), hotspots_frame(spark, sf), anchor="corner")
    return cells.agg(F.lit("cells").alias("what"), F.count("*").alias("n"),
                     F.count_if((F.col("total_crime_count") > 0) & (F.col("total_infrastructure_count") > 0)).cast("int").alias("both_sided"))


@query("gold_high_risk_zones", "select grid_cell_id, row_number() over (order by infrastructure_vulnerability desc, grid_cell_id) as priority_rank, "
       "total_infrastructure_count::bigint as total_infrastructure_count, total_crime_count::bigint as total_crime_count, "
       f"case when avg_quality_score < 0.5 and max_hotspot_score >= 1 then '{K.ACTION_URGENT}' when avg_quality_score < 0.5 then '{K.ACTION_QUALITY}' when max_hotspot_score >= 1 then '{K.ACTION_SECURITY}' "
       f"else '{K.ACTION_ROUTINE}' end as recommended_action, {stable('infrastructure_vulnerability')} as infrastructure_vulnerability from cells where risk_level = 'high_risk'")
def gold_zones(spark, sf):
    zones = correlation.high_risk_zones(cells_frame(spark, sf))
    return zones.select("grid_cell_id", "priority_rank", "total_infrastructure_count", "total_crime_count", "recommended_action", six("infrastructure_vulnerability"))


_INFRA_KEPT = ("postcode", "total_infrastructure_count", "power_count", "communication_count", "water_count", "gas_count", "sewerage_count", "fuel_count",
               "high_quality_count", "medium_quality_count", "basic_quality_count", "with_coordinates_count", "with_bng_coords_count", "high_quality_percent", "coordinate_coverage_percent")


@query("gold_postcode_infrastructure", "select " + ", ".join(_INFRA_KEPT) + f", infrastructure_types, infrastructure_type_count::int as infrastructure_type_count, {stable('avg_quality_score')} as avg_quality_score, "
       f"{stable('infrastructure_diversity_score')} as infrastructure_diversity_score from postcode_infra")
def gold_postcode_infrastructure(spark, sf):
    return postcode.infrastructure_summary(assets_frame(spark, sf)).select(
        *_INFRA_KEPT, listed("infrastructure_types"), "infrastructure_type_count", six("avg_quality_score"), six("infrastructure_diversity_score"))


_CRIME_KEPT = ("postcode", "total_crime_count", "violence_count", "burglary_count", "vehicle_crime_count", "theft_count", "drugs_count", "antisocial_count", "crimes_with_outcome", "outcome_rate_percent")


@query("gold_postcode_crime", "select " + ", ".join(_CRIME_KEPT) + f", crime_categories, crime_category_count::int as crime_category_count, {stable('crime_severity_score')} as crime_severity_score from postcode_crime")
def gold_postcode_crime(spark, sf):
    return postcode.crime_summary(incidents_frame(spark, sf)).select(*_CRIME_KEPT, listed("crime_categories"), "crime_category_count", six("crime_severity_score"))


@query("gold_postcode_crime_feed", "select postcode, count(*) as total_crime_count, count(*) filter (category = 'violent-crime') as violence_count, count(*) filter (category = 'anti-social-behaviour') as antisocial_count, "
       f"{stable('sum(case category when ' + chr(39) + 'violent-crime' + chr(39) + ' then 3 when ' + chr(39) + 'burglary' + chr(39) + ' then 2 when ' + chr(39) + 'vehicle-crime' + chr(39) + ' then 2 else 1 end) / count(*)::double')} as crime_severity_score "
       "from incidents where postcode is not null group by 1")
def gold_postcode_crime_feed(spark, sf):
    """The category substrings the feed really uses."""
    summary = postcode.crime_summary(incidents_frame(spark, sf), K.INCIDENT_GROUPS_FEED)
    return summary.select("postcode", "total_crime_count", "violence_count", "antisocial_count", six("crime_severity_score"))


@query("gold_postcode_profile", "select postcode, admin_district, admin_ward, total_infrastructure_count, infrastructure_type_count::int as infrastructure_type_count, total_crime_count, "
       f"risk_classification, area_risk_score, {stable('safety_index')} as safety_index, {stable('normalized_crime_risk')} as normalized_crime_risk, {stable('infrastructure_vulnerability_score')} as infrastructure_vulnerability_score, "
       f"{stable('crime_severity_score')} as crime_severity_score, water_count, burglary_count, {stable('postcode_quality_score')} as postcode_quality_score from profile")
def gold_profile(spark, sf):
    return profile_frame(spark, sf).select(
        "postcode", "admin_district", "admin_ward", "total_infrastructure_count", "infrastructure_type_count", "total_crime_count", "risk_classification", "area_risk_score",
        six("safety_index"), six("normalized_crime_risk"), six("infrastructure_vulnerability_score"), six("crime_severity_score"), "water_count", "burglary_count", six("postcode_quality_score"))


@query("report_high_risk_postcodes", f"select postcode, admin_district, total_crime_count, area_risk_score, {stable('safety_index')} as safety_index from profile where risk_classification = 'high_risk' order by area_risk_score desc, postcode limit 20")
def report_high_risk(spark, sf):
    return postcode.high_risk_postcodes(profile_frame(spark, sf)).select("postcode", "admin_district", "total_crime_count", "area_risk_score", six("safety_index"))


@query("report_postcode_coverage", "select count(*) as total_postcodes, count(*) filter (total_infrastructure_count > 0) as with_infrastructure, count(*) filter (total_crime_count > 0) as with_crime, "
       f"round(count(*) filter (total_infrastructure_count > 0) * 1.0::double / count(*) * 100, 1) as infra_percent, {stable('avg(total_infrastructure_count)')} as avg_infra, {stable('avg(area_risk_score)')} as avg_risk, {stable('avg(safety_index)')} as avg_safety from profile")
def report_coverage(spark, sf):
    return postcode.coverage(profile_frame(spark, sf)).select("total_postcodes", "with_infrastructure", "with_crime", "infra_percent", six("avg_infra"), six("avg_risk"), six("avg_safety"))


@query("report_top_districts", "select admin_district, sum(total_crime_count)::bigint as total, count(*) as postcodes from profile group by 1 order by 2 desc, 1 limit 5")
def report_districts(spark, sf):
    return postcode.top_districts(profile_frame(spark, sf), "total_crime_count")


@query("report_zone_levels", "select 'correlation' as what, correlation_level as level, count(*) as cells from cells group by 2 union all select 'risk', risk_level, count(*) from cells group by 2")
def report_levels(spark, sf):
    return correlation.level_report(cells_frame(spark, sf))


@query("report_zone_coverage", "select count(*) as total_cells, count(*) filter (total_infrastructure_count > 0) as cells_with_infra, count(*) filter (total_crime_count > 0) as cells_with_crime, "
       "round(count(*) filter (total_crime_count > 0) * 1.0::double / count(*) * 100, 1) as crime_percent, count(*) filter (risk_level = 'high_risk') as high_risk_cells from cells")
def report_zone_coverage(spark, sf):
    return correlation.coverage(cells_frame(spark, sf)).select("total_cells", "cells_with_infra", "cells_with_crime", "crime_percent", "high_risk_cells")


@query("report_weather_overall", f"select cast(min(date) as varchar) as earliest_date, cast(max(date) as varchar) as latest_date, {stable('avg(avg_temperature)')} as overall_avg_temp, min(min_temperature) as record_low_temp, "
       f"max(max_temperature) as record_high_temp, {stable('sum(total_rainfall_mm)')} as total_rainfall, {stable('avg(total_rainfall_mm)')} as avg_daily_rainfall from daily")
def report_weather(spark, sf):
    return weather.overall_summary(daily_frame(spark, sf)).select(text("earliest_date"), text("latest_date"), six("overall_avg_temp"), "record_low_temp", "record_high_temp", six("total_rainfall"), six("avg_daily_rainfall"))


@query("gold_weather_bearing", f"select cast(date as varchar) as date, {stable('degrees(bearing) + case when bearing < 0 then 360 else 0 end')} as mean_wind_bearing from daily")
def gold_bearing(spark, sf):
    return daily_frame(spark, sf).select(text("date"), six("mean_wind_bearing"))
