"""Table schemas of the three layers as DDL text, which needs no session to be imported."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridstone.operators.clean import enforce_schema, with_missing_columns


def struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


_INGESTION = "ingestion_timestamp timestamp, ingestion_date date, source_api string, area string"
_AUDIT = "transformation_timestamp timestamp, transformation_date date, data_layer string, source_system string"

# --- Raw nested payloads ----------------------------------------------------------
RAW_ELEMENT = (
    "id bigint, type string, lat double, lon double, tags map<string,string>, nodes array<bigint>, "
    "geometry array<struct<lat:double,lon:double>>"
)
RAW_INCIDENT = (
    "id bigint, persistent_id string, category string, month string, location_type string, "
    "location_subtype string, context string, "
    "location struct<latitude:string,longitude:string,street:struct<id:bigint,name:string>>, "
    "outcome_status struct<category:string,date:string>"
)
RAW_WEATHER = (
    "name string, dt bigint, timezone int, visibility double, coord struct<lat:double,lon:double>, "
    "weather array<struct<id:int,main:string,description:string,icon:string>>, "
    "main struct<temp:double,feels_like:double,temp_min:double,temp_max:double,pressure:double,humidity:double>, "
    "wind struct<speed:double,deg:double,gust:double>, clouds struct<all:double>, "
    "sys struct<country:string,sunrise:bigint,sunset:bigint>, rain struct<`1h`:double>, snow struct<`1h`:double>"
)
RAW_OUTWARD = (
    "outcode string, latitude double, longitude double, eastings bigint, northings bigint, "
    "admin_district array<string>, admin_county array<string>, country array<string>, region string"
)
RAW_POSTCODE = (
    "postcode string, latitude double, longitude double, eastings bigint, northings bigint, "
    "admin_district string, admin_county string, admin_ward string, parish string, region string, "
    "country string, parliamentary_constituency string"
)
METADATA = ("ingestion_timestamp timestamp, source_api string, area string, ingestion_date date")


def envelope(payload_type: str) -> str:
    """Snapshot wrapper ``{raw_data, metadata}`` around a payload type."""
    return f"raw_data {payload_type}, metadata struct<{METADATA}>"


ELEMENT_SNAPSHOT = envelope(f"struct<elements:array<struct<{RAW_ELEMENT}>>>")
INCIDENT_SNAPSHOT = envelope(f"array<struct<{RAW_INCIDENT}>>")
WEATHER_SNAPSHOT = envelope(f"struct<{RAW_WEATHER}>")

# --- Bronze -----------------------------------------------------------------------
BRONZE_INFRASTRUCTURE = (
    "id bigint, type string, lat double, lon double, infrastructure_type string, substance string, "
    "location string, operator string, name string, diameter string, material string, all_tags string, "
    "node_count int, geometry_points int, first_lat double, first_lon double, last_lat double, "
    f"last_lon double, geometry_json string, {_INGESTION}"
)
BRONZE_CRIME = (
    "crime_id bigint, persistent_id string, category string, month string, lat string, lon string, "
    "street_id bigint, street_name string, location_type string, location_subtype string, "
    f"outcome_category string, outcome_date string, context string, {_INGESTION}"
)
BRONZE_WEATHER = (
    "location_name string, country string, lat double, lon double, datetime timestamp, timezone_offset int, "
    "weather_id int, weather_main string, weather_description string, weather_icon string, "
    "temp_celsius double, feels_like_celsius double, temp_min_celsius double, temp_max_celsius double, "
    "pressure_hpa double, humidity_percent double, visibility_meters double, wind_speed_ms double, "
    "wind_direction_deg double, wind_gust_ms double, clouds_percent double, rain_1h_mm double, "
    f"snow_1h_mm double, sunrise timestamp, sunset timestamp, {_INGESTION}"
)
BRONZE_POSTCODES = (
    "postcode string, postcode_type string, lat double, lon double, eastings bigint, northings bigint, "
    "admin_district string, admin_county string, admin_ward string, parish string, region string, "
    f"country string, parliamentary_constituency string, {_INGESTION}"
)

# --- Silver -----------------------------------------------------------------------
SILVER_INFRASTRUCTURE = (
    "id bigint, infrastructure_type string, type string, lat double, lon double, "
    "easting_bng bigint, northing_bng bigint, length_meters double, operator string, name string, "
    "substance string, material string, diameter string, location string, postcode string, "
    "admin_district string, admin_ward string, metadata_quality_score double, quality_tier string, "
    "has_coordinates boolean, has_bng_coords boolean, has_postcode boolean, has_admin_data boolean, "
    f"is_valid_location boolean, ingestion_timestamp timestamp, ingestion_date date, {_AUDIT}, area string, "
    "osm_id bigint"
)
SILVER_CRIME = (
    "crime_id bigint, persistent_id string, category string, month date, lat double, lon double, "
    "easting_bng bigint, northing_bng bigint, street_id bigint, street_name string, location_type string, "
    "location_subtype string, postcode string, admin_district string, admin_ward string, "
    "outcome_category string, outcome_date date, context string, has_coordinates boolean, "
    "has_bng_coords boolean, has_postcode boolean, has_outcome boolean, has_street boolean, "
    f"is_valid_location boolean, ingestion_timestamp timestamp, ingestion_date date, {_AUDIT}, area string"
)
SILVER_WEATHER = (
    "location_name string, country string, lat double, lon double, easting_bng bigint, northing_bng bigint, "
    "datetime timestamp, timezone_offset int, weather_id int, weather_main string, weather_description string, "
    "weather_icon string, temp_celsius double, feels_like_celsius double, temp_min_celsius double, "
    "temp_max_celsius double, pressure_hpa double, humidity_percent double, visibility_meters double, "
    "wind_speed_ms double, wind_direction_deg double, wind_gust_ms double, clouds_percent double, "
    "rain_1h_mm double, snow_1h_mm double, sunrise timestamp, sunset timestamp, has_complete_data boolean, "
    f"ingestion_timestamp timestamp, ingestion_date date, {_AUDIT}, area string"
)
SILVER_POSTCODES = (
    "postcode string, postcode_type string, lat double, lon double, easting_bng bigint, northing_bng bigint, "
    "admin_district string, admin_county string, admin_ward string, parish string, region string, "
    "country string, constituency string, has_coordinates boolean, quality_score double, "
    f"ingestion_timestamp timestamp, ingestion_date date, {_AUDIT}, area string"
)

# Gold tables as the plans write them.
_ANALYSIS = "analysis_date date, analysis_timestamp timestamp"
_CELL = "grid_cell_id string, grid_cell_x int, grid_cell_y int, grid_center_easting double, grid_center_northing double"
GOLD_INFRASTRUCTURE_DENSITY = (
    f"{_CELL}, infrastructure_type string, infrastructure_count bigint, avg_quality_score double, "
    f"quality_tiers array<string>, density_per_km2 double, {_ANALYSIS}"
)
GOLD_CRIME_HOTSPOTS = (
    f"{_CELL}, category string, crime_count bigint, crime_months array<date>, months_with_crimes int, "
    f"density_per_km2 double, hotspot_level string, {_ANALYSIS}"
)
GOLD_WEATHER_DAILY = (
    "date date, avg_temperature double, min_temperature double, max_temperature double, avg_feels_like double, "
    "avg_humidity double, min_humidity double, max_humidity double, avg_pressure double, min_pressure double, "
    "max_pressure double, avg_wind_speed double, max_wind_speed double, avg_wind_direction double, "
    "mean_wind_bearing double, avg_cloud_coverage double, avg_visibility double, total_rainfall_mm double, "
    "max_hourly_rainfall_mm double, total_snowfall_mm double, dominant_weather string, observation_count bigint, "
    "temperature_range double, comfort_level string"
)
GOLD_CORRELATION = (
    "grid_easting double, grid_northing double, total_infrastructure_count bigint, "
    "total_infrastructure_density double, infrastructure_types array<string>, avg_quality_score double, "
    "infrastructure_type_count int, infrastructure_diversity_score double, total_crime_count bigint, "
    "total_crime_density double, crime_categories array<string>, max_hotspot_score double, "
    "crime_density_1km double, crime_category_count int, is_crime_hotspot boolean, grid_cell_id string, "
    "normalized_infra_density double, normalized_crime_density double, correlation_score double, risk_level string, "
    f"infrastructure_vulnerability double, safety_index double, correlation_level string, {_ANALYSIS}"
)
GOLD_RISK_ZONES = (
    "grid_cell_id string, grid_easting double, grid_northing double, total_infrastructure_count bigint, "
    "infrastructure_types array<string>, infrastructure_type_count int, avg_quality_score double, "
    "total_crime_count bigint, crime_categories array<string>, crime_category_count int, max_hotspot_score double, "
    "correlation_score double, infrastructure_vulnerability double, safety_index double, priority_rank bigint, "
    "recommended_action string"
)
GOLD_POSTCODE_PROFILE = (
    "postcode string, admin_district string, admin_ward string, parish string, constituency string, region string, "
    "country string, easting_bng bigint, northing_bng bigint, postcode_quality_score double, "
    "total_infrastructure_count bigint, power_count bigint, communication_count bigint, water_count bigint, "
    "gas_count bigint, sewerage_count bigint, fuel_count bigint, avg_quality_score double, "
    "high_quality_count bigint, medium_quality_count bigint, basic_quality_count bigint, "
    "with_coordinates_count bigint, with_bng_coords_count bigint, infrastructure_types array<string>, "
    "infrastructure_type_count int, high_quality_percent double, coordinate_coverage_percent double, "
    "infrastructure_diversity_score double, total_crime_count bigint, violence_count bigint, burglary_count bigint, "
    "vehicle_crime_count bigint, theft_count bigint, drugs_count bigint, antisocial_count bigint, "
    "crimes_with_outcome bigint, crime_categories array<string>, crime_category_count int, "
    "outcome_rate_percent double, crime_severity_score double, normalized_crime_risk double, "
    "infrastructure_vulnerability_score double, area_risk_score double, risk_classification string, "
    f"safety_index double, {_ANALYSIS}"
)
#: Column comments, wherever a table has the column.
COMMENTS = {
    "lat": "WGS84 latitude", "lon": "WGS84 longitude", "easting_bng": "Grid easting in metres", "northing_bng": "Grid northing in metres",
    "ingestion_timestamp": "When the snapshot was taken", "ingestion_date": "Day of the snapshot", "is_valid_location": "Inside the area of interest",
    "metadata_quality_score": "Share of the metadata fields that are filled", "length_meters": "Length of a line",
    "grid_cell_id": "Grid cell, named by its lower left corner", "grid_center_easting": "Middle of the cell", "grid_center_northing": "Middle of the cell",
    "density_per_km2": "Count per square kilometre", "hotspot_level": "Crime density class", "correlation_score": "Infrastructure and crime densities combined",
    "infrastructure_vulnerability": "Crime weighed by poor infrastructure data", "safety_index": "100 less the risk", "area_risk_score": "Combined risk, 0 to 100",
    "priority_rank": "Most vulnerable first", "avg_wind_direction": "Mean of degrees", "mean_wind_bearing": "Circular mean in degrees", "analysis_date": "Day of the analysis",
}


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    schema: str
    partition_by: tuple[str, ...] = ()
    comment: str = ""


TABLES = (
    Table("bronze", "infrastructure", BRONZE_INFRASTRUCTURE, ("ingestion_date", "infrastructure_type"),
          "Raw infrastructure elements"),
    Table("bronze", "crime", BRONZE_CRIME, ("ingestion_date", "month"), "Raw street-level crime"),
    Table("bronze", "weather", BRONZE_WEATHER, ("ingestion_date",), "Raw weather snapshots"),
    Table("bronze", "postcodes", BRONZE_POSTCODES, ("ingestion_date", "postcode_type"), "Raw postcode reference"),
    Table("silver", "infrastructure", SILVER_INFRASTRUCTURE, ("ingestion_date", "infrastructure_type"),
          "Cleaned, projected and enriched infrastructure"),
    Table("silver", "crime", SILVER_CRIME, ("ingestion_date", "month"), "Cleaned and enriched crime"),
    Table("silver", "weather", SILVER_WEATHER, ("ingestion_date",), "Cleaned weather"),
    Table("silver", "postcodes", SILVER_POSTCODES, ("ingestion_date",), "Cleaned postcode reference"),
    Table("gold", "infrastructure_density", GOLD_INFRASTRUCTURE_DENSITY, ("analysis_date", "infrastructure_type"), "Elements per grid cell and type"),
    Table("gold", "crime_hotspots", GOLD_CRIME_HOTSPOTS, ("analysis_date", "category"), "Crimes per grid cell and category"),
    Table("gold", "weather_daily", GOLD_WEATHER_DAILY, (), "Weather by day"),
    Table("gold", "spatial_correlation", GOLD_CORRELATION, ("analysis_date",), "Infrastructure and crime per grid cell"),
    Table("gold", "high_risk_zones", GOLD_RISK_ZONES, (), "Cells of high risk, ranked, with the action to take"),
    Table("gold", "postcode_profile", GOLD_POSTCODE_PROFILE, ("analysis_date",), "Infrastructure, crime and risk by postcode"),
)
LAYERS = ("bronze", "silver", "gold")


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types; absent ones are null."""
    wanted = struct(schema)
    return enforce_schema(with_missing_columns(df, wanted), wanted).select(*wanted.fieldNames())


def create_table_sql(table: Table, prefix: str = "", fmt: str = "parquet") -> str:
    parts = f" PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{COMMENTS[f.name]}'" if f.name in COMMENTS else "")
        for f in struct(table.schema).fields
    )
    return (
        f"CREATE TABLE IF NOT EXISTS {prefix}{table.layer}.{table.name} ({columns}) USING {fmt}{parts} "
        f"COMMENT '{table.comment}'"
    )


def create_layers(spark: SparkSession, prefix: str = "", fmt: str = "parquet") -> None:
    """Create the schemas and empty tables that do not exist yet."""
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer}")
    for table in TABLES:
        spark.sql(create_table_sql(table, prefix, fmt))
