"""Domain views over the star-schema test tables.

The test tables carry no coordinates, so elements, incidents, weather and postcodes are
derived from them with integer arithmetic. The text is plain SQL that Spark and DuckDB
evaluate alike; ``{table}`` marks an input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def latitude(key: str) -> str:
    return f"53.34e0 + 0.12e0 * cast((({key}) * 7919) % 10007 as double) / 10007e0"


def longitude(key: str) -> str:
    return f"-2.21e0 + 0.17e0 * cast((({key}) * 104729) % 10009 as double) / 10009e0"


# Elements: one in ten is a line of 0 to 3 vertices (v0..v2), some with broken geometry text;
# (order, line) repeats across ingestions.
ASSETS = f"""
select id, ingestion_timestamp, source_seq,
  case when id % 10 = 1 then 'way' else 'node' end as type,
  case when id % 10 = 1 or id % 50 = 0 then null else vlat end as lat,
  case when id % 10 = 1 or id % 50 = 0 then null else vlon end as lon,
  kind as infrastructure_type,
  case when id % 3 = 0 then p_brand end as operator,
  case when id % 4 = 0 then p_name end as name,
  case when id % 5 = 0 then 'water' end as substance,
  case when id % 6 = 0 then 'steel' end as material,
  case when id % 8 = 0 then '150' end as diameter,
  case when id % 7 = 0 then 'underground' end as location,
  case when id % 10 <> 1 then null when id % 40 = 1 then 3 when id % 40 = 11 then 2
       when id % 40 = 21 then 1 else 0 end as vertices,
  case when id % 130 = 1 then 1 else 0 end as broken,
  vlat as v0lat, vlon as v0lon, vlat + 0.001e0 as v1lat, vlon + 0.0015e0 as v1lon,
  vlat + 0.0005e0 as v2lat, vlon + 0.0035e0 as v2lon
from (
  select l_orderkey * 7 + l_linenumber as id, cast(l_shipdate as timestamp) as ingestion_timestamp,
    l_partkey * 1000000 + l_suppkey as source_seq, p_brand, p_name,
    case p_type when 'ECONOMY' then 'pole' when 'STANDARD' then 'manhole' when 'LARGE' then 'pipeline'
      when 'SMALL' then 'cable' when 'MEDIUM' then 'power' else 'water' end as kind,
    {latitude('l_orderkey * 7 + l_linenumber')} as vlat,
    {longitude('l_orderkey * 7 + l_linenumber')} as vlon
  from {{lineitem}} join {{part}} on l_partkey = p_partkey
) as base
"""

# Incidents: text coordinates, some unusable; every third order is ingested again.
INCIDENTS = f"""
select o_orderkey as crime_id, run as source_seq, cast(o_orderdate as timestamp) as ingestion_timestamp,
  case when o_orderkey % 9 = 0 then null else concat('p', cast(o_orderkey as string)) end as persistent_id,
  case o_orderpriority when '1-URGENT' then 'violent-crime' when '2-HIGH' then 'burglary'
    when '3-MEDIUM' then 'vehicle-crime' when '5-LOW' then 'other-theft' else 'anti-social-behaviour' end as category,
  substring(cast(o_orderdate as string), 1, 7) as month,
  case when o_orderkey % 50 = 0 then null when o_orderkey % 97 = 0 then 'bad'
    else cast({latitude('o_orderkey * 13 + 5')} as string) end as lat,
  case when o_orderkey % 50 = 0 then null else cast({longitude('o_orderkey * 13 + 5')} as string) end as lon,
  o_orderkey % 1000 as street_id,
  case when o_orderkey % 11 = 0 then null else concat('Street ', cast(o_orderkey % 100 as string)) end as street_name,
  case when o_orderkey % 2 = 0 then 'Force' else 'BTP' end as location_type,
  case when o_orderstatus = 'P' then null else o_orderstatus end as outcome_category,
  case when o_orderstatus = 'P' then null when o_orderkey % 31 = 0 then 'unknown'
    else substring(cast(o_orderdate as string), 1, 7) end as outcome_date
from (
  select 0 as run, * from {{orders}}
  union all
  select 1 as run, * from {{orders}} where o_orderkey % 3 = 0
) as runs
"""

# Places: full postcodes and outward codes on whole metres, some without position.
PLACES = """
select concat('SK', lpad(cast(c_custkey as string), 8, '0')) as postcode,
  case when c_custkey % 5 = 0 then 'outward_code' else 'full_postcode' end as postcode_type,
  53.40e0 as lat, -2.15e0 as lon,
  case when c_custkey % 50 = 3 then null else 386000 + (c_custkey * 31 * 7919) % 11500 end as eastings,
  case when c_custkey % 50 = 3 then null else 382500 + (c_custkey * 31 * 104729) % 13500 end as northings,
  c_mktsegment as admin_district,
  case when c_custkey % 5 = 0 then null else n_name end as admin_ward,
  case when c_custkey % 4 = 0 then null else concat('Parish ', cast(c_custkey % 40 as string)) end as parish,
  case when c_custkey % 5 = 0 then null else 'North West' end as region,
  'England' as country,
  case when c_custkey % 5 = 0 then null else concat('C', cast(c_custkey % 10 as string)) end as parliamentary_constituency,
  0 as source_seq
from {customer} join {nation} on c_nationkey = n_nationkey
"""

# Weather: about six observations a day over eighty months at three locations.
WEATHER = """
select concat('L', cast(o_custkey % 3 as string)) as location_name, 'GB' as country,
  53.40e0 + cast(o_custkey % 3 as double) / 100e0 as lat, -2.15e0 as lon,
  cast(o_orderdate as timestamp) as datetime, 0 as timezone_offset,
  500 + o_orderkey % 5 as weather_id,
  case o_orderkey % 5 when 0 then 'Clear' when 1 then 'Clouds' when 2 then 'Rain' when 3 then 'Drizzle' else 'Snow' end
    as weather_main,
  cast(extract(month from o_orderdate) * 2 as double) + cast(o_orderkey % 13 as double) - 4e0 as temp_celsius,
  cast(extract(month from o_orderdate) * 2 as double) + cast(o_orderkey % 13 as double) - 5.5e0 as feels_like_celsius,
  cast(990 + o_orderkey % 40 as double) as pressure_hpa,
  cast(35 + (o_orderkey * 7) % 60 as double) as humidity_percent,
  cast(1000 * (o_orderkey % 11) as double) as visibility_meters,
  cast((o_orderkey * 3) % 23 as double) / 2e0 as wind_speed_ms,
  cast((o_orderkey * 37) % 360 as double) as wind_direction_deg,
  cast((o_orderkey * 11) % 101 as double) as clouds_percent,
  case when o_orderkey % 4 = 0 then cast(o_orderkey % 30 as double) / 10e0 end as rain_1h_mm,
  case when o_orderkey % 17 = 0 then cast(o_orderkey % 7 as double) / 10e0 end as snow_1h_mm,
  cast(o_orderdate as timestamp) as ingestion_timestamp, o_orderkey as source_seq
from {orders}
"""

VIEWS = {"assets_raw": ASSETS, "incidents_raw": INCIDENTS, "places_raw": PLACES, "weather_raw": WEATHER}

# Total order of ingestion in the views.
INGESTED = ("ingestion_timestamp", "source_seq")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    inputs = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **inputs)


def bronze_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with their geometry as JSON text."""
    points = [F.struct(F.col(f"v{i}lat").alias("lat"), F.col(f"v{i}lon").alias("lon")) for i in range(3)]
    drawn = F.slice(F.array(*points), F.lit(1), F.col("vertices"))
    located = (F.col("vertices") > 0) | (F.col("broken") == 1)
    return view(spark, sf_dir, "assets_raw").withColumns({
        "geometry_json": F.when(F.col("broken") == 1, '[{"lat": 53.4, "lon"').otherwise(F.to_json(drawn)),
        "first_lat": F.when(located, F.col("v0lat")), "first_lon": F.when(located, F.col("v0lon")),
    }).drop(*[f"v{i}{a}" for i in range(3) for a in ("lat", "lon")], "vertices", "broken")


def bronze_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "incidents_raw")


def bronze_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "places_raw")


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "weather_raw")
