"""Nested feed records to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstone.functions import scalars

ELEMENT_TAGS = ("substance", "location", "operator", "name", "diameter", "material")


def unwrap(snapshots: DataFrame, records: str) -> DataFrame:
    """Rows of a snapshot envelope: one per record under ``raw_data``, metadata alongside.

    ``records`` is the path of the record array, such as ``raw_data.elements``; a path to a
    single record works too."""
    if snapshots.select(records).schema[0].dataType.typeName() == "array":
        return snapshots.select(F.explode(records).alias("r"), "metadata").select("r.*", "metadata.*")
    return snapshots.select(f"{records}.*", "metadata.*")


def _extra(df: DataFrame, used: set[str]) -> list[Column]:
    """Ingestion columns travel through flattening untouched."""
    return [F.col(c) for c in df.columns if c not in used and c in
            ("ingestion_timestamp", "ingestion_date", "source_api", "area", "osm_timestamp", "source_seq")]


def flatten_elements(elements: DataFrame) -> DataFrame:
    tags, geometry = F.col("tags"), F.col("geometry")
    is_way = F.col("type") == "way"
    drawn = is_way & (F.size(geometry) > 0)
    first, last = F.get(geometry, F.lit(0)), F.try_element_at(geometry, F.lit(-1))
    kind = F.coalesce(*[scalars.blank_to_null(tags[k]) for k in ("man_made", "power")], F.lit("unknown"))
    return elements.select(
        "id", "type", "lat", "lon",
        kind.alias("infrastructure_type"),
        *[tags[t].alias(t) for t in ELEMENT_TAGS],
        F.to_json(F.coalesce(tags, F.create_map().cast("map<string,string>"))).alias("all_tags"),
        F.when(is_way, F.coalesce(F.size("nodes"), F.lit(0))).alias("node_count"),
        F.when(is_way, F.coalesce(F.size(geometry), F.lit(0))).alias("geometry_points"),
        F.when(drawn, first["lat"]).alias("first_lat"), F.when(drawn, first["lon"]).alias("first_lon"),
        F.when(drawn, last["lat"]).alias("last_lat"), F.when(drawn, last["lon"]).alias("last_lon"),
        F.when(drawn, F.to_json(geometry)).alias("geometry_json"),
        *_extra(elements, set()),
    )


def flatten_incidents(incidents: DataFrame) -> DataFrame:
    return incidents.select(
        F.col("id").alias("crime_id"), "persistent_id", "category", "month",
        F.col("location.latitude").alias("lat"), F.col("location.longitude").alias("lon"),
        F.col("location.street.id").alias("street_id"), F.col("location.street.name").alias("street_name"),
        "location_type", "location_subtype",
        F.col("outcome_status.category").alias("outcome_category"),
        F.col("outcome_status.date").alias("outcome_date"),
        "context", *_extra(incidents, set()),
    )


def flatten_weather(snapshots: DataFrame) -> DataFrame:
    """The first listed condition describes the snapshot; times are epoch seconds (UTC).
    One-hour rain and snow are read too, because the trend tables add them up."""
    condition = F.get("weather", F.lit(0))
    return snapshots.select(
        F.col("name").alias("location_name"), F.col("sys.country").alias("country"),
        F.col("coord.lat").alias("lat"), F.col("coord.lon").alias("lon"),
        scalars.epoch_time(F.col("dt")).alias("datetime"), F.col("timezone").alias("timezone_offset"),
        condition["id"].alias("weather_id"), condition["main"].alias("weather_main"),
        condition["description"].alias("weather_description"), condition["icon"].alias("weather_icon"),
        F.col("main.temp").alias("temp_celsius"), F.col("main.feels_like").alias("feels_like_celsius"),
        F.col("main.temp_min").alias("temp_min_celsius"), F.col("main.temp_max").alias("temp_max_celsius"),
        F.col("main.pressure").alias("pressure_hpa"), F.col("main.humidity").alias("humidity_percent"),
        F.col("visibility").alias("visibility_meters"),
        F.col("wind.speed").alias("wind_speed_ms"), F.col("wind.deg").alias("wind_direction_deg"),
        F.col("wind.gust").alias("wind_gust_ms"), F.col("clouds.all").alias("clouds_percent"),
        F.col("rain.1h").alias("rain_1h_mm"), F.col("snow.1h").alias("snow_1h_mm"),
        scalars.epoch_time(F.col("sys.sunrise")).alias("sunrise"),
        scalars.epoch_time(F.col("sys.sunset")).alias("sunset"),
        *_extra(snapshots, set()),
    )


def flatten_places(outward: DataFrame | None, full: DataFrame | None) -> DataFrame:
    """Outward-code and full-postcode records in one shape."""
    parts = []
    shared = [F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("eastings"), F.col("northings")]
    if outward is not None:
        none = F.lit(None).cast("string")
        parts.append(outward.select(
            F.col("outcode").alias("postcode"), F.lit("outward_code").alias("postcode_type"), *shared,
            *[F.get(c, F.lit(0)).alias(c) for c in ("admin_district", "admin_county")],
            none.alias("admin_ward"), none.alias("parish"), F.col("region"),
            F.get("country", F.lit(0)).alias("country"), none.alias("parliamentary_constituency"),
            *_extra(outward, set()),
        ))
    if full is not None:
        parts.append(full.select(
            F.col("postcode"), F.lit("full_postcode").alias("postcode_type"), *shared,
            "admin_district", "admin_county", "admin_ward", "parish", "region", "country",
            "parliamentary_constituency", *_extra(full, set()),
        ))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged
