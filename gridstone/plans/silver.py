"""Bronze to silver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone import schemas
from gridstone.functions import classify, geo
from gridstone.operators import clean, filters, quality
from gridstone.operators.nearest import NearestIndex, build_index, nearest_join

ORDER = ("ingestion_timestamp",)


def reference_places(places: DataFrame, order_by: Sequence[str | Column] = ORDER) -> DataFrame:
    """Reference points for enrichment: full postcodes, or outward codes when there are none,
    once each, projected when the feed has no grid coordinates."""
    chosen = filters.prefer(places, "postcode_type", ("full_postcode", "outward_code"))
    unique = clean.keep_first(chosen, ["postcode"], order_by)
    if "eastings" not in unique.columns:
        unique = geo.with_bng(unique, easting="eastings", northing="northings")
    return unique


def place_index(places: DataFrame, max_distance: float, order_by: Sequence[str | Column] = ORDER) -> NearestIndex:
    return build_index(reference_places(places, order_by), max_distance=max_distance)


def repaired_assets(bronze: DataFrame) -> DataFrame:
    """Coordinates filled from the geometry, and the length of lines."""
    geometry, point = F.col("__geom"), F.col("__point")
    drawn = bronze.withColumn("__geom", geo.parse_geometry(F.col("geometry_json")))
    fixed = geo.repair_point(F.col("lat"), F.col("lon"), geometry, F.col("first_lat"), F.col("first_lon"))
    return (
        drawn.withColumn("__point", fixed)
        .withColumns({
            "lat": point["lat"], "lon": point["lon"],
            "length_meters": F.when(F.col("type") == "way", geo.line_length(geometry)),
        })
        .drop("__geom", "__point")
    )


def silver_assets(bronze: DataFrame, places: DataFrame | NearestIndex, run_time: datetime | None = None,
                  order_by: Sequence[str | Column] = ORDER, max_distance: float = K.ASSET_PLACE_RADIUS_M,
                  bbox: dict = K.BBOX) -> DataFrame:
    """Repair, measure, project, locate, score and flag elements; one row per id.

    Every step is a function of its own row, so re-ingested copies are dropped first and
    the expensive steps see each element once."""
    index = places if isinstance(places, NearestIndex) else place_index(places, max_distance)
    df = repaired_assets(clean.keep_first(bronze, ["id"], order_by))
    df = filters.flag_inside(geo.with_bng(df), bbox)
    df = nearest_join(df, index, max_distance=max_distance)
    df = df.withColumn("metadata_quality_score", quality.completeness_score(df, K.ASSET_METADATA_FIELDS))
    df = df.withColumn("quality_tier", classify.quality_tier(F.col("metadata_quality_score")))
    df = clean.with_audit(quality.with_flags(df), "overpass_api", "silver", run_time)
    return _finish(df, schemas.SILVER_INFRASTRUCTURE, {"osm_id": "id"})


def load_assets(bronze: DataFrame, places: DataFrame | NearestIndex, path: str, run_time: datetime | None = None,
                order_by: Sequence[str | Column] = ORDER, max_distance: float = K.ASSET_PLACE_RADIUS_M) -> DataFrame:
    """Writes the silver elements and gives the figures of :func:`quality.asset_reconciliation`, observed
    along the way: what came in where bronze is read, what goes out where silver is written. Nothing is
    scanned for the figures."""
    incoming, outgoing = Observation(), Observation()
    seen = bronze.observe(incoming, *[c.alias(n) for n, c in quality.incoming_counts().items()])
    silver = silver_assets(seen, places, run_time, order_by, max_distance)
    silver.observe(outgoing, *[c.alias(n) for n, c in quality.outgoing_counts().items()]).write.mode("overwrite").parquet(path)
    figures = {**incoming.get, **outgoing.get}
    names = [*quality.incoming_counts(), *quality.outgoing_counts()]
    return bronze.sparkSession.createDataFrame([(n, figures.get(n, 0)) for n in names], "metric string, value long")


def silver_incidents(bronze: DataFrame, places: DataFrame | NearestIndex, run_time: datetime | None = None,
                     order_by: Sequence[str | Column] = ORDER, max_distance: float = K.INCIDENT_PLACE_RADIUS_M,
                     bbox: dict = K.BBOX) -> DataFrame:
    """Type, project, locate and flag incidents; one row per crime id."""
    index = places if isinstance(places, NearestIndex) else place_index(places, max_distance)
    df = clean.numbers_from_text(clean.keep_first(bronze, ["crime_id"], order_by))
    df = clean.parse_dates(df, months=["month"], days=["outcome_date"])
    df = filters.flag_inside(geo.with_bng(df), bbox)
    df = quality.with_incident_flags(quality.with_flags(nearest_join(df, index, max_distance=max_distance)))
    df = clean.with_audit(df, "uk_police_api", "silver", run_time)
    return _finish(df, schemas.SILVER_CRIME)


def silver_weather(bronze: DataFrame, run_time: datetime | None = None,
                   keys: Sequence[str] = ("location_name", "datetime"),
                   order_by: Sequence[str | Column] = ORDER) -> DataFrame:
    """Project weather snapshots, one per place and time. ``keys=('weather_id',)`` keeps one
    per condition code instead."""
    typed = clean.parse_dates(bronze, times=["datetime"]) if dict(bronze.dtypes)["datetime"] == "string" else bronze
    df = geo.with_bng(clean.keep_first(typed, keys, order_by))
    measured = ("temp_celsius", "humidity_percent", "pressure_hpa", "wind_speed_ms", "weather_main")
    complete = F.lit(True)
    for c in measured:
        complete = complete & (F.col(c).isNotNull() if c in df.columns else F.lit(False))
    df = df.withColumn("has_complete_data", complete)
    return _finish(clean.with_audit(df, "openweather_api", "silver", run_time), schemas.SILVER_WEATHER)


def silver_places(bronze: DataFrame, run_time: datetime | None = None,
                  order_by: Sequence[str | Column] = ORDER) -> DataFrame:
    """Postcode reference: one row per code, grid coordinates, completeness of its admin fields."""
    df = clean.keep_first(bronze, ["postcode"], order_by)
    df = df.withColumns({
        "quality_score": quality.completeness_score(df, K.PLACE_ADMIN_FIELDS),
        "has_coordinates": F.col("lat").isNotNull() & F.col("lon").isNotNull(),
    }).withColumnsRenamed({
        "parliamentary_constituency": "constituency", "eastings": "easting_bng", "northings": "northing_bng",
    })
    return _finish(clean.with_audit(df, "postcodes_io", "silver", run_time), schemas.SILVER_POSTCODES)


def _finish(df: DataFrame, schema: str, aliases: dict[str, str] | None = None) -> DataFrame:
    wanted = schemas.struct(schema)
    kept = clean.keep_existing(df, [c for c in wanted.fieldNames() if c not in (aliases or {})], aliases)
    return clean.enforce_schema(kept, wanted)
