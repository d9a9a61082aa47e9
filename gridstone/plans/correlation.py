"""Infrastructure and crime on a common 1 km grid."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone.functions import classify, geo, scalars
from gridstone.operators.clean import with_analysis_time
from gridstone.operators.summarise import global_rank, value_counts, value_set

JOIN_KEYS = ["grid_easting", "grid_northing"]

# Values for cells only one side knows; the type and category sets stay null.
FILL = {
    "total_infrastructure_count": 0, "total_infrastructure_density": 0.0, "infrastructure_type_count": 0,
    "infrastructure_diversity_score": 0.0, "avg_quality_score": 0.0, "total_crime_count": 0,
    "total_crime_density": 0.0, "crime_density_1km": 0.0, "crime_category_count": 0,
    "max_hotspot_score": 0.0, "is_crime_hotspot": False,
}


def crime_per_cell(hotspots: DataFrame, size: int = K.ASSET_CELL_M, anchor: str = "center") -> DataFrame:
    """Hotspot cells summed into the coarser grid. ``total_crime_density`` adds up the
    densities of the finer cells; ``crime_density_1km`` relates the count to the coarse cell."""
    keyed = hotspots.select(
        geo.regrid(F.col("grid_center_easting"), size, anchor).cast("double").alias("grid_easting"),
        geo.regrid(F.col("grid_center_northing"), size, anchor).cast("double").alias("grid_northing"),
        "crime_count", "density_per_km2", "category", "hotspot_level",
    )
    return keyed.groupBy(*JOIN_KEYS).agg(
        F.sum("crime_count").alias("total_crime_count"),
        F.sum("density_per_km2").alias("total_crime_density"),
        value_set("category").alias("crime_categories"),
        F.max(classify.hotspot_score(F.col("hotspot_level"))).alias("max_hotspot_score"),
    ).withColumns({
        "crime_density_1km": geo.density_per_km2(F.col("total_crime_count"), size),
        "crime_category_count": F.size("crime_categories"),
        "is_crime_hotspot": F.col("max_hotspot_score") >= 0.5,
    })


def infrastructure_per_cell(density: DataFrame) -> DataFrame:
    """Density rows of all types summed per cell; the quality is the mean over types."""
    named = density.withColumnsRenamed({"grid_center_easting": "grid_easting", "grid_center_northing": "grid_northing"})
    return named.groupBy(*JOIN_KEYS).agg(
        F.sum("infrastructure_count").alias("total_infrastructure_count"),
        F.sum("density_per_km2").alias("total_infrastructure_density"),
        value_set("infrastructure_type").alias("infrastructure_types"),
        F.avg("avg_quality_score").alias("avg_quality_score"),
    ).withColumn("infrastructure_type_count", F.size("infrastructure_types")).withColumn(
        "infrastructure_diversity_score", F.col("infrastructure_type_count") / F.lit(10.0)
    )


def joined_cells(density: DataFrame, hotspots: DataFrame, size: int = K.ASSET_CELL_M, anchor: str = "center") -> DataFrame:
    """Every cell either side knows. With ``anchor='corner'`` the crime cells carry their
    lower-left corner and do not meet the infrastructure cells, which carry their centre."""
    cells = infrastructure_per_cell(density).join(crime_per_cell(hotspots, size, anchor), JOIN_KEYS, "full_outer")
    return cells.fillna(FILL)


def correlation(density: DataFrame, hotspots: DataFrame, size: int = K.ASSET_CELL_M, anchor: str = "center",
                run_time: datetime | None = None) -> DataFrame:
    """Correlation score, risk level, vulnerability and safety per cell."""
    infra_n, crime_n = F.col("normalized_infra_density"), F.col("normalized_crime_density")
    has_infra = F.col("total_infrastructure_count") > 0
    cells = joined_cells(density, hotspots, size, anchor).withColumns({
        "grid_cell_id": F.concat(F.lit("grid_"), *_joined_text(JOIN_KEYS)),
        "normalized_infra_density": F.col("total_infrastructure_density") / 100.0,
        "normalized_crime_density": F.col("total_crime_density") / 50.0,
    }).withColumns({
        "correlation_score": scalars.capped_product(infra_n, crime_n),
        "risk_level": classify.zone_risk(
            F.col("is_crime_hotspot"), F.col("total_crime_count"), F.col("total_infrastructure_count")
        ),
        "infrastructure_vulnerability": F.when(has_infra, crime_n * (1 - F.col("avg_quality_score"))).otherwise(0.0),
        "safety_index": F.when(has_infra, infra_n * (1 - crime_n)).otherwise(0.0),
    }).withColumn("correlation_level", classify.correlation_level(F.col("correlation_score")))
    return with_analysis_time(cells, run_time)


def _joined_text(columns: list[str]) -> list:
    """Cell coordinates in the ``389500.0`` form, separated by underscores."""
    text = [F.col(c).cast("decimal(20,1)").cast("string") for c in columns]
    return [text[0], *[part for t in text[1:] for part in (F.lit("_"), t)]]


ZONE_COLUMNS = (
    "grid_cell_id", "grid_easting", "grid_northing", "total_infrastructure_count", "infrastructure_types",
    "infrastructure_type_count", "avg_quality_score", "total_crime_count", "crime_categories",
    "crime_category_count", "max_hotspot_score", "correlation_score", "infrastructure_vulnerability", "safety_index",
)


def high_risk_zones(cells: DataFrame) -> DataFrame:
    """High-risk cells ranked by vulnerability, ties by cell id, with the action to take."""
    zones = cells.where(F.col("risk_level") == "high_risk").select(*ZONE_COLUMNS)
    ranked = global_rank(zones, [F.desc("infrastructure_vulnerability"), F.asc("grid_cell_id")], "priority_rank")
    return ranked.withColumn(
        "recommended_action", classify.recommended_action(F.col("avg_quality_score"), F.col("max_hotspot_score"))
    )


def level_distribution(cells: DataFrame, column: str = "correlation_level") -> DataFrame:
    return value_counts(cells, column, name="cells")


def level_report(cells: DataFrame) -> DataFrame:
    """Cells per correlation and per risk level, from one pass over the cells."""
    levels = F.array(*[F.struct(F.lit(what).alias("what"), F.col(c).alias("level")) for what, c in (("correlation", "correlation_level"), ("risk", "risk_level"))])
    return cells.select(F.inline(levels)).groupBy("what", "level").agg(F.count("*").alias("cells"))


def coverage(cells: DataFrame) -> DataFrame:
    """Cells by what they contain, as counts and percentages."""
    infra, crime = F.col("total_infrastructure_count") > 0, F.col("total_crime_count") > 0
    totals = cells.agg(
        F.count("*").alias("total_cells"),
        F.count_if(infra).alias("cells_with_infra"), F.count_if(crime).alias("cells_with_crime"),
        F.count_if(F.col("correlation_level") == "high").alias("high_correlation_cells"),
        F.count_if(F.col("risk_level") == "high_risk").alias("high_risk_cells"),
    )
    return totals.withColumns({
        "infra_percent": scalars.percent(F.col("cells_with_infra"), F.col("total_cells")),
        "crime_percent": scalars.percent(F.col("cells_with_crime"), F.col("total_cells")),
    })
