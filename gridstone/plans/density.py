"""Infrastructure density per grid cell and type."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone.functions import geo
from gridstone.operators.clean import with_analysis_time
from gridstone.operators.summarise import counted, value_set

CELL = ("grid_cell_id", "grid_cell_x", "grid_cell_y", "grid_center_easting", "grid_center_northing")


def tier_counts() -> list:
    return [counted(F.col("quality_tier") == t).alias(f"{t}_quality_count") for t in ("high", "medium", "basic")]


def infrastructure_density(assets: DataFrame, size: int = K.ASSET_CELL_M, run_time: datetime | None = None) -> DataFrame:
    """Count, mean score and tiers per cell and type. Elements without coordinates form
    one group with a null cell."""
    cells = geo.with_grid_cell(assets, size).groupBy(*CELL, "infrastructure_type").agg(
        F.count("*").alias("infrastructure_count"),
        F.avg("metadata_quality_score").alias("avg_quality_score"),
        value_set("quality_tier").alias("quality_tiers"),
    )
    dense = cells.withColumn("density_per_km2", geo.density_per_km2(F.col("infrastructure_count"), size))
    return with_analysis_time(dense, run_time)


def infrastructure_stats(assets: DataFrame, size: int = K.ASSET_CELL_M, run_time: datetime | None = None) -> DataFrame:
    """Totals, covered cells and tiers per type."""
    stats = geo.with_grid_cell(assets, size).groupBy("infrastructure_type").agg(
        F.count("*").alias("total_count"),
        F.count_distinct("grid_cell_id").alias("grid_cells_covered"),
        F.avg("metadata_quality_score").alias("avg_quality"),
        *tier_counts(),
    )
    return with_analysis_time(stats, run_time)
