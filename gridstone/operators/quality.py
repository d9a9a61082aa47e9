"""Quality scores, flags, profiling and gates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone.functions import geo, scalars


def completeness_score(df: DataFrame, columns: Sequence[str]) -> Column:
    """Share of the listed columns that are filled, over those that exist."""
    known = [c for c in columns if c in df.columns]
    if not known:
        return F.lit(0.0)
    return reduce(add, [F.col(c).isNotNull().cast("int") for c in known]) / F.lit(float(len(known)))


def with_flags(df: DataFrame) -> DataFrame:
    """Presence flags for coordinates, grid coordinates, postcode and admin area."""
    pairs = {
        "has_coordinates": ("lat", "lon"),
        "has_bng_coords": ("easting_bng", "northing_bng"),
        "has_postcode": ("postcode",),
        "has_admin_data": ("admin_district",),
    }
    made = {
        name: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        for name, cols in pairs.items() if all(c in df.columns for c in cols)
    }
    return df.withColumns(made) if made else df


def with_incident_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "has_outcome": F.col("outcome_category").isNotNull(),
        "has_street": F.col("street_name").isNotNull(),
    })


def flag_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Count and percentage of true per flag, from one pass."""
    known = [c for c in flags if c in df.columns]
    totals = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c)).alias(c) for c in known])
    return totals.unpivot("total", known, "flag", "true_count").select(
        "flag", "true_count", "total", scalars.percent(F.col("true_count"), F.col("total")).alias("true_percent")
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with nulls, most first."""
    names = list(columns or df.columns)
    totals = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    return (
        totals.unpivot("total", names, "column_name", "null_count")
        .where("null_count > 0")
        .select("column_name", "null_count", scalars.percent(F.col("null_count"), F.col("total")).alias("null_percent"))
        .orderBy(F.desc("null_count"), "column_name")
    )


def column_listing(df: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def coordinate_ranges(df: DataFrame, lat: str = "lat", lon: str = "lon", bbox: dict = K.BBOX) -> DataFrame:
    """Ranges and in-box counts; text coordinates are converted first."""
    y, x = scalars.to_number(F.col(lat)), scalars.to_number(F.col(lon))
    return df.select(y.alias("lat"), x.alias("lon")).agg(
        F.count("*").alias("records"),
        F.count("lat").alias("with_lat"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.count_if(geo.within_bbox(F.col("lat"), F.col("lon"), bbox)).alias("inside_bbox"),
    )


def missing_coordinates(df: DataFrame, by: Sequence[str] = ("type", "infrastructure_type")) -> DataFrame:
    """How many records lack coordinates, by element type."""
    return df.where(F.col("lat").isNull()).groupBy(*by).agg(F.count("*").alias("missing"))


def field_completeness(df: DataFrame, fields: Sequence[str] = K.ASSET_REPORTED_FIELDS) -> DataFrame:
    """Filled share per field, ``good`` above one half."""
    known = [c for c in fields if c in df.columns]
    totals = df.agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in known])
    share = F.try_divide("filled", "total") * 100
    return totals.unpivot("total", known, "field", "filled").select(
        "field", "filled", "total", F.round(share, 1).alias("filled_percent"),
        F.when(share > 50, "good").otherwise("sparse").alias("status"),
    )


def share(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def asset_ratios(df: DataFrame) -> DataFrame:
    technical = reduce(or_, [F.col(c).isNotNull() for c in ("substance", "material", "diameter")])
    return df.agg(
        share(F.col("lat").isNotNull()).alias("completeness"),
        share(F.col("operator").isNotNull()).alias("has_operator"),
        share(technical).alias("has_metadata"),
    )


def incident_ratios(df: DataFrame) -> DataFrame:
    return df.agg(
        share(scalars.to_number(F.col("lat")).isNotNull()).alias("has_coords"),
        share(F.col("outcome_category").isNotNull()).alias("has_outcome"),
        share(F.col("street_name").isNotNull()).alias("has_location"),
    )


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key. Counting per key first keeps the shuffle to one row
    per key and task."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).agg(
        F.sum("copies").alias("records"),
        F.count("*").alias("distinct_keys"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
    )


def gate_aggregates() -> dict[str, Column]:
    """The three gated shares of a silver table, as aggregates."""
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    projected = F.col("easting_bng").isNotNull() & F.col("northing_bng").isNotNull()
    outside = located & ~F.col("is_valid_location")
    return {
        "coordinate_completeness": share(located),
        "projection_success": F.try_divide(F.count_if(projected), F.count_if(located)),
        "bbox_outliers": F.try_divide(F.count_if(outside), F.count_if(located)),
    }


def gate_metrics(df: DataFrame) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in gate_aggregates().items()])


def quality_gates(df: DataFrame, gates=K.QUALITY_GATES) -> DataFrame:
    """One row per gate with its value, limit and verdict."""
    names = [g[0] for g in gates]
    limits = F.coalesce(*[F.when(F.col("gate") == n, F.lit(limit)) for n, _, limit in gates])
    at_most = F.col("gate").isin([n for n, op, _ in gates if op == "<="])
    return (
        gate_metrics(df).unpivot([], names, "gate", "value")
        .withColumn("limit", limits)
        .withColumn("passed", F.when(at_most, F.col("value") <= F.col("limit")).otherwise(F.col("value") >= F.col("limit")))
    )


def incoming_counts() -> dict[str, Column]:
    return {"rows_in": F.count("*"), "missing_in": F.count_if(F.col("lat").isNull())}


def outgoing_counts() -> dict[str, Column]:
    return {
        "rows_out": F.count("*"), "missing_out": F.count_if(F.col("lat").isNull()),
        "enriched": F.count_if(F.col("postcode").isNotNull()), "measured": F.count_if(F.col("length_meters").isNotNull()),
    }


def asset_reconciliation(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in and out of the asset step, and how many were repaired and enriched, from two tables.
    :func:`silver.load_assets` observes the same figures while it writes."""
    # Two one-row aggregates side by side.
    parts = [df.agg(*[c.alias(n) for n, c in counts.items()]).unpivot([], list(counts), "metric", "value")
             for df, counts in ((before, incoming_counts()), (after, outgoing_counts()))]
    return parts[0].unionByName(parts[1])


def profile(datasets: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Inspection report: per dataset its records, columns and type histogram.

    ``datasets`` maps a name to the table and its optional type column."""
    parts = []
    for name, (df, kind) in datasets.items():
        value = F.col(kind).cast("string") if kind else F.lit(None).cast("string")
        parts.append(
            df.groupBy(value.alias("type")).agg(F.count("*").alias("n"))
            .agg(
                F.sum("n").alias("records"),
                F.map_from_entries(F.sort_array(F.collect_list(
                    F.when(F.col("type").isNotNull(), F.struct("type", "n"))
                ))).alias("types"),
            )
            .select(F.lit(name).alias("dataset"), F.coalesce("records", F.lit(0)).alias("records"),
                    F.lit(list(df.columns)).alias("columns"), "types")
        )
    return reduce(DataFrame.unionByName, parts)


def type_counts(datasets: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """The type histograms of :func:`profile` in long form, for datasets of many types: dataset, type, records."""
    parts = [
        df.groupBy((F.col(kind).cast("string") if kind else F.lit(None).cast("string")).alias("type")).agg(F.count("*").alias("records"))
        .select(F.lit(name).alias("dataset"), "type", "records")
        for name, (df, kind) in datasets.items()
    ]
    return reduce(DataFrame.unionByName, parts)
