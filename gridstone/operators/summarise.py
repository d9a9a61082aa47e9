"""Aggregations and ranking used by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstone.session import cut_lineage


def value_set(col: str | Column) -> Column:
    """Distinct values of a group in a fixed order."""
    return F.sort_array(F.collect_set(col))


def counted(condition: Column) -> Column:
    """How many rows meet the condition; unknown counts as no."""
    return F.count_if(condition)


def value_counts(df: DataFrame, *columns: str, name: str = "records") -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return df.groupBy(*columns).agg(F.count("*").alias(name)).orderBy(F.desc(name), *columns)


def monthly_counts(df: DataFrame, column: str, name: str = "records") -> DataFrame:
    month = F.trunc(F.to_date(column), "month")
    return df.groupBy(month.alias("month")).agg(F.count("*").alias(name))


def distinct_count(df: DataFrame, *columns: str, name: str = "distinct_values") -> DataFrame:
    return df.select(*columns).distinct().agg(F.count("*").alias(name))


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, spread and exact quartiles of numeric columns, one row per column.

    The input is evaluated once, for the counted values that the quartiles need; all other figures are
    made from these."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])
    keys = [*by, "column_name"]
    values = _counted_values(df.select(*by, F.inline(cells)).where("v is not null and not isnan(v)"), keys, "v")
    basic = values.groupBy(*keys).agg(
        F.sum("__n").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), F.sum(F.col("v") * F.col("__n")).alias("total"),
    ).withColumn("mean", F.col("total") / F.col("n"))
    away = F.col("v") - F.col("mean")
    spread = _joined(values, basic.select(*keys, "mean"), keys).groupBy(*keys).agg(F.sum(away * away * F.col("__n")).alias("__squares"))
    quartiles = _quantiles_of(values, keys, "v", QUARTILES)
    deviation = F.sqrt(F.try_divide(F.col("__squares"), F.when(F.col("n") > 1, F.col("n") - 1)))
    return (
        _joined(_joined(basic, quartiles, keys), spread, keys).withColumn("std", deviation)
        .select(*keys, "n", "mean", "std", "min", *QUARTILES, "max", "total")
    )


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]).drop(*[f"__{k}" for k in keys])


def quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float]) -> DataFrame:
    """Exact quantiles per group, interpolated between neighbours.

    Equal values are counted first. The counts are range-partitioned by group and value and
    written once; each range is summed up by itself and shifted by the counts before it, so
    no task holds a whole group. Only the rows around each wanted position are kept."""
    return _quantiles_of(_counted_values(df, keys, value), keys, value, wanted)


def _counted_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each value of a group occurs (``__n``), range-partitioned (``__range``) and written."""
    order = [*[F.asc(k) for k in keys], F.asc(value)]
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    return cut_lineage(counts.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))


def _quantiles_of(ranged: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float]) -> DataFrame:
    # One row per group and range.
    per_range = ranged.groupBy(*keys, "__range").agg(F.sum("__n").alias("__in_range"))
    group = Window.partitionBy(*keys)
    so_far = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys, "__range", F.coalesce(F.sum("__in_range").over(so_far), F.lit(0)).alias("__before"),
        F.sum("__in_range").over(group).alias("__total"),
    )
    within = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("__before") + F.sum("__n").over(within)
    placed = _joined(ranged, offsets, [*keys, "__range"]).withColumns({"__upto": upto})
    made = []
    for name, share in wanted.items():
        spot = (F.col("__total") - 1) * F.lit(share)
        # The value at a zero-based position is the first whose running count exceeds it.
        low = F.min(F.when(F.col("__upto") > F.floor(spot), F.col(value)))
        high = F.min(F.when(F.col("__upto") > F.ceil(spot), F.col(value)))
        part = F.max(spot - F.floor(spot))
        made.append((low + (high - low) * part).alias(name))
    return placed.groupBy(*keys).agg(*made)


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    """First ``k`` rows of a total order; every task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def nearest_k(df: DataFrame, point: tuple[float, float], k: int = 5, id_column: str = "id",
              xy: tuple[str, str] = ("lat", "lon"), name: str = "distance") -> DataFrame:
    """The ``k`` rows closest to a point; rows without coordinates do not take part."""
    dx, dy = F.col(xy[0]) - F.lit(point[0]), F.col(xy[1]) - F.lit(point[1])
    measured = df.withColumn(name, F.sqrt(dx * dx + dy * dy)).where(F.col(name).isNotNull())
    return top_k(measured, k, F.asc(name), F.asc(id_column))


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Position of every row in a total order, without sorting everything in one task.

    Rows are range-partitioned by the order and written once, so that both uses below see
    the same ranges. Each range is numbered by itself and shifted by the number of rows
    before it; only those counts, one per range, meet in one place."""
    ranged = cut_lineage(
        df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__range").agg(F.count("*").alias("n")).select(
        "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset")
    )
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return (
        ranged.withColumn("__place", place)
        .join(F.broadcast(offsets), "__range")
        .withColumn(name, (F.col("__offset") + F.col("__place")).cast("long"))
        .drop("__range", "__place", "__offset")
    )


def with_share_of_max(df: DataFrame, column: str, name: str, maximum: DataFrame | None = None) -> DataFrame:
    """``column`` divided by its greatest value, 0 when that is not positive.

    The maximum is a scalar subquery; pass a one-cell frame when it can be had cheaper."""
    top = (maximum if maximum is not None else df.agg(F.max(column).alias("top"))).scalar()
    scaled = df.withColumn("__top", top)
    return scaled.withColumn(
        name, F.when(F.col("__top") > 0, F.col(column) / F.col("__top")).otherwise(0.0)
    ).drop("__top")
