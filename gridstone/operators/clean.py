"""Column shaping, schema enforcement, deduplication and audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstone.functions import scalars
from gridstone.operators import summarise


def keep_existing(df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Listed columns that exist, in the listed order, plus ``alias: source`` copies."""
    aliases = aliases or {}
    chosen = [F.col(c) for c in columns if c in df.columns]
    copies = [F.col(src).alias(name) for name, src in aliases.items() if src in df.columns]
    return df.select(*chosen, *copies)


def with_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` the input lacks, added as typed nulls."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def _coerced(df: DataFrame, field: T.StructField) -> Column:
    source, col = df.schema[field.name].dataType, F.col(field.name)
    if source == field.dataType:
        return col
    if isinstance(field.dataType, T.DateType) and isinstance(source, T.StringType):
        return scalars.to_day(col)
    if isinstance(field.dataType, T.TimestampType) and isinstance(source, T.StringType):
        return scalars.to_time(col)
    return col.try_cast(field.dataType)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns named in ``schema``; values that do not convert become null."""
    wanted = {f.name: _coerced(df, f) for f in schema.fields if f.name in df.columns}
    return df.withColumns(wanted) if wanted else df


def cast_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many present values :func:`enforce_schema` would turn into null."""
    names = [f for f in schema.fields if f.name in df.columns]
    counts = [F.count_if(F.col(f.name).isNotNull() & _coerced(df, f).isNull()).alias(f.name) for f in names]
    ids = [f.name for f in names]
    return df.agg(*counts).unpivot([], ids, "column_name", "lost_in_cast")


def numbers_from_text(df: DataFrame, columns: Sequence[str] = ("lat", "lon")) -> DataFrame:
    return df.withColumns({c: scalars.to_number(F.col(c)) for c in columns if c in df.columns})


def parse_dates(df: DataFrame, months: Sequence[str] = (), days: Sequence[str] = (), times: Sequence[str] = ()) -> DataFrame:
    """Parse text columns that exist; invalid text becomes null."""
    made = {c: scalars.month_start(F.col(c)) for c in months if c in df.columns}
    made |= {c: scalars.to_day(F.col(c)) for c in days if c in df.columns}
    made |= {c: scalars.to_time(F.col(c)) for c in times if c in df.columns}
    return df.withColumns(made) if made else df


def content_hash(df: DataFrame) -> Column:
    """One number for what a row holds."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ("ingestion_timestamp",),
               total_order: bool = False) -> DataFrame:
    """One row per key: the first in ``order_by``, identical positions decided by content. With
    ``total_order`` the order is unique by itself; columns that nothing else needs stay unread.

    The rank filter lets Spark drop all but one copy per key before the shuffle, so a key
    that holds much of the table does not travel to one task."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_by if not isinstance(c, str) or c in df.columns]
    if not total_order:
        order.append(content_hash(df))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def first_key(df: DataFrame, preferred: str, fallback: str, name: str = "record_key") -> DataFrame:
    """Key from the first of two columns that is neither null nor blank; rows without one are dropped."""
    text = [scalars.blank_to_null(F.col(c).cast("string")) for c in (preferred, fallback)]
    return df.withColumn(name, F.coalesce(*text)).where(F.col(name).isNotNull())


def batches(df: DataFrame, key: str, size: int = 100, name: str = "batch_id") -> DataFrame:
    """Number rows into consecutive lookup batches of exactly ``size`` (the last may be shorter) in
    the order of a unique key. Runs a job when called, see :func:`summarise.global_rank`."""
    ranked = summarise.global_rank(df, [F.asc(key)], "__position")
    return ranked.withColumn(name, F.floor((F.col("__position") - 1) / size)).drop("__position")


def with_ingestion(df: DataFrame, run_time: datetime, source: str | None = None, area: str | None = None,
                   **extra: str) -> DataFrame:
    """Ingestion columns, only where the input does not already have them."""
    wanted: dict[str, Column] = {
        "ingestion_timestamp": F.lit(run_time).cast("timestamp"),
        "ingestion_date": F.lit(run_time.date()),
    }
    if source is not None:
        wanted["source_api"] = F.lit(source)
    if area is not None:
        wanted["area"] = F.lit(area)
    wanted |= {k: F.lit(v) for k, v in extra.items()}
    absent = {k: v for k, v in wanted.items() if k not in df.columns}
    return df.withColumns(absent) if absent else df


def with_audit(df: DataFrame, source_system: str, layer: str = "silver", run_time: datetime | None = None) -> DataFrame:
    at = run_time or datetime.now(timezone.utc)
    return df.withColumns({
        "transformation_timestamp": F.lit(at).cast("timestamp"),
        "transformation_date": F.lit(at.date()),
        "data_layer": F.lit(layer),
        "source_system": F.lit(source_system),
    })


def with_analysis_time(df: DataFrame, run_time: datetime | None = None) -> DataFrame:
    """Analysis columns of the gold tables; left out when no run time is given."""
    if run_time is None:
        return df
    return df.withColumns({
        "analysis_date": F.lit(run_time.date()),
        "analysis_timestamp": F.lit(run_time).cast("timestamp"),
    })
