"""Reading files, folders and catalog tables. Schemas are always given, never guessed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridstone.operators.clean import with_ingestion
from gridstone.schemas import struct


Schema = str | T.StructType


def read_csv(spark: SparkSession, path: str, schema: Schema, corrupt_column: str | None = None) -> DataFrame:
    """Header CSV. With ``corrupt_column``, lines that do not fit are kept there whole."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
    if corrupt_column:
        schema = T.StructType([*struct(schema).fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_partitioned(spark: SparkSession, path: str, schema: Schema | None = None, fmt: str = "parquet") -> DataFrame:
    """Hive-partitioned folder; partition columns come back as data and prune."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_snapshots(spark: SparkSession, path: str, schema: Schema, multi_line: bool = True) -> DataFrame:
    """Raw JSON payloads as saved by the collectors, one document per file."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def from_records(spark: SparkSession, records: Iterable[Mapping], schema: Schema, run_time: datetime,
                 **ingestion: str) -> DataFrame:
    """A handful of driver-side records as a table; ingestion columns only if absent."""
    return with_ingestion(spark.createDataFrame(list(records), schema), run_time, **ingestion)
