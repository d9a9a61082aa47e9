"""Writing files and tables, exports and the ingestion log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridstone.functions import scalars
from gridstone.schemas import LAYERS
from gridstone.session import scratch_path

INGESTION_LOG = (
    "data_type string, record_count bigint, ingestion_timestamp timestamp, ingestion_date date, "
    "file_path string, status string"
)


@dataclass(frozen=True)
class Written:
    """What a write produced; ``path`` is empty when there was nothing to write."""

    path: str | None
    records: int


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen


def _seen(observation: Observation) -> int:
    return observation.get.get("records", 0)


def clustered(df: DataFrame, partition_by: Sequence[str], files_per_partition: int = 1) -> DataFrame:
    """Rows grouped by output partition, so that tasks do not each open every partition. Adaptive
    execution splits a large partition over several tasks and joins small ones.

    ``files_per_partition`` first deals every partition over that many tasks."""
    if not partition_by:
        return df
    if files_per_partition <= 1:
        return df.hint("rebalance", *partition_by)
    content = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    share = F.pmod(F.xxhash64(*content), F.lit(files_per_partition))
    return df.withColumn("__share", share).hint("rebalance", *partition_by, "__share").drop("__share")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append",
                  files_per_partition: int = 1) -> Written:
    """Snappy Parquet, counted in the job that writes it. Nothing is left behind for an empty input."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    existed = store.exists(folder)
    counted, seen = _counted(clustered(df, partition_by, files_per_partition))
    counted.write.mode(mode).partitionBy(*partition_by).parquet(path)
    records = _seen(seen)
    if records:
        return Written(path, records)
    if not existed:
        store.delete(folder, True)
    return Written(None, 0)


def write_snapshot(df: DataFrame, path: str, run_time: datetime) -> Written:
    """Raw JSON documents, gzipped, in a folder named after the run."""
    target = f"{path.rstrip('/')}/ingestion_ts={run_time:%Y%m%d_%H%M%S}"
    counted, seen = _counted(df)
    counted.write.mode("append").json(target, compression="gzip")
    return Written(target, _seen(seen))


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> Written:
    """Replace a managed table, schema included."""
    counted, seen = _counted(clustered(df, partition_by))
    counted.write.mode("overwrite").format(fmt).partitionBy(*partition_by).saveAsTable(name)
    return Written(name, _seen(seen))


def append_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> Written:
    """Append to a partitioned table. A table that lacks some of the columns is first given
    them; columns the input lacks are written as nulls."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        known = spark.table(name).schema
        fresh = [f for f in df.schema.fields if f.name not in known.fieldNames()]
        if fresh:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            known = spark.table(name).schema
        absent = {f.name: F.lit(None).cast(f.dataType) for f in known.fields if f.name not in df.columns}
        df = df.withColumns(absent) if absent else df
        df = df.select(*known.fieldNames())
    counted, seen = _counted(clustered(df, partition_by))
    counted.write.mode("append").format(fmt).partitionBy(*partition_by).saveAsTable(name)
    return Written(name, _seen(seen))


def write_external(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> Written:
    """Write files at a path and register them as a table. An external table of that name is
    registered anew, its former files stay; a managed one is not replaced."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is not an external table")
    counted, seen = _counted(df)
    counted.write.mode("overwrite").format(fmt).save(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    return Written(path, _seen(seen))


def move_table(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> bool:
    """Recreate ``source`` as ``target``, partitioned alike, and drop it; false when there is no
    source. The source goes only once the target is complete. A renamed table would keep the
    former places of its partitions, so the rows are written anew."""
    if not spark.catalog.tableExists(source):
        return False
    partitions = [c.name for c in spark.catalog.listColumns(source) if c.isPartition]
    written = overwrite_table(spark.table(source), target, fmt, partitions)
    if not verify_table(spark, target, written.records):
        raise RuntimeError(f"{target} does not hold the {written.records} rows of {source}")
    spark.sql(f"DROP TABLE {source}")
    return True


def write_summary_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str, simple_columns: Sequence[str], split_by: str | None = None,
               coordinates: Sequence[str] | None = None) -> list[str]:
    """Full table, key-column view, one folder per category and a mapping file.

    The input is computed once, into the shared folder, and every output is made from there.
    Categories are written in one partitioned pass; rows without coordinates stay out of
    the mapping file."""
    root, schema = path.rstrip("/"), df.schema
    staged = scratch_path(df.sparkSession, "export")
    df.write.parquet(staged)
    df = df.sparkSession.read.schema(schema).parquet(staged)
    outputs: dict[str, DataFrame] = {"full": df, "simple": df.select(*simple_columns)}
    if coordinates:
        numbers = {c: scalars.to_number(F.col(c)) for c in ("lat", "lon")}
        outputs["coordinates"] = df.select(*coordinates).withColumns(numbers).dropna(subset=["lat", "lon"])
    for name, frame in outputs.items():
        frame.write.mode("overwrite").option("header", True).csv(f"{root}/{name}")
    if split_by:
        labelled = df.withColumn("export_group", scalars.file_label(F.col(split_by)))
        clustered(labelled, ["export_group"]).write.mode("overwrite").option("header", True) \
            .partitionBy("export_group").csv(f"{root}/by_{split_by}")
    return [f"{root}/{n}" for n in outputs] + ([f"{root}/by_{split_by}"] if split_by else [])


def dataset_summary(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Records and usable coordinates per dataset."""
    def usable() -> Column:
        return scalars.to_number(F.col("lat")).isNotNull() & scalars.to_number(F.col("lon")).isNotNull()

    parts = [
        df.agg(F.count("*").alias("total_records"), F.count_if(usable()).alias("has_coordinates"))
        .select(F.lit(name).alias("dataset"), "total_records", "has_coordinates")
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def log_ingestion(spark: SparkSession, log_path: str, data_type: str, result: Written, run_time: datetime) -> DataFrame:
    """Append one record about a write to the ingestion log and return it."""
    row = (data_type, result.records, run_time, run_time.date(), result.path,
           "success" if result.records > 0 else "no_data")
    record = spark.createDataFrame([row], INGESTION_LOG)
    record.write.mode("append").parquet(log_path)
    return record


def list_layers(spark: SparkSession, layers: Sequence[str] = LAYERS) -> DataFrame:
    """Tables of all layers, ordered."""
    parts = [
        spark.sql(f"SHOW TABLES IN {layer}").select(F.lit(layer).alias("layer"), F.col("tableName").alias("table_name"))
        for layer in layers if spark.catalog.databaseExists(layer)
    ]
    return reduce(DataFrame.unionAll, parts).orderBy("layer", "table_name")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def verify_table(spark: SparkSession, name: str, expected: int) -> bool:
    """Re-read a table and compare its size with what was written."""
    return spark.table(name).count() == expected


def verification(spark: SparkSession, name: str, written: Written, coordinates: Sequence[str] = ("lat", "lon"),
                 partition_by: str | None = None) -> DataFrame:
    """One row about a table after a write: rows written and read back, rows without coordinates
    and values of the partition column."""
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in coordinates])
    partitions = F.count_distinct(partition_by) if partition_by else F.lit(0).cast("long")
    return spark.table(name).agg(
        F.lit(written.records).cast("long").alias("written"), F.count("*").alias("read_back"),
        F.count_if(missing).alias("null_coordinates"), partitions.alias("partitions"),
    ).withColumn("complete", F.col("written") == F.col("read_back"))


def cluster_files(df: DataFrame, path: str, by: Sequence[str], partitions: int | None = None) -> None:
    """Rewrite range-clustered, so that row groups can be skipped by the leading columns."""
    keys = [F.col(c) for c in by]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
