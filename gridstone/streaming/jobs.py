"""Incremental versions of the batch steps on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridstone.plans.weather import SILVER_COLUMNS


def follow_snapshots(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "json",
                     max_files: int | None = None, **options: str) -> DataFrame:
    """New files of a landing folder."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def drop_reingested(stream: DataFrame, keys: Sequence[str], time: str = "ingestion_timestamp",
                    within: str = "7 days") -> DataFrame:
    """First arrival per key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))


def daily_weather(stream: DataFrame, late: str = "2 days", columns: Mapping[str, str] = SILVER_COLUMNS) -> DataFrame:
    """Daily figures that accept late observations up to the watermark. Windows start at
    midnight UTC, so the days are UTC days whatever the session's time zone."""
    def measure(key: str):
        return F.col(columns[key])

    rain = F.coalesce(measure("rain"), F.lit(0.0))
    return (
        stream.withWatermark(columns["time"], late)
        .groupBy(F.window(columns["time"], "1 day"))
        .agg(
            F.avg(measure("temperature")).alias("avg_temperature"),
            F.min(measure("temperature")).alias("min_temperature"),
            F.max(measure("temperature")).alias("max_temperature"),
            F.avg(measure("humidity")).alias("avg_humidity"),
            F.avg(measure("wind_speed")).alias("avg_wind_speed"),
            F.sum(rain).alias("total_rainfall_mm"),
            F.max(measure("condition")).alias("dominant_weather"),
            F.count("*").alias("observation_count"),
        )
        .withColumn("date", F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window.start"))))
        .drop("window")
    )


def append_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 partition_by: Sequence[str] = (), mode: str = "append") -> StreamingQuery:
    """Write everything available, then stop. A stream that corrects itself needs ``mode="update"``; its
    corrections are appended."""
    if mode != "append":
        def add(batch: DataFrame, i: int) -> None:
            # Named after the batch, so that a repeated batch replaces what it wrote.
            batch.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(f"{path.rstrip('/')}/batch_id={i}")

        writer = stream.writeStream.foreachBatch(add).outputMode(mode)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def replace_changed(stream: DataFrame, partition: str, path: str, checkpoint: str) -> StreamingQuery:
    """Write the groups of an aggregation that each batch changed, in place of their former rows.
    Groups still open are written too; a repeated batch is harmless."""
    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    return (
        stream.writeStream.foreachBatch(replace).outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def refresh_partitions(stream: DataFrame, history: Callable[[], DataFrame], aggregate: Callable[[DataFrame], DataFrame],
                       partition: str, path: str, checkpoint: str) -> StreamingQuery:
    """Rebuild the output partitions a batch touches.

    ``history`` reads the full input, stored by the partition column, so that only the touched
    partitions are read, aggregated again and replaced. A repeated batch is harmless. The driver
    holds the values of the touched partitions, as it does for any partitioned write."""
    def refresh(batch: DataFrame, _: int) -> None:
        touched = [r[0] for r in batch.select(partition).distinct().collect()]
        wanted = F.col(partition).isin([t for t in touched if t is not None])
        if None in touched:
            wanted = wanted | F.col(partition).isNull()
        fresh = aggregate(history().where(wanted))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    return (
        stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
