"""Aggregates of a stream as mergeable partial states.

Every batch writes the partial state of its own rows, one row per cell it touches, and nothing else: no
history is read again. A batch's states lie in a partition named after it, so a repeated batch replaces
what it wrote. Reading merges the states of a cell; :func:`compact` merges those of many batches into one
partition, so that reading does not grow with the number of batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridstone.operators.sketches import LOG_K

#: Partition of the states: the last batch in it, and whether it stands for all batches up to there.
BATCH, WHOLE = "batch_id", "whole"


def partial_states(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], distinct: Sequence[str] = ()) -> DataFrame:
    """Per cell: records, and for each measure its count, sum, least and greatest value, and a sketch of
    each ``distinct`` column."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("records"),
        *[f(F.col(m).cast("double")).alias(f"{m}_{n}") for m in measures for n, f in (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))],
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_K)).alias(f"{c}_sketch") for c in distinct])


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per cell."""
    merge = {"records": F.sum, "n": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "sketch": F.hll_union_agg}
    columns = [c for c in states.columns if c not in (*keys, BATCH, WHOLE)]
    return states.groupBy(*keys).agg(*[merge[c if c == "records" else c.rsplit("_", 1)[1]](c).alias(c) for c in columns])


def finished(states: DataFrame, keys: Sequence[str], measures: Sequence[str], distinct: Sequence[str] = ()) -> DataFrame:
    """Records, averages, extremes, totals and estimated distinct counts per cell."""
    cells = merged_states(states, keys)
    return cells.select(
        *keys, "records", *[c.alias(f"{n}_{m}") for m in measures for n, c in (
            ("avg", F.col(f"{m}_sum") / F.col(f"{m}_n")), ("total", F.col(f"{m}_sum")), ("min", F.col(f"{m}_min")), ("max", F.col(f"{m}_max")))],
        *[F.hll_sketch_estimate(f"{c}_sketch").alias(f"{c}_estimate") for c in distinct])


def write_batch(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], measures: Sequence[str], distinct: Sequence[str] = ()) -> None:
    states = partial_states(batch, keys, measures, distinct)
    _write(states.withColumns({WHOLE: F.lit(0), BATCH: F.lit(batch_id).cast("long")}), path)


def _write(states: DataFrame, path: str) -> None:
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WHOLE, BATCH).parquet(path)


def keep_partials(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], measures: Sequence[str], distinct: Sequence[str] = ()) -> StreamingQuery:
    """Writes the partial states of all that is available, batch by batch, then stops."""
    return (
        stream.writeStream.foreachBatch(lambda batch, i: write_batch(batch, i, path, keys, measures, distinct))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_partials(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The states that count: the latest whole one and the batches behind it. Looks at partition names only."""
    states = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    through = states.where(F.col(WHOLE) == 1).agg(F.max(BATCH)).first()[0]
    if through is None:
        return states
    return states.where(((F.col(WHOLE) == 1) & (F.col(BATCH) == through)) | ((F.col(WHOLE) == 0) & (F.col(BATCH) > through)))


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> int | None:
    """Merges everything written so far into one whole state; what it replaces is no longer read. Gives the
    last batch in it. Readers see the former states until the new one is complete. Not to be run while a
    batch is being written."""
    states = read_partials(spark, path)
    through = states.agg(F.max(BATCH)).first()[0]
    if through is not None:
        _write(merged_states(states, keys).withColumns({WHOLE: F.lit(1), BATCH: F.lit(through).cast("long")}), path)
    return through
