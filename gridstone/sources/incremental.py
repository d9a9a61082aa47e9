"""Keyed incremental loads: a table that holds the first row of every key, whatever arrives when.

Beside the table lies a directory, one narrow row per key: its place in the ingestion order and the
partition its row is in, spread over buckets of the key. A load reads only the buckets its own keys
fall into, finds out which keys are new, which come earlier than the row stored, and which are known,
and rewrites the partitions that gain or lose a row. Nothing else of the table is read.

A load that broke off can be repeated: partitions are rewritten without any row of the keys being
written, and the directory follows last."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gridstone.operators.clean import content_hash, keep_first
from gridstone.session import written_once

BUCKETS = 64


@dataclass(frozen=True)
class Loaded:
    """Keys of a load by what became of them, and the table partitions rewritten or emptied."""

    added: int
    replaced: int
    known: int
    partitions: int


def directory_of(name: str) -> str:
    return f"{name}__keys"


@contextmanager
def _by_partition(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces only the partitions that get rows."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _replace(df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions of a managed table that the rows belong to."""
    spark, rows = df.sparkSession, df.hint("rebalance", *partition_by)
    if not spark.catalog.tableExists(name):
        rows.write.format("parquet").partitionBy(*partition_by).saveAsTable(name)
        return
    with _by_partition(spark):
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def _within(partitions: Sequence[Row], columns: Sequence[str]) -> Column:
    """Rows of some partitions, as a condition that prunes the scan."""
    one = lambda p: reduce(Column.__and__, [F.col(c).isNull() if p[c] is None else F.col(c) == F.lit(p[c]) for c in columns])
    return reduce(Column.__or__, map(one, partitions), F.lit(False))


def _drop(spark: SparkSession, name: str, partition: Row, columns: Sequence[str]) -> None:
    spec = ", ".join(f"`{c}` = null" if partition[c] is None else f"`{c}` = {{v{i}}}" for i, c in enumerate(columns))
    values = {f"v{i}": partition[c] for i, c in enumerate(columns) if partition[c] is not None}
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})", **values)


def load_first(batch: DataFrame, name: str, keys: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str]) -> Loaded:
    """Loads a batch into the managed table ``name`` so that it holds, of everything ever loaded, the first
    row per key in ``order_by``, as :func:`clean.keep_first` would of all batches together.

    Batches may overlap, repeat, and bring rows earlier than those stored, in any partition. The driver
    holds the values of the partitions touched, as it does for any partitioned write."""
    spark, directory = batch.sparkSession, directory_of(name)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    first = written_once(keep_first(batch, keys, order_by).withColumns({"__content": content_hash(batch), "__bucket": bucket}), "load_first")
    order = [*order_by, "__content"]
    entry = first.select(*keys, *order, *partition_by, "__bucket")
    if spark.catalog.tableExists(directory):
        touched = [r[0] for r in entry.select("__bucket").distinct().collect()]
        renamed = {c: f"__old_{c}" for c in dict.fromkeys([*keys, *order, *partition_by])}
        known = spark.table(directory).where(F.col("__bucket").isin(touched)).drop("__bucket").withColumn("__stored", F.lit(True)).withColumnsRenamed(renamed)
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__old_{k}")) for k in keys])
        earlier = F.struct(*order) < F.struct(*[F.col(f"__old_{c}").alias(c) for c in order])
        fate = F.when(F.col("__stored").isNull(), "added").when(earlier, "replaced").otherwise("known")
        # What is known already changes nothing, and may be nearly all: it is only counted.
        judged = written_once(entry.join(known, same, "left").withColumn("__fate", fate).where("__fate <> 'known'"), "load_judged")
    else:
        judged = entry.withColumn("__fate", F.lit("added"))
    counts = {r["__fate"]: r["count"] for r in judged.groupBy("__fate").count().collect()}
    known_already = first.count() - sum(counts.values())
    gaining = judged.select(*partition_by).distinct().collect()
    losing = [] if "replaced" not in counts else judged.where("__fate = 'replaced'").select(*[F.col(f"__old_{c}").alias(c) for c in partition_by]).distinct().collect()
    affected = list(dict.fromkeys([*gaining, *losing]))
    if not affected:
        return Loaded(0, 0, known_already, 0)

    matches = lambda a, b: reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])
    written = judged.select(*keys)
    # Where all rows of a load are taken, as in a first load, none need be looked up.
    rows = first if not known_already else first.join(written, matches(first, written), "left_semi")
    rows = rows.drop("__content", "__bucket")
    filled = set(gaining)
    if spark.catalog.tableExists(name):
        # Added keys have no row yet, unless a load broke off between the table and its directory.
        stored = spark.table(name).where(_within(affected, partition_by))
        rows = written_once(rows.unionByName(stored.join(written, matches(stored, written), "left_anti")), "load_partitions")
        filled = set(rows.select(*partition_by).distinct().collect())
    _replace(rows, name, partition_by)
    for partition in losing:
        if partition not in filled:
            _drop(spark, name, partition, partition_by)

    entries = judged.select(*keys, *order, *[c for c in partition_by if c not in (*keys, *order)], "__bucket")
    if spark.catalog.tableExists(directory):
        old = spark.table(directory).where(F.col("__bucket").isin([r[0] for r in entries.select("__bucket").distinct().collect()]))
        entries = written_once(entries.unionByName(old.join(written, matches(old, written), "left_anti")), "load_keys")
    _replace(entries, directory, ["__bucket"])
    return Loaded(counts.get("added", 0), counts.get("replaced", 0), known_already, len(affected))
