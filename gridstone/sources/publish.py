"""Write, audit, publish: a load becomes visible only if its gates pass.

One pass writes all rows of a load, good ones and, apart from them, those that fail a check, with the names
of the checks they fail. The figures of the gates are observed in that same write. A table's name is a view
on one load's good rows; publishing points it at the new load in one step, so readers see the former load
or the new one, never a part. A load that fails leaves the view as it was and its files for inspection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone.operators import quality

QUARANTINED, REASONS = "quarantined", "failed_checks"


@dataclass(frozen=True)
class Audit:
    """What a load held and how it fared."""

    path: str
    records: int
    rejected: Mapping[str, int]  # rows by the check they fail
    gates: tuple[tuple[str, float | None, str, float, bool], ...]  # name, value, operator, limit, passed
    published: bool

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per gate."""
        return spark.createDataFrame([(n, v, limit, ok, self.published) for n, v, _, limit, ok in self.gates],
                                     "gate string, value double, limit double, passed boolean, published boolean")


def load(df: DataFrame, name: str, path: str, checks: Mapping[str, Column], gates: Sequence[tuple[str, str, float]] = K.QUALITY_GATES,
         figures: Mapping[str, Column] | None = None) -> Audit:
    """Writes a load to ``path`` and publishes its good rows as ``name`` if all gates pass.

    ``checks``: what every row must meet; unknown counts as failed. ``figures``: the aggregates that gates
    are about, over all rows of the load. A gate without a value, as on an empty load, does not pass."""
    failed = {n: ~F.coalesce(c, F.lit(False)) for n, c in checks.items()}
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in failed.items()]))
    seen = Observation()
    figures = quality.gate_aggregates() if figures is None else figures
    audited = df.observe(
        seen, F.count(F.lit(1)).alias("__records"), *[F.count_if(c).alias(f"__failed_{n}") for n, c in failed.items()],
        *[c.alias(n) for n, c in figures.items()],
    ).withColumn(REASONS, reasons).withColumn(QUARANTINED, (F.size(REASONS) > 0).cast("int"))
    audited.write.partitionBy(QUARANTINED).parquet(path)
    got = seen.get
    judged = tuple((n, got.get(n), op, limit, _passes(got.get(n), op, limit)) for n, op, limit in gates)
    passed = all(g[-1] for g in judged)
    if passed:
        publish(df.sparkSession, name, path, df.columns)
    return Audit(path, got.get("__records", 0), {n: got.get(f"__failed_{n}", 0) for n in checks}, judged, passed)


def _passes(value: float | None, op: str, limit: float) -> bool:
    return value is not None and (value <= limit if op == "<=" else value >= limit)


def publish(spark: SparkSession, name: str, path: str, columns: Sequence[str]) -> None:
    """Points the view at a load, also at a former one to go back to it."""
    chosen = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {chosen} FROM parquet.`{path}` WHERE {QUARANTINED} = 0")


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a load that failed a check, with the names of the checks."""
    return spark.read.parquet(path).where(F.col(QUARANTINED) == 1).drop(QUARANTINED)
