"""Distinct counts and quantiles that can be rolled up: sketches kept beside exact counts.

A distinct count of a month is not the sum of those of its days, so exact roll-ups read the rows again.
A sketch of a few kilobytes per cell can be merged instead. Exact counts stay the default everywhere;
these tables are for coarser levels that should not touch the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sketch has 2**LOG_K registers; its relative standard error is 1.04 / sqrt(2**LOG_K), 1.6 %.
LOG_K = 12
#: Accuracy of quantile sketches: the rank of an answer is off by less than RANK_ERROR, nearly always.
RANK_K, RANK_ERROR = 400, 0.01


def relative_error(log_k: int = LOG_K, deviations: float = 3) -> float:
    """Bound that an estimate keeps but for one in some hundred (three standard deviations)."""
    return deviations * 1.04 / math.sqrt(2**log_k)


def distinct_cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str], log_k: int = LOG_K) -> DataFrame:
    """Rows and a sketch of the distinct values of each column per cell, ``<column>_sketch``. Combines
    within tasks, so a hot cell travels as one sketch a task."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("records"), *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(log_k)).alias(f"{c}_sketch") for c in columns])


def rolled_up(cells: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Cells merged into coarser ones; still sketches, so that it can be done again."""
    return cells.groupBy(*keys).agg(F.sum("records").alias("records"), *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns])


def estimated(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sketches replaced by estimates ``<column>_estimate``."""
    kept = [c for c in cells.columns if c not in [f"{x}_sketch" for x in columns]]
    return cells.select(*kept, *[F.coalesce(F.hll_sketch_estimate(f"{c}_sketch"), F.lit(0).cast("long")).alias(f"{c}_estimate") for c in columns])


def agrees(estimate: str | Column, exact: str | Column, log_k: int = LOG_K) -> Column:
    """Whether an estimate is within its error of the exact count."""
    estimate, exact = (F.col(c) if isinstance(c, str) else c for c in (estimate, exact))
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(relative_error(log_k)))


def quantile_cells(df: DataFrame, keys: Sequence[str], column: str, k: int = RANK_K) -> DataFrame:
    """A quantile sketch of a numeric column per cell; nulls and NaN take no part."""
    value = F.col(column).cast("double")
    return df.where(value.isNotNull() & ~F.isnan(value)).groupBy(*keys).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("quantiles"))


def merged_quantiles(cells: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return cells.groupBy(*keys).agg(F.kll_merge_agg_double("quantiles").alias("quantiles"))


def at_ranks(cells: DataFrame, wanted: Mapping[str, float]) -> DataFrame:
    """Approximate quantiles by name in place of the sketch."""
    return cells.withColumns({name: F.kll_sketch_get_quantile_double("quantiles", F.lit(share)) for name, share in wanted.items()}).drop("quantiles")
