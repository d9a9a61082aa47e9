"""Named queries: a DataFrame builder each, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstone.workload import oracle

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, **ctes: str) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        QUERIES[name] = Query(name, build, oracle.query(sql, **ctes) if sql else None)
        return build

    return register


def six(col: str | Column, name: str | None = None) -> Column:
    """Six-place rounding that matches :func:`gridstone.workload.oracle.stable`."""
    column = F.col(col) if isinstance(col, str) else col
    return F.round(column + F.lit(1e-9), 6).alias(name or col)


def text(col: str, name: str | None = None) -> Column:
    return F.col(col).cast("string").alias(name or col)


def flag(col: str | Column, name: str | None = None) -> Column:
    column = F.col(col) if isinstance(col, str) else col
    return column.cast("int").alias(name or col)


def listed(col: str, name: str | None = None) -> Column:
    """Array shown as text."""
    return F.array_join(F.transform(col, lambda v: v.cast("string")), ",").alias(name or col)
