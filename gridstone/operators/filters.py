"""Row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone.functions import geo, scalars
from gridstone.operators import clean


def select_features(elements: DataFrame, rules=K.FEATURE_RULES, bbox: dict = K.BBOX) -> DataFrame:
    """Elements that match a (type, tag key, tag value) rule and touch the bounding box,
    with the matched ``feature`` name. Rules are few and fixed, so they become one
    predicate evaluated in the scan instead of a join."""
    tags = F.col("tags")
    feature = F.coalesce(*[
        F.when((F.col("type") == kind) & (tags[key] == value), name) for name, kind, key, value in rules
    ])
    inside = geo.within_bbox(F.col("lat"), F.col("lon"), bbox) | F.coalesce(
        F.exists("geometry", lambda v: geo.within_bbox(v["lat"], v["lon"], bbox)), F.lit(False)
    )
    return elements.withColumn("feature", feature).where(F.col("feature").isNotNull() & inside)


def prefer(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Rows of the first value in ``order`` that occurs at all; the choice is made by a
    scalar subquery, not on the driver."""
    rank = F.coalesce(*[F.when(F.col(column) == v, i) for i, v in enumerate(order)])
    best = df.agg(F.min(rank).alias("best")).scalar()
    return df.where(rank == best)


def lookup(df: DataFrame, reference: DataFrame, code: str, reference_code: str = "postcode", how: str = "inner") -> DataFrame:
    """Join by normalised code; ``how='left_anti'`` lists the codes without a match. Of several
    reference rows with one code the first ingested counts, so no row is multiplied."""
    left = df.withColumn("__code", scalars.lookup_code(F.col(code)))
    right = reference.withColumn("__code", scalars.lookup_code(F.col(reference_code)))
    if how != "left_anti":
        right = clean.keep_first(right.where("__code is not null"), ["__code"])
        right = right.drop(*[c for c in reference.columns if c in df.columns])
    return left.join(right, "__code", how).drop("__code")


def flag_inside(df: DataFrame, bbox: dict = K.BBOX, name: str = "is_valid_location") -> DataFrame:
    return df.withColumn(name, geo.within_bbox(F.col("lat"), F.col("lon"), bbox))


def present(column: str) -> Column:
    return F.col(column).isNotNull()
