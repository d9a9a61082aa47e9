"""Bounded nearest-neighbour join.

The reference points are sorted along a Z-order curve and packed, as they come, into leaves of
``LEAF`` points; ``FAN`` consecutive leaves make a node, ``FAN`` of those the next, up to a top of
at most ``TOP`` nodes. Every point is stored once, and the depth follows from their number alone:
clusters of any density, down to points that differ in the last bit, make leaves of the same size.
A node knows the bounding boxes of its children.

A position first goes down to the leaf whose stretch of the curve it falls on: one row, no regrouping.
The best point of that leaf bounds the answer. Then it goes down again with the bound, into every box
that is not farther away, mostly one or two, and the points found within the bound are compared. On the
way the boxes of each level lower the bound, as each of their sides has a point: so a poor leaf, as
for positions far from a cluster, does not lead through all of the cluster.
Every level is an equi-join by node. Which of these joins are broadcast is Spark's choice, from the
sizes of the stored tables; then positions stay where their first exchange put them.

Positions that lie together go down together: those of one tile of the extent as the box around them,
which finds all points that are nearest to any place in it. A point that is farther from all four corners than one
other point is nearest to none of it, however far the tile is from both. Each row then compares these few. Tiles are about as
many as points. A tile that has more than ``MANY`` such points, as beside a dense cluster, or comes to more than ``BOXES`` boxes of a level, leaves
its positions to be searched one by one.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from gridstone.operators.summarise import global_rank
from gridstone.session import written_once

LEAF, FAN, TOP = 16, 8, 32
MANY, BOXES = 256, 128
_BOX = ("x0", "y0", "x1", "y1")
_CURVE_BITS = 31
# Rows without a position are spread over so many keys.
_NULL_SALTS = 1024


@dataclass(frozen=True)
class NearestIndex:
    """``leaves(id, curve, box, points)``, ``nodes(id, curve, box, children)`` from the highest level down, and
    the boxes of the top. ``curve`` is where a node's stretch of the curve begins; children are in that
    order, numbered on. Points are structs of x, y and place, in the order of places."""

    leaves: DataFrame
    nodes: tuple[DataFrame, ...]
    top: tuple[Row, ...]
    columns: tuple[str, ...]
    max_distance: float
    extent: dict[str, float]


def _spread_bits(c: Column) -> Column:
    """The lowest bits of a number with a zero between each two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def _along_curve(extent: dict[str, float], x: str, y: str) -> Column:
    """Place on the curve; what lies outside the extent is moved to its edge. Both axes have one scale, so that
    a long narrow extent is not cut into splinters."""
    # Halved first: the span of two doubles may exceed a double.
    half = max(extent[f"{c}1"] / 2 - extent[f"{c}0"] / 2 for c in "xy")

    def step(c: str, of: str) -> Column:
        low = extent[f"{c}0"]
        if not half > 0:
            return F.lit(0).cast("long")
        share = F.col(of) / half / 2 - low / half / 2
        return F.floor(F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)) * (2**_CURVE_BITS - 1)).cast("long")

    return _spread_bits(step("x", x)).bitwiseOR(F.shiftleft(_spread_bits(step("y", y)), 1))


def _located(x: Column, y: Column) -> Column:
    return F.coalesce((F.abs(x) < float("inf")) & (F.abs(y) < float("inf")) & ~F.isnan(x) & ~F.isnan(y), F.lit(False))


def build_index(
    right: DataFrame,
    right_xy: tuple[str, str] = ("eastings", "northings"),
    columns: Sequence[str] = ("postcode", "admin_district", "admin_ward"),
    max_distance: float = 5000,
    tie_break: str = "postcode",
) -> NearestIndex:
    """Index reference points for searches up to ``max_distance`` (inclusive).

    Points without finite coordinates are ignored; of several at one position the smallest
    ``tie_break`` value stands for all. Columns the reference lacks are skipped."""
    columns = tuple(c for c in columns if c in right.columns)
    order = [tie_break] if tie_break in right.columns else []
    x, y = (F.col(c).cast("double") for c in right_xy)
    place = F.struct(*[F.col(c).alias(f"k_{c}") for c in order], *[F.col(c) for c in columns])
    if not (order or columns):
        place = F.struct(F.lit(True).alias("found"))
    box = [f(c).alias(f"{c}{k}") for k, f in enumerate((F.min, F.max)) for c in "xy"]
    extent = Observation()
    points = written_once(
        right.select(x.alias("x"), y.alias("y"), place.alias("place")).where(_located(F.col("x"), F.col("y")))
        .groupBy("x", "y").agg(F.min("place").alias("place")).observe(extent, F.count(F.lit(1)).alias("points"), *box), "nearest_points")
    count = extent.get.get("points", 0)
    if not count:
        none = points.select(F.lit(0).cast("long").alias("id"), F.array(F.struct("place", "x", "y")).alias("points"))
        return NearestIndex(none, (), (), columns, float(max_distance), {})

    ranked = global_rank(points.withColumn("curve", _along_curve(extent.get, "x", "y")), [F.asc("curve"), F.asc("x"), F.asc("y")])
    leaves = written_once(
        ranked.withColumn("id", F.expr(f"(rank - 1) div {LEAF}")).groupBy("id")
        .agg(F.min("curve").alias("curve"), *box, F.sort_array(F.collect_list(F.struct("place", "x", "y"))).alias("points")), "nearest_leaves")
    level, nodes, size = leaves, [], -(-count // LEAF)
    while size > TOP:
        spans = [f(f"{a}{k}").alias(f"{a}{k}") for k, f in enumerate((F.min, F.max)) for a in "xy"]
        level = written_once(
            level.select(F.expr(f"id div {FAN}").alias("parent"), "id", "curve", *_BOX).groupBy("parent")
            .agg(F.min("curve").alias("curve"), *spans, F.sort_array(F.collect_list(F.struct("id", "curve", *_BOX))).alias("children")).withColumnRenamed("parent", "id"), "nearest_nodes")
        nodes.append(level)
        size = -(-size // FAN)
    return NearestIndex(leaves, tuple(reversed(nodes)), tuple(sorted(level.select("id", "curve", *_BOX).collect())), columns, float(max_distance), extent.get)


def nearest_join(
    left: DataFrame,
    right: DataFrame | NearestIndex,
    left_xy: tuple[str, str] = ("easting_bng", "northing_bng"),
    right_xy: tuple[str, str] = ("eastings", "northings"),
    right_columns: Sequence[str] = ("postcode", "admin_district", "admin_ward"),
    max_distance: float | None = None,
    tie_break: str = "postcode",
    distance_column: str | None = None,
) -> DataFrame:
    """Left join of the single nearest reference point within ``max_distance``: by default what the
    index was built for, or 5000 m. An index answers any smaller distance.

    Every left row is kept exactly once; without coordinates or match its new columns are null. The left
    side is evaluated once and written, as it is read for its tiles and again for its rows. Every tile is
    searched once, however many rows are in it; rows without a position are spread over many keys."""
    index = right if isinstance(right, NearestIndex) else build_index(
        right, right_xy, right_columns, 5000 if max_distance is None else max_distance, tie_break
    )
    if max_distance is None:
        max_distance = index.max_distance
    if max_distance > index.max_distance:
        raise ValueError(f"the index reaches {index.max_distance} m, not {max_distance} m")
    added = [*index.columns, *([distance_column] if distance_column else [])]
    kept = [F.col(f"`{c}`") for c in left.columns if c not in added]
    x, y = (F.col(f"`{c}`").cast("double") for c in left_xy)
    left = left.select(*kept)
    hashed = [F.col(f"`{f.name}`") for f in left.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    # No tile is negative, so these keys never match; the hash spreads them.
    spread = -1 - F.pmod(F.xxhash64(*hashed), F.lit(_NULL_SALTS))
    located = _located(x, y)
    keyed = left.withColumns({"__x": F.when(located, x), "__y": F.when(located, y)})
    keyed = written_once(keyed.withColumn("__tile", F.coalesce(_tile(index, max_distance), spread)), "nearest_left")
    tiles = written_once(keyed.where("__tile >= 0").groupBy("__tile").agg(
        *[f(f"__{a}").alias(f"__{a}{k}") for k, f in enumerate((F.min, F.max)) for a in "xy"]), "nearest_tiles")
    near = written_once(candidates(tiles, index, max_distance), "nearest_candidates")

    def placed(rows: DataFrame, d2: Column, place: Column) -> DataFrame:
        """The rows with what was found."""
        near_enough = F.sqrt(d2) <= float(max_distance)
        found = [F.when(near_enough, place[c]).alias(c) for c in index.columns]
        return rows.select(*kept, *found, *([F.when(near_enough, F.sqrt(d2)).alias(distance_column)] if distance_column else []))

    def settled(rows: DataFrame) -> DataFrame:
        """The nearest of the candidates: the first in their order, if several are as near."""
        squares = F.transform("__near", lambda p: _squared(F.col("__x") - p["x"], F.col("__y") - p["y"]))
        rows = rows.select(*kept, "__near", _once(squares, "__squares"))
        least = F.array_min("__squares")
        first = F.get("__near", F.array_position("__squares", least).cast("int") - 1)
        rows = rows.select(*kept, F.inline(F.array(F.struct(least.alias("__d2"), first["place"].alias("__place")))))
        return placed(rows, F.col("__d2"), F.col("__place"))

    joined = keyed.join(near, "__tile", "left")
    # Counted in the files: adaptive execution may drop an observation with the rows, if there are none.
    if not index.top or tiles.count() == near.count():
        return settled(joined)
    # Positions of tiles without an answer: dealt anew, lest small partitions are joined to a few tasks.
    # In the order of the grouping that made them distinct, Spark would take this for done.
    left_over = keyed.where("__tile >= 0").join(near.select("__tile"), "__tile", "left_anti")
    best = search(left_over.select("__x", "__y").distinct().repartition(_tasks(left), "__y", "__x"), index, max_distance)
    one_by_one = placed(left_over.join(best, ["__x", "__y"], "left"), F.col("__hit.d2"), F.col("__hit.place"))
    return settled(joined.where("__tile < 0 or __near is not null")).unionAll(one_by_one)


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _squared(dx: Column, dy: Column) -> Column:
    return dx * dx + dy * dy


def _once(value: Column, name: str) -> Column:
    """One-element inline: later filters must not repeat the expression."""
    return F.inline(F.array(F.struct(value.alias(name))))


def _tile(index: NearestIndex, max_distance: float) -> Column:
    """Number of the tile of the position (__x, __y), null without one. About as many tiles as points are dealt
    over the extent; what lies beyond their reach is moved to its edge. No more than four times as many in all."""
    if not index.top:
        return F.when(F.col("__x").isNotNull() & F.col("__y").isNotNull(), F.lit(0).cast("long"))
    per_axis = math.sqrt(index.extent["points"])
    area = math.prod(math.sqrt(max(index.extent[f"{a}1"] - index.extent[f"{a}0"], 0.0)) for a in "xy")

    def step(a: str) -> Column:
        low, high = index.extent[f"{a}0"] - max_distance, index.extent[f"{a}1"] + max_distance
        side = max(area / per_axis, (high - low) / (2 * per_axis)) or 1.0
        return F.floor((F.greatest(F.least(F.col(f"__{a}"), F.lit(high)), F.lit(low)) - low) / side)

    # The bounds of a step do not keep null.
    return F.when(F.col("__x").isNotNull() & F.col("__y").isNotNull(), step("x") * (2 * math.ceil(per_axis) + 2) + step("y"))


def candidates(tiles: DataFrame, index: NearestIndex, max_distance: float) -> DataFrame:
    """``__near array<struct<place, x, y>>`` per tile: every point that is nearest to some place in the box
    (__x0, __y0, __x1, __y1) of the tile, in the order of places. Tiles with none in reach and those with more than ``MANY`` have no row."""
    if not index.top:
        return index.leaves.select(F.col("id").alias("__tile"), F.col("points").alias("__near"))
    box = [f"__{b}" for b in _BOX]
    # Few bytes and much work a tile, see below; the box comes first, as the tile alone would be taken for done.
    # Boxes with corners so far out that squares overflow are left to the search of places.
    finite = reduce(operator.and_, (F.abs(F.col(b)) < 1e100 for b in box))
    dealt = tiles.where(finite).repartition(_tasks(tiles), "__x0", "__tile")
    points = _reached(dealt, ["__tile", *box], box, index, max_distance, BOXES)
    return points.groupBy("__tile", *box).agg(F.sort_array(F.collect_list(F.struct("place", "x", "y"))).alias("__near")).where(F.size("__near") <= MANY).select("__tile", "__near")


def _least(a0: Column, b0: Column, a1: Column, b1: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Smallest squared distance of two boxes."""
    return _squared(F.greatest(a0 - x1, x0 - a1, F.lit(0.0)), F.greatest(b0 - y1, y0 - b1, F.lit(0.0)))


def _most(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Largest squared distance of a point to a place in a box."""
    return _most_along(x, x0, x1) + _most_along(y, y0, y1)


def _most_along(a: Column, low: Column, high: Column) -> Column:
    """Square of the largest distance of a place to one of a stretch."""
    most = F.greatest(a - low, high - a)
    return most * most


def _gap(a: Column, low: Column, high: Column) -> Column:
    """Square of the smallest distance of a place to one of a stretch."""
    gap = F.greatest(low - a, a - high, F.lit(0.0))
    return gap * gap


def search(positions: DataFrame, index: NearestIndex, max_distance: float) -> DataFrame:
    """``__hit struct<d2, place>`` of the nearest point of each distinct position (__x, __y) that has one."""
    at = ["__x", "__y"]
    points = _reached(positions, at, [*at, *at], index, max_distance).select(*at, _squared(F.col("__x") - F.col("x"), F.col("__y") - F.col("y")).alias("d2"), "place")
    hits = points.where(f"sqrt(d2) <= {float(max_distance)!r}D")
    return hits.groupBy(*at).agg(F.min(F.struct("d2", "place")).alias("__hit"))


def _reached(asked: DataFrame, at: list[str], box: list[str], index: NearestIndex, max_distance: float, many: int | None = None) -> DataFrame:
    """The points (place, x, y) that may be nearest to some place in each asked box; ``at`` names the columns
    that stay, ``box`` those of its corners. What comes to more than ``many`` boxes of a level is dropped.

    Boxes and points are rows in the bounded descent: that runs as generated code, which functions on
    arrays do not. Its methods are compiled only while they are small, so few terms are compared.
    ``__side`` is a box in which some point lies, and first how far from the middle at most. How much nearer that point
    is than another changes evenly over the asked box: if it is nearer to all corners, it is to all places.
    The squares of x and of y add up, so the least differences along both axes tell of all corners. Rounding adds less than the slack."""
    x0, y0, x1, y1 = (F.col(c) for c in box)
    middle = (x0 / 2 + x1 / 2, y0 / 2 + y1 / 2)
    # The exact test of the distance is on the root; the square may be off in its last bits.
    reach = F.lit(float(max_distance) ** 2 * (1 + 1e-12))
    top = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("id", "curve", *_BOX)]) for r in index.top])
    levels = [top, *(n.select("id", "children") for n in index.nodes)]
    leaves = index.leaves.select("id", "points")
    together = Window.partitionBy(*at)

    def side(*of: Column) -> Column:
        return F.struct(_most(*middle, *of).alias("m"), *[c.alias(b) for c, b in zip(of, _BOX)])

    def within_reach(*of: Column) -> Column:
        return _least(*of, x0, y0, x1, y1) <= reach

    def inside(*of: Column) -> Column:
        if many is None:  # Places: rounding keeps order, so no slack is needed.
            return _least(*of, x0, y0, x1, y1) <= F.least(F.col("__side.m"), reach)
        (a0, b0, a1, b1), u = of, F.col("__within")
        along_x = F.least(_gap(x0, a0, a1) - u["x0"], _gap(x1, a0, a1) - u["x1"])
        along_y = F.least(_gap(y0, b0, b1) - u["y0"], _gap(y1, b0, b1) - u["y1"])
        return along_x + along_y <= u["slack"]

    def bounded(state: DataFrame, value: Column) -> DataFrame:
        """The rows with ``__side`` and, for boxes, how far it is at most from their edges."""
        state = state.select(*(c for c in state.columns if c not in ("__side", "__within")), _once(value, "__side"))
        if many is not None:
            # Beyond any reach, no infinite squares.
            edges = {c: F.least(_most_along(F.col(b), F.col(f"__side.{c[0]}0"), F.col(f"__side.{c[0]}1")), F.lit(1e300)) for b, c in zip(box, _BOX)}
            state = state.select("*", _once(F.struct(*[e.alias(c) for c, e in edges.items()]), "__within"))
            slack = (F.greatest("__within.x0", "__within.x1") + F.greatest("__within.y0", "__within.y1")) * 1e-12 + 1e-300
            state = state.withColumn("__within", F.struct("__within.*", slack.alias("slack")))
        return state

    def entered(state: DataFrame, boxes: Column | DataFrame, *kept: str) -> DataFrame:
        """The children of the boxes that were come to."""
        if isinstance(boxes, DataFrame):
            state, boxes = state.join(boxes, "id"), F.col("children")
        return state.select(*at, *kept, F.inline(boxes))

    def tightened(state: DataFrame, *sides: tuple[Column, ...]) -> DataFrame:
        """The bound lowered by what stands in the rows of an asked box: each of the sides has a point."""
        own = [side(*s) for s in sides]
        state = state.withColumns({"__own": F.min(F.least(*own) if len(own) > 1 else own[0]).over(together), "__n": F.count(F.lit(1)).over(together)})
        if many is not None and len(sides) > 1:
            state = state.where(f"__n <= {many}")
        return bounded(state, F.least("__side", "__own")).drop("__own", "__n")

    probe = asked.select(*at, middle[0].alias("__mx"), middle[1].alias("__my"))
    probe = probe.select(*at, _along_curve(index.extent, "__mx", "__my").alias("__curve"))
    for boxes in levels:
        if isinstance(boxes, DataFrame):
            probe, boxes = probe.join(boxes, "id"), F.col("children")
        begun = F.size(F.filter(boxes, lambda b: b["curve"] <= F.col("__curve")))
        probe = probe.select(*at, "__curve", _once(F.get(boxes, F.greatest(begun - 1, F.lit(0)))["id"], "id"))
    found = F.array_min(F.transform("points", lambda p: F.struct(_squared(p["x"] - middle[0], p["y"] - middle[1]).alias("d2"), p["x"].alias("x"), p["y"].alias("y"))))
    state = probe.join(leaves, "id").select(*at, _once(found, "__p"))
    state = bounded(state, side(*(F.col(f"__p.{c}") for c in "xyxy"))).drop("__p")
    held = ["__side"] if many is None else ["__side", "__within"]
    left, low, right, high = edges = [F.col(b) for b in _BOX]
    # The sides that are nearer to the middle.
    x, y = (F.when(m - a <= b - m, a).otherwise(b) for m, a, b in zip(middle, edges, edges[2:]))
    for i, boxes in enumerate(levels):
        state = entered(state, boxes, *held).where(inside(*edges))
        state = state.select(*at, *held, "id", *_BOX) if i else state.where(within_reach(*edges)).select(*at, *held, "id", *_BOX)
        state = tightened(state, (x, low, x, high), (left, y, right, y)).where(inside(*edges)).select(*at, *held, "id")
    spot = [F.col(c) for c in "xyxy"]
    points = state.join(leaves, "id").select(*at, *held, F.inline("points")).where(inside(*spot) & within_reach(*spot))
    if many is not None:
        points = tightened(points, tuple(spot)).where(inside(*spot))
    return points.select(*at, "place", "x", "y")
