import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import plan_of
from gridstone.operators import nearest
from gridstone.operators.nearest import build_index, nearest_join

LEFT = "id long, easting_bng double, northing_bng double"
RIGHT = "postcode string, admin_district string, eastings double, northings double"


def brute(left, right, limit):
    out = {}
    for i, x, y in left:
        best = None
        if x is not None and y is not None:
            for pc, _, e, n in right:
                if e is None or n is None:
                    continue
                d2 = (x - e) ** 2 + (y - n) ** 2
                if math.sqrt(d2) <= limit and (best is None or (d2, pc) < best):
                    best = (d2, pc)
        out[i] = best[1] if best else None
    return out


def run(spark, left, right, limit):
    joined = nearest_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), max_distance=limit)
    rows = joined.collect()
    assert len(rows) == len(left)
    return {r.id: r.postcode for r in rows}


@pytest.fixture(params=["broadcast", "shuffled"])
def path(request, monkeypatch, spark):
    """Joins as Spark chooses them for small tables, and for tables too large to broadcast, with a deep tree."""
    if request.param == "shuffled":
        for name, size in (("LEAF", 3), ("FAN", 2), ("TOP", 4)):
            monkeypatch.setattr(nearest, name, size)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _spread(n, step, span):
    return [float((i * step) % span) for i in range(n)]


@pytest.mark.parametrize("limit", [50, 400, 3000])
def test_equals_brute_force(spark, path, limit):
    xs, ys = _spread(300, 7919, 4001), _spread(300, 104729, 4003)
    left = [(i, x, y) for i, (x, y) in enumerate(zip(xs, ys))]
    rx, ry = _spread(120, 6101, 4001), _spread(120, 3571, 4003)
    right = [(f"P{i:04d}", "D", x, y) for i, (x, y) in enumerate(zip(rx, ry))]
    assert run(spark, left, right, limit) == brute(left, right, limit)


def test_clusters_of_any_density(spark, path):
    """Points that differ in the last bits, a millimetre grid, and some far apart; queries far and near."""
    close, right = 1000.0, []
    for i in range(80):
        right.append((f"B{i:04d}", "D", close, 1000.0))
        close = math.nextafter(close, math.inf)
    right += [(f"M{i:04d}", "D", 1500.0 + i % 25 / 1000, 1500.0 + i // 25 / 1000) for i in range(400)]
    right += [(f"F{i:04d}", "D", float((i * 977) % 9001), float((i * 3571) % 9007)) for i in range(60)]
    left = [(i, float((i * 37) % 2500), float((i * 53) % 2500)) for i in range(200)]
    left += [(500 + i, right[i * 7][2], right[i * 7][3]) for i in range(60)] + [(900, 1500.0105, 1500.0042), (901, -1e12, 1e150), (902, 1500.0, float("inf"))]
    assert run(spark, left, right, 2000) == brute(left, right, 2000)


def test_every_point_is_stored_once(spark):
    right = [(f"C{i:05d}", "D", 100.0 + i % 50 / 1e3, 100.0 + i // 50 / 1e6) for i in range(5000)] + [("X", "D", 100.0, 100.0), ("Y", "D", 9e5, 1e6)]
    index = build_index(spark.createDataFrame(right, RIGHT), max_distance=5000)
    stored = index.leaves.selectExpr("sum(size(points)) n", "max(size(points)) m").first()
    assert stored.n == 5001 and stored.m <= nearest.LEAF
    assert len(index.top) <= nearest.TOP and len(index.nodes) == 2
    assert sum(n.selectExpr("sum(size(children)) s").first().s for n in index.nodes) < 5001 / 8


def test_the_left_side_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    left = spark.createDataFrame([(i, float(i), 0.0) for i in range(100)], LEFT).mapInArrow(watched, LEFT)
    out = nearest_join(left, spark.createDataFrame([("A", "D", 0.0, 0.0)], RIGHT), max_distance=10)
    assert sum(r.postcode == "A" for r in out.collect()) == 11 and out.count() == 100 and seen.value == 100


def test_limit_is_inclusive_and_ties_take_the_smaller_code(spark, path):
    right = [("B", "D", 100.0, 0.0), ("A", "D", -100.0, 0.0), ("C", "D", 0.0, 1000.0)]
    left = [(1, 0.0, 0.0), (2, 0.0, 900.0), (3, 0.0, 899.0), (4, 200.0, 0.0), (5, 201.0, 0.0)]
    assert run(spark, left, right, 100) == {1: "A", 2: "C", 3: None, 4: "B", 5: None}


def test_missing_positions(spark, path):
    right = [("A", "D", 0.0, 0.0), ("N", "D", None, 0.0), ("M", "D", float("nan"), 0.0)]
    left = [(1, None, 0.0), (2, 0.0, None), (3, 1.0, 1.0), (4, float("nan"), 1.0)]
    joined = run(spark, left, right, 100)
    assert joined == {1: None, 2: None, 3: "A", 4: None}


def test_repeated_positions_and_repeated_reference(spark, path):
    right = [("B", "D", 5.0, 5.0), ("A", "D", 5.0, 5.0)] * 3
    left = [(i, 4.0, 4.0) for i in range(50)]
    assert set(run(spark, left, right, 10).values()) == {"A"}


def test_empty_sides(spark, path):
    assert run(spark, [(1, 0.0, 0.0)], [("A", "D", None, None)], 100) == {1: None}


def test_absent_columns_are_skipped_and_distance_is_optional(spark, path):
    left = spark.createDataFrame([(1, 3.0, 4.0)], LEFT)
    right = spark.createDataFrame([("A", "D", 0.0, 0.0)], RIGHT)
    out = nearest_join(left, right, max_distance=10, right_columns=("postcode", "no_such"), distance_column="metres")
    assert out.columns == ["id", "easting_bng", "northing_bng", "postcode", "metres"]
    assert out.first().metres == 5.0


@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300)), min_size=1, max_size=40),
    st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300)), min_size=1, max_size=40),
    st.integers(1, 400),
)
def test_random_points_equal_brute_force(spark, left, right, limit):
    lefts = [(i, float(x), float(y)) for i, (x, y) in enumerate(left)]
    rights = [(f"P{i:03d}", "D", float(x), float(y)) for i, (x, y) in enumerate(right)]
    assert run(spark, lefts, rights, limit) == brute(lefts, rights, limit)


@pytest.mark.parametrize("many", [1, 6, 256])
def test_positions_of_a_tile_share_their_candidates(spark, monkeypatch, many):
    """Ties, a dense cluster and positions beyond the extent, with few, some and all tiles answered as a whole."""
    monkeypatch.setattr(nearest, "MANY", many)
    right = [(f"P{i:03d}", "D", float(i % 20 * 10), float(i // 20 * 10)) for i in range(399, -1, -1)]
    right += [(f"C{i:02d}", "D", 95.0 + i / 1e4, 95.0) for i in range(60)]
    left = [(i, float((i * 37) % 401 - 100), float((i * 53) % 411 - 100)) for i in range(500)]
    left += [(500 + i, 5.0 + i % 19 * 10, 5.0 + i // 19 * 10) for i in range(60)] + [(600, None, 1.0), (601, 1e9, -1e9), (602, 95.00305, 95.0)]
    assert run(spark, left, right, 60) == brute(left, right, 60)


def test_no_tile_without_a_position(spark):
    """Rows without a position are spread; a tile would gather them."""
    index = build_index(spark.createDataFrame([(f"P{i}", "D", float(i), float(i % 7)) for i in range(50)], RIGHT))
    rows = spark.createDataFrame([(None, None), (1.0, None), (None, 1.0), (1.0, 1.0), (1e300, -1e300)], "__x double, __y double")
    assert [r[0] is None for r in rows.select(nearest._tile(index, 5000)).collect()] == [True, True, True, False, False]


def test_a_tile_is_searched_once(spark):
    """The descent begins with a row a tile, not one a position."""
    right = [(f"P{i:03d}", "D", float(i % 20), float(i // 20)) for i in range(400)]
    index = build_index(spark.createDataFrame(right, RIGHT), max_distance=5000)
    boxes = spark.createDataFrame([(i, i % 20 - 0.3, i // 20 - 0.3, i % 20 + 0.3, i // 20 + 0.3) for i in range(400)], "__tile long, __x0 double, __y0 double, __x1 double, __y1 double")
    lists = {r[0]: {p.place.postcode for p in r[1]} for r in nearest.candidates(boxes, index, 5000).collect()}
    assert len(lists) == 400 and all(f"P{i:03d}" in found and len(found) <= 9 for i, found in lists.items())


def _grid(name, n, x, y):
    """Points of a millimetre grid, forty to a row."""
    return [(f"{name}{i:05d}", "D", x + i % 40 / 1e3, y + i // 40 / 1e3) for i in range(n)]


def test_a_tile_far_from_a_cluster_has_few_candidates(spark):
    """All of the cluster is about as far as the tile is wide; still only points at its corners are nearest."""
    right = _grid("A", 6000, 0.0, 0.0)
    index = build_index(spark.createDataFrame(right, RIGHT), max_distance=9000)
    at = [(3000.0, 3000.0), (-3000.0, 2000.0), (-2000.0, -3000.0), (3000.0, -10.0), (8900.0, 8900.0)]
    boxes = spark.createDataFrame([(i, x, y, x + 9.5, y + 9.5) for i, (x, y) in enumerate(at)], "__tile long, __x0 double, __y0 double, __x1 double, __y1 double")
    found = {r[0]: [p.place.postcode for p in r[1]] for r in nearest.candidates(boxes, index, 9000).collect()}
    assert found[0] == ["A05999"] and found[1] == ["A05960"] and found[2] == ["A00000"] and "A00039" in found[3] and 4 not in found
    left = [(i, x + j % 5 * 2, y + j // 5 * 2) for j in range(25) for i, (x, y) in enumerate(at, 5 * j)]
    assert run(spark, left, right, 9000) == brute(left, right, 9000)


def test_a_far_cluster_is_not_gone_through(spark):
    """The stretch of the curve leads to the wrong one of two clusters; the boxes on the way correct that."""
    right = _grid("A", 4000, 0.0, 0.0) + _grid("B", 4001, 0.0, 2500.0)
    index = build_index(spark.createDataFrame(right, RIGHT), max_distance=9000)
    left = [(i, x, y) for i, (x, y) in enumerate((x + 7.0 * j, y) for j in range(4) for x in (3000.0, -3000.0) for y in (1200.0, 1300.0, 1800.0, 2450.0, 4000.0))]
    positions = spark.createDataFrame([(x, y) for _, x, y in left], "__x double, __y double")
    assert nearest._reached(positions, ["__x", "__y"], ["__x", "__y"] * 2, index, 9000).count() < 16 * len(left)
    hits = {(r["__x"], r["__y"]): r["__hit"].place.postcode for r in nearest.search(positions, index, 9000).collect()}
    assert hits == {(x, y): code for (_, x, y), code in zip(left, brute(left, right, 9000).values())}


def test_no_position_in_reach(spark):
    assert run(spark, [(0, 197.0, 215.0)], [("A", "D", 20.0, 132.0)], 1) == {0: None}


def test_no_nested_loops(spark, path):
    left = spark.createDataFrame([(1, 3.0, 4.0)], LEFT)
    right = spark.createDataFrame([("A", "D", 0.0, 0.0)], RIGHT)
    plan = plan_of(nearest_join(left, right, max_distance=10))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "EvalPython" not in plan
