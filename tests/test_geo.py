import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from fixtures import FULL_POSTCODES
from gridstone import constants as K
from gridstone.functions import geo


def redfearn(lat, lon):
    """Independent series projection, in plain Python."""
    def cartesian(a, e2):
        nu = a / math.sqrt(1 - e2 * math.sin(lat) ** 2)
        return nu * math.cos(lat) * math.cos(lon), nu * math.cos(lat) * math.sin(lon), nu * (1 - e2) * math.sin(lat)

    lat, lon = math.radians(lat), math.radians(lon)
    x, y, z = cartesian(K.WGS84_A, K.WGS84_F * (2 - K.WGS84_F))
    tx, ty, tz = K.HELMERT_TRANSLATION_M
    rx, ry, rz = (math.radians(s / 3600) for s in K.HELMERT_ROTATION_ARCSEC)
    m = 1 + K.HELMERT_SCALE_PPM * 1e-6
    x, y, z = x - tx, y - ty, z - tz
    x, y, z = (x + rz * y - ry * z) / m, (y - rz * x + rx * z) / m, (z + ry * x - rx * y) / m
    a, b = K.AIRY_A, K.AIRY_B
    e2 = 1 - b * b / (a * a)
    p, phi = math.hypot(x, y), math.atan2(z, math.hypot(x, y) * (1 - e2))
    for _ in range(10):
        phi = math.atan2(z + e2 * a / math.sqrt(1 - e2 * math.sin(phi) ** 2) * math.sin(phi), p)
    lam, phi0, lam0, f0 = math.atan2(y, x), math.radians(K.GRID_LAT0), math.radians(K.GRID_LON0), K.GRID_SCALE
    n = (a - b) / (a + b)
    s2 = 1 - e2 * math.sin(phi) ** 2
    nu, rho = a * f0 / math.sqrt(s2), a * f0 * (1 - e2) / s2**1.5
    eta2 = nu / rho - 1
    d, t = phi - phi0, phi + phi0
    arc = b * f0 * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * d - (3 * n + 3 * n**2 + 21 / 8 * n**3) * math.sin(d) * math.cos(t)
        + (15 / 8 * n**2 + 15 / 8 * n**3) * math.sin(2 * d) * math.cos(2 * t) - 35 / 24 * n**3 * math.sin(3 * d) * math.cos(3 * t)
    )
    c, tan, w = math.cos(phi), math.tan(phi), lam - lam0
    sin = math.sin(phi)
    north = (
        arc + K.GRID_FALSE_NORTHING + nu / 2 * sin * c * w**2 + nu / 24 * sin * c**3 * (5 - tan**2 + 9 * eta2) * w**4
        + nu / 720 * sin * c**5 * (61 - 58 * tan**2 + tan**4) * w**6
    )
    east = (
        K.GRID_FALSE_EASTING + nu * c * w + nu / 6 * c**3 * (nu / rho - tan**2) * w**3
        + nu / 120 * c**5 * (5 - 18 * tan**2 + tan**4 + 14 * eta2 - 58 * tan**2 * eta2) * w**5
    )
    return east, north


def test_projection_matches_published_grid_coordinates(spark):
    df = spark.createDataFrame(FULL_POSTCODES, "postcode string, lat double, lon double, e long, n long")
    for row in geo.with_bng(df).collect():
        assert abs(row.easting_bng - row.e) <= 3 and abs(row.northing_bng - row.n) <= 3


def test_projection_matches_independent_series(spark):
    points = [(50.1 + 0.83 * i, -5.9 + 0.71 * (i % 10)) for i in range(10)]
    got = spark.createDataFrame(points, "lat double, lon double").select(
        "lat", "lon", geo.bng_point(F.col("lat"), F.col("lon")).alias("p")
    ).collect()
    for row in got:
        e, n = redfearn(row.lat, row.lon)
        assert row.p.e == pytest.approx(e, abs=0.01) and row.p.n == pytest.approx(n, abs=0.01)


def test_both_forms_of_the_projection_agree(spark):
    df = spark.createDataFrame([(53.4, -2.15), (51.5, -0.1), (57.1, -4.2)], "lat double, lon double")
    rows = geo.with_bng(df.withColumn("p", geo.bng_point(F.col("lat"), F.col("lon")))).collect()
    assert all(r.easting_bng == round(r.p.e) and r.northing_bng == round(r.p.n) for r in rows)


def test_missing_and_impossible_coordinates_project_to_null(spark):
    rows = [(None, -2.0), (53.0, None), (float("nan"), -2.0), (95.0, -2.0), (53.0, 200.0), (53.0, -2.0)]
    out = geo.with_bng(spark.createDataFrame(rows, "lat double, lon double")).collect()
    assert [r.easting_bng is None for r in out] == [True] * 5 + [False]
    assert [r.northing_bng is None for r in out] == [True] * 5 + [False]


def test_projection_is_one_generated_stage_without_python(spark):
    df = geo.with_bng(spark.range(10).select((53 + F.col("id") / 100).alias("lat"), F.lit(-2.0).alias("lon")))
    filtered = df.where("easting_bng > 390000 and northing_bng is not null")
    plan = plan_of(filtered)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("ATAN2") == 1  # the filter did not copy the expression


def test_drop_original(spark):
    df = spark.createDataFrame([(1, 53.4, -2.1)], "id int, lat double, lon double")
    assert geo.with_bng(df, drop_original=True).columns == ["id", "easting_bng", "northing_bng"]


def _geometry(spark, text):
    geom = geo.parse_geometry(F.col("g"))
    return spark.createDataFrame([(text,)], "g string").select(geo.centroid(geom).alias("c"), geo.line_length(geom).alias("d")).first()


def test_centroid_and_length(spark):
    row = _geometry(spark, '[{"lat":53.40,"lon":-2.15},{"lat":53.41,"lon":-2.15},{"lat":53.41,"lon":-2.16}]')
    assert row.c.lat == pytest.approx((53.40 + 53.41 + 53.41) / 3) and row.c.lon == pytest.approx(-2.46 + 0.3066666666)
    legs = [redfearn(53.40, -2.15), redfearn(53.41, -2.15), redfearn(53.41, -2.16)]
    assert row.d == pytest.approx(math.dist(*legs[:2]) + math.dist(*legs[1:]), abs=0.01)


@pytest.mark.parametrize("text", [None, "oops", "[]", '[{"lat":1}]', '[{"lat":53.4,"lon":-2.1},{"lat":53.4}]', "{}", '[{"lat": 53.4'])
def test_unusable_geometry_has_no_centroid_and_length(spark, text):
    assert _geometry(spark, text) == (None, None)


def test_single_vertex_has_a_centroid_but_no_length(spark):
    row = _geometry(spark, '[{"lat":53.4,"lon":-2.1}]')
    assert row.c.lat == 53.4 and row.d is None


def test_repair_takes_both_coordinates_from_one_source(spark):
    rows = [
        (1.0, None, '[{"lat":5.0,"lon":6.0}]', 7.0, 8.0),   # latitude present: untouched
        (None, 2.0, '[{"lat":5.0,"lon":6.0}]', 7.0, 8.0),   # centroid
        (None, 2.0, "broken", 7.0, 8.0),                     # first vertex
        (None, 2.0, None, None, None),                       # nothing left
    ]
    df = spark.createDataFrame(rows, "lat double, lon double, g string, fa double, fo double")
    p = geo.repair_point(F.col("lat"), F.col("lon"), geo.parse_geometry(F.col("g")), F.col("fa"), F.col("fo"))
    got = [(r.p.lat, r.p.lon) if r.p else (None, None) for r in df.select(p.alias("p")).collect()]
    assert got == [(1.0, None), (5.0, 6.0), (7.0, 8.0), (None, None)]


def test_bbox_is_inclusive_and_null_is_outside(spark):
    rows = [(53.35, -2.20), (53.45, -2.05), (53.3499999, -2.1), (53.4, None), (None, None)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    got = [r[0] for r in df.select(geo.within_bbox(F.col("lat"), F.col("lon"))).collect()]
    assert got == [True, True, False, False, False]


def test_grid_cells_truncate_and_carry_nulls(spark):
    df = spark.createDataFrame([(389590, 390362), (-1500, 999), (None, 5)], "easting_bng long, northing_bng long")
    rows = geo.with_grid_cell(df, 1000).collect()
    assert (rows[0].grid_cell_id, rows[0].grid_center_easting, rows[0].grid_center_northing) == ("E389N390", 389500.0, 390500.0)
    assert (rows[1].grid_cell_x, rows[1].grid_cell_y) == (-1, 0)
    assert rows[2].grid_cell_id is None


def test_regrid_anchors(spark):
    row = spark.range(1).select(
        geo.regrid(F.lit(389250.0), 1000).alias("corner"), geo.regrid(F.lit(389250.0), 1000, "center").alias("center")
    ).first()
    assert (row.corner, row.center) == (389000, 389500.0)


def test_sample_grid_is_row_major_from_the_south_west(spark):
    rows = geo.sample_grid(spark, {"lat_min": 0.0, "lat_max": 3.0, "lon_min": 0.0, "lon_max": 6.0}, 3).orderBy("grid_row", "grid_col").collect()
    assert len(rows) == 9 and (rows[0].lat, rows[0].lon) == (0.5, 1.0) and (rows[8].lat, rows[8].lon) == (2.5, 5.0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=1, max_size=20))
def test_cell_centres_are_half_a_cell_from_their_points(spark, points):
    df = spark.createDataFrame(points, "easting_bng double, northing_bng double")
    for r in geo.with_grid_cell(df, 500).collect():
        # The cells around zero are cut towards it, hence up to one and a half half-cells away.
        assert abs(r.grid_center_easting - r.easting_bng) <= 750 and abs(r.grid_center_northing - r.northing_bng) <= 750
