"""Geospatial expressions: projection to the metric grid, repair, length, cells.

The projection is a chain of small stages. Each stage reads the named results of
earlier ones, so the same stages run in two ways:

* :func:`with_bng` lays them out as consecutive projections of a DataFrame. They all
  compile into one generated loop. The last step hands the two results over through a
  one-element ``inline``, because filters and inferred not-null checks are pushed
  through plain projections by substituting every alias, which would multiply the
  expression; they stop at a generator.
* :func:`bng_point` binds them inside a single column for use within arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstone import constants as K

GEOMETRY_TYPE = "array<struct<lat:double,lon:double>>"

Stage = Callable[[Callable[[str], Column]], dict[str, Column]]

# Derived once from the published constants.
_WGS84_E2 = K.WGS84_F * (2 - K.WGS84_F)
_AIRY_E2 = 1 - (K.AIRY_B / K.AIRY_A) ** 2
_AIRY_EP2 = (K.AIRY_A / K.AIRY_B) ** 2 - 1
_AIRY_E = math.sqrt(_AIRY_E2)
_N = (K.AIRY_A - K.AIRY_B) / (K.AIRY_A + K.AIRY_B)
_RX, _RY, _RZ = (math.radians(s / 3600) for s in K.HELMERT_ROTATION_ARCSEC)
_TX, _TY, _TZ = K.HELMERT_TRANSLATION_M
_M = 1 + K.HELMERT_SCALE_PPM * 1e-6
_RECTIFYING = K.GRID_SCALE * K.AIRY_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
_SIN_L0 = math.sin(math.radians(K.GRID_LON0))
_COS_L0 = math.cos(math.radians(K.GRID_LON0))


def _origin_northing() -> float:
    s = math.sin(math.radians(K.GRID_LAT0))
    xi = math.atan(math.sinh(math.atanh(s) - _AIRY_E * math.atanh(_AIRY_E * s)))
    series = sum(a * math.sin(2 * j * xi) for j, a in enumerate(_ALPHA, 1))
    return K.GRID_FALSE_NORTHING - _RECTIFYING * (xi + series)


_NORTHING_0 = _origin_northing()


def _angles(get) -> dict[str, Column]:
    lat, lon = F.radians(get("lat")), F.radians(get("lon"))
    return {"sp": F.sin(lat), "cp": F.cos(lat), "sl": F.sin(lon), "cl": F.cos(lon)}


def _cartesian(get) -> dict[str, Column]:
    nu = F.lit(K.WGS84_A) / F.sqrt(1 - _WGS84_E2 * get("sp") * get("sp"))
    return {
        "dx": nu * get("cp") * get("cl") - _TX,
        "dy": nu * get("cp") * get("sl") - _TY,
        "dz": nu * (1 - _WGS84_E2) * get("sp") - _TZ,
    }


def _helmert(get) -> dict[str, Column]:
    dx, dy, dz = get("dx"), get("dy"), get("dz")
    return {
        "x": (dx + _RZ * dy - _RY * dz) / _M,
        "y": (dy - _RZ * dx + _RX * dz) / _M,
        "z": (dz + _RY * dx - _RX * dy) / _M,
    }


def _parametric(get) -> dict[str, Column]:
    p = F.sqrt(get("x") * get("x") + get("y") * get("y"))
    return {"p": p, "tb": get("z") * K.AIRY_A / (p * K.AIRY_B)}


def _geodetic(get) -> dict[str, Column]:
    # Bowring's closed form for the latitude on the Airy ellipsoid, kept as a ratio.
    cos_b = 1 / F.sqrt(1 + get("tb") * get("tb"))
    sin_b = get("tb") * cos_b
    return {
        "num": get("z") + _AIRY_EP2 * K.AIRY_B * sin_b * sin_b * sin_b,
        "den": get("p") - _AIRY_E2 * K.AIRY_A * cos_b * cos_b * cos_b,
        "sd": (get("y") * _COS_L0 - get("x") * _SIN_L0) / get("p"),
        "cd": (get("x") * _COS_L0 + get("y") * _SIN_L0) / get("p"),
    }


def _sine_latitude(get) -> dict[str, Column]:
    return {"s": get("num") / F.sqrt(get("num") * get("num") + get("den") * get("den"))}


def _conformal(get) -> dict[str, Column]:
    return {"t": F.sinh(F.atanh(get("s")) - _AIRY_E * F.atanh(_AIRY_E * get("s")))}


def _spherical_tm(get) -> dict[str, Column]:
    return {
        "xi": F.atan2(get("t"), get("cd")),
        "eta": F.atanh(get("sd") / F.sqrt(1 + get("t") * get("t"))),
    }


def _grid(get) -> dict[str, Column]:
    e, n = get("eta"), get("xi")
    for j, a in enumerate(_ALPHA, 1):
        e = e + a * F.cos(2 * j * get("xi")) * F.sinh(2 * j * get("eta"))
        n = n + a * F.sin(2 * j * get("xi")) * F.cosh(2 * j * get("eta"))
    return {
        "e": K.GRID_FALSE_EASTING + _RECTIFYING * e,
        "n": _NORTHING_0 + _RECTIFYING * n,
    }


_STAGES: tuple[Stage, ...] = (
    _angles, _cartesian, _helmert, _parametric, _geodetic,
    _sine_latitude, _conformal, _spherical_tm, _grid,
)


# Results read by a stage other than the next one.
_READ_LATER = {"x", "y", "z", "p", "sd", "cd"}


def _usable(lat: Column, lon: Column) -> Column:
    """Latitude and longitude are present numbers on the globe (NaN compares high)."""
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def _whole(metres: Column) -> Column:
    return F.rint(metres).try_cast("long")


def with_bng(
    df: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    easting: str = "easting_bng",
    northing: str = "northing_bng",
    drop_original: bool = False,
) -> DataFrame:
    """Add whole-metre British National Grid coordinates; null when either input is."""
    keep = [c for c in df.columns if c not in (easting, northing)]
    if drop_original:
        keep = [c for c in keep if c not in (lat, lon)]

    def slot(name: str) -> str:
        return f"__bng_{name}"

    def get(name: str) -> Column:
        return F.col(slot(name))

    ok = _usable(F.col(lat), F.col(lon))
    out = df.withColumns({
        slot("lat"): F.when(ok, F.col(lat).cast("double")),
        slot("lon"): F.when(ok, F.col(lon).cast("double")),
    })
    for stage in _STAGES:
        out = out.withColumns({slot(k): c for k, c in stage(get).items()})
    point = F.struct(_whole(get("e")).alias(easting), _whole(get("n")).alias(northing))
    return out.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(point)))


def bng_point(lat: Column, lon: Column) -> Column:
    """Unrounded grid coordinates as ``struct<e,n>``; usable inside array lambdas."""
    bound = F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))
    known: list[str] = []
    for stage in _STAGES:
        made = list(stage(lambda _: F.lit(0.0)))
        bound = F.transform(F.array(bound), _binder(stage, [k for k in known if k not in made]))[0]
        known = [k for k in [*known, *made] if k in _READ_LATER]
    return bound


def _binder(stage: Stage, carried: list[str]) -> Callable[[Column], Column]:
    def bind(s: Column) -> Column:
        fresh = stage(lambda k: s.getField(k))
        return F.struct(*[s.getField(k).alias(k) for k in carried], *[c.alias(k) for k, c in fresh.items()])

    return bind


def parse_geometry(geometry_json: Column) -> Column:
    """JSON vertex list to an array; null on bad JSON or when any vertex lacks a number."""
    whole = F.filter(
        F.array(F.from_json(geometry_json, GEOMETRY_TYPE)),
        lambda g: ~F.exists(g, lambda v: v["lat"].isNull() | v["lon"].isNull()),
    )
    return F.get(whole, F.lit(0))


def centroid(geom: Column) -> Column:
    """Mean vertex of a parsed geometry as ``struct<lat,lon>``; null when empty."""
    n = F.size(geom)

    def mean(axis: str) -> Column:
        return F.aggregate(geom, F.lit(0.0), lambda acc, v: acc + v[axis]) / n

    return F.when(n > 0, F.struct(mean("lat").alias("lat"), mean("lon").alias("lon")))


def repair_point(lat: Column, lon: Column, geom: Column, first_lat: Column, first_lon: Column) -> Column:
    """Point of an element as ``struct<lat,lon>``: its own, else the centroid, else the first vertex."""
    first = F.when(first_lat.isNotNull(), F.struct(first_lat.alias("lat"), first_lon.alias("lon")))
    own = F.struct(lat.alias("lat"), lon.alias("lon"))
    return F.when(lat.isNotNull(), own).otherwise(F.coalesce(centroid(geom), first))


def line_length(geom: Column) -> Column:
    """Length in metres along the projected vertices; null below two vertices."""
    pts = F.transform(geom, lambda v: bng_point(v["lat"], v["lon"]))
    walked = F.aggregate(
        pts,
        F.struct(F.lit(0.0).alias("d"), F.lit(None).cast("struct<e:double,n:double>").alias("at")),
        lambda acc, v: F.struct(
            (acc["d"] + F.coalesce(distance(acc["at"]["e"], acc["at"]["n"], v["e"], v["n"]), F.lit(0.0))).alias("d"),
            F.struct(v["e"].alias("e"), v["n"].alias("n")).alias("at"),
        ),
        lambda acc: acc["d"],
    )
    return F.when(F.size(geom) >= 2, walked)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def within_bbox(lat: Column, lon: Column, bbox: dict = K.BBOX) -> Column:
    """Inclusive bounding-box test; a missing coordinate is outside."""
    inside = lat.between(bbox["lat_min"], bbox["lat_max"]) & lon.between(bbox["lon_min"], bbox["lon_max"])
    return F.coalesce(inside, F.lit(False))


def cell_index(coord: Column, size: float) -> Column:
    """Cell number along one axis, truncating towards zero."""
    return (coord / F.lit(float(size))).cast("int")


def with_grid_cell(
    df: DataFrame, size: int, easting: str = "easting_bng", northing: str = "northing_bng"
) -> DataFrame:
    """Add cell indices, the ``E{x}N{y}`` id and the cell centre."""
    half = size / 2
    return df.withColumns({
        "grid_cell_x": cell_index(F.col(easting), size),
        "grid_cell_y": cell_index(F.col(northing), size),
    }).withColumns({
        "grid_cell_id": F.concat(F.lit("E"), F.col("grid_cell_x"), F.lit("N"), F.col("grid_cell_y")),
        "grid_center_easting": F.col("grid_cell_x") * size + F.lit(half),
        "grid_center_northing": F.col("grid_cell_y") * size + F.lit(half),
    })


def regrid(coord: Column, size: int, anchor: str = "corner") -> Column:
    """Snap a finer cell's coordinate to the coarser cell's corner or centre."""
    corner = cell_index(coord, size) * size
    return corner if anchor == "corner" else corner + F.lit(size / 2)


def density_per_km2(count: Column, size: int) -> Column:
    return count / F.lit((size / 1000) ** 2)


def sample_grid(spark, bbox: dict = K.BBOX, n: int = 3) -> DataFrame:
    """Centres of an n x n split of the bounding box, row by row from the south-west."""
    lat_step = (bbox["lat_max"] - bbox["lat_min"]) / n
    lon_step = (bbox["lon_max"] - bbox["lon_min"]) / n
    row, col = F.expr(f"id div {n}"), F.expr(f"id % {n}")
    return spark.range(n * n).select(
        row.cast("int").alias("grid_row"),
        col.cast("int").alias("grid_col"),
        (bbox["lat_min"] + (row + 0.5) * lat_step).alias("lat"),
        (bbox["lon_min"] + (col + 0.5) * lon_step).alias("lon"),
    )
