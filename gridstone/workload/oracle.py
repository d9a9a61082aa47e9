"""Reference SQL: common table expressions that restate each step for DuckDB."""

from __future__ import annotations

import math

from gridstone import constants as K
from gridstone.workload.views import TABLES, VIEWS


def stable(expr: str) -> str:
    """Rounded to six places, nudged so that exact ties fall the same way everywhere."""
    return f"round({expr} + 1e-9, 6)"


def _projection() -> dict[str, float]:
    n = (K.AIRY_A - K.AIRY_B) / (K.AIRY_A + K.AIRY_B)
    e2 = 1 - (K.AIRY_B / K.AIRY_A) ** 2
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = math.sqrt(e2)
    r = K.GRID_SCALE * K.AIRY_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    s = math.sin(math.radians(K.GRID_LAT0))
    xi = math.atan(math.sinh(math.atanh(s) - e * math.atanh(e * s)))
    north = K.GRID_FALSE_NORTHING - r * (xi + sum(a * math.sin(2 * j * xi) for j, a in enumerate(alpha, 1)))
    return {
        "a": K.WGS84_A, "we2": K.WGS84_F * (2 - K.WGS84_F), "aa": K.AIRY_A, "ab": K.AIRY_B, "e2": e2, "e": e,
        "ep2": (K.AIRY_A / K.AIRY_B) ** 2 - 1, "r": r, "north": north, "a1": alpha[0], "a2": alpha[1], "a3": alpha[2],
        "m": 1 + K.HELMERT_SCALE_PPM * 1e-6,
        **{f"t{i}": v for i, v in enumerate(K.HELMERT_TRANSLATION_M)},
        **{f"r{i}": math.radians(v / 3600) for i, v in enumerate(K.HELMERT_ROTATION_ARCSEC)},
        "lon0": K.GRID_LON0, "east": K.GRID_FALSE_EASTING,
    }


def projected(source: str, key: str) -> dict[str, str]:
    """CTEs ending in ``{source}_bng(key, e, n)`` for ``source(key, lat, lon)``; metres unrounded.

    Latitude is found by fixed-point iteration here, in closed form in the library."""
    c = {k: f"({v!r}::double)" for k, v in _projection().items()}
    p = f"{source}_g"
    steps = {
        f"{p}1": f"select {key}, sin(radians(lat)) sp, cos(radians(lat)) cp, sin(radians(lon)) sl, cos(radians(lon)) cl "
                 f"from {source} where lat is not null and lon is not null",
        f"{p}2": f"select {key}, {c['a']} / sqrt(1 - {c['we2']} * sp * sp) nu, sp, cp, sl, cl from {p}1",
        f"{p}3": f"select {key}, nu * cp * cl - {c['t0']} dx, nu * cp * sl - {c['t1']} dy, "
                 f"nu * (1 - {c['we2']}) * sp - {c['t2']} dz from {p}2",
        f"{p}4": f"select {key}, (dx + {c['r2']} * dy - {c['r1']} * dz) / {c['m']} x, "
                 f"(dy - {c['r2']} * dx + {c['r0']} * dz) / {c['m']} y, "
                 f"(dz + {c['r1']} * dx - {c['r0']} * dy) / {c['m']} z from {p}3",
        f"{p}5": f"select {key}, sqrt(x * x + y * y) p, z, atan2(y, x) - radians({c['lon0']}) dl from {p}4",
        f"{p}6": f"select {key}, p, z, dl, atan2(z, p * (1 - {c['e2']})) phi from {p}5",
    }
    last = f"{p}6"
    for i in range(6):
        name = f"{p}i{i}"
        steps[name] = (
            f"select {key}, p, z, dl, atan2(z + {c['e2']} * {c['aa']} / sqrt(1 - {c['e2']} * sin(phi) * sin(phi)) "
            f"* sin(phi), p) phi from {last}"
        )
        last = name
    steps |= {
        f"{p}7": f"select {key}, dl, sinh(atanh(sin(phi)) - {c['e']} * atanh({c['e']} * sin(phi))) t from {last}",
        f"{p}8": f"select {key}, atan2(t, cos(dl)) xi, atanh(sin(dl) / sqrt(1 + t * t)) eta from {p}7",
        f"{source}_bng": f"select {key}, "
            f"{c['east']} + {c['r']} * (eta + {c['a1']} * cos(2 * xi) * sinh(2 * eta) + {c['a2']} * cos(4 * xi) * sinh(4 * eta) "
            f"+ {c['a3']} * cos(6 * xi) * sinh(6 * eta)) e, "
            f"{c['north']} + {c['r']} * (xi + {c['a1']} * sin(2 * xi) * cosh(2 * eta) + {c['a2']} * sin(4 * xi) * cosh(4 * eta) "
            f"+ {c['a3']} * sin(6 * xi) * cosh(6 * eta)) n from {p}8",
    }
    return steps


def _first(source: str, key: str) -> str:
    return (
        f"select * from (select *, row_number() over (partition by {key} order by ingestion_timestamp, source_seq) rn "
        f"from {source}) where rn = 1"
    )


def _nearest(source: str, key: str, distance: int) -> str:
    return (
        f"select {key}, postcode, admin_district, admin_ward, d from (select l.{key}, r.postcode, r.admin_district, "
        f"r.admin_ward, sqrt((l.e - r.eastings) * (l.e - r.eastings) + (l.n - r.northings) * (l.n - r.northings)) d, "
        f"row_number() over (partition by l.{key} order by (l.e - r.eastings) * (l.e - r.eastings) "
        f"+ (l.n - r.northings) * (l.n - r.northings), r.postcode) rn "
        f"from {source} l join places_ref r on l.e between r.eastings - {distance} and r.eastings + {distance} "
        f"and l.n between r.northings - {distance} and r.northings + {distance} "
        f"where (l.e - r.eastings) * (l.e - r.eastings) + (l.n - r.northings) * (l.n - r.northings) <= {distance**2}) where rn = 1"
    )


def _rounded(source: str, key: str) -> str:
    return (
        f"select {key}, cast(round_even(e, 0) as bigint) e, cast(round_even(n, 0) as bigint) n from {source}_bng"
    )


_BOX = (
    f"coalesce(lat between {K.BBOX['lat_min']}::double and {K.BBOX['lat_max']}::double "
    f"and lon between {K.BBOX['lon_min']}::double and {K.BBOX['lon_max']}::double, false)"
)

_GRID = "'E' || cast(easting_bng // {s} as varchar) || 'N' || cast(northing_bng // {s} as varchar)"


def grid_id(size: int) -> str:
    return _GRID.format(s=size)


CTES: dict[str, str] = {
    **{name: text.format(**{t: t for t in TABLES}) for name, text in VIEWS.items()},
    # places
    "places_first": _first("(select *, cast(null as timestamp) as ingestion_timestamp from places_raw)", "postcode"),
    "places_ref": "select * from places_first where postcode_type = 'full_postcode' and eastings is not null",
    # assets
    "assets_first": _first("assets_raw", "id"),
    "assets_point": """
        select * exclude (lat, lon),
          case when lat is not null then lat when type = 'way' and broken = 1 then v0lat when vertices = 3 then (v0lat + v1lat + v2lat) / 3
               when vertices = 2 then (v0lat + v1lat) / 2 when vertices = 1 then v0lat end as lat,
          case when lat is not null then lon when type = 'way' and broken = 1 then v0lon when vertices = 3 then (v0lon + v1lon + v2lon) / 3
               when vertices = 2 then (v0lon + v1lon) / 2 when vertices = 1 then v0lon end as lon
        from assets_first""",
    **projected("assets_point", "id"),
    "assets_grid": _rounded("assets_point", "id"),
    "line_vertices": """
        select id * 10 + 0 as vid, v0lat as lat, v0lon as lon from assets_first where vertices >= 2 and broken = 0
        union all select id * 10 + 1, v1lat, v1lon from assets_first where vertices >= 2 and broken = 0
        union all select id * 10 + 2, v2lat, v2lon from assets_first where vertices >= 3 and broken = 0""",
    **projected("line_vertices", "vid"),
    "asset_lengths": """
        select a.vid // 10 as id, sum(sqrt((a.e - b.e) * (a.e - b.e) + (a.n - b.n) * (a.n - b.n))) as length_meters
        from line_vertices_bng a join line_vertices_bng b on b.vid = a.vid + 1 group by 1""",
    "asset_places": _nearest("assets_grid", "id", K.ASSET_PLACE_RADIUS_M),
    "assets": f"""
        select p.*, g.e as easting_bng, g.n as northing_bng, l.length_meters, q.postcode, q.admin_district, q.admin_ward,
          q.d as place_distance, {_BOX} as is_valid_location,
          ((operator is not null)::int + (name is not null)::int + (substance is not null)::int + (material is not null)::int) / 4.0::double
            as metadata_quality_score,
          case when (operator is not null)::int + (name is not null)::int + (substance is not null)::int + (material is not null)::int > 2
            then 'high' when (operator is not null)::int + (name is not null)::int + (substance is not null)::int + (material is not null)::int > 0
            then 'medium' else 'basic' end as quality_tier
        from assets_point p left join assets_grid g using (id) left join asset_lengths l using (id) left join asset_places q using (id)""",
    # incidents
    "incidents_first": _first("incidents_raw", "crime_id"),
    "incidents_point": "select * replace (try_cast(lat as double) as lat, try_cast(lon as double) as lon) from incidents_first",
    **projected("incidents_point", "crime_id"),
    "incidents_grid": _rounded("incidents_point", "crime_id"),
    "incident_places": _nearest("incidents_grid", "crime_id", K.INCIDENT_PLACE_RADIUS_M),
    "incidents": f"""
        select p.* exclude (month, outcome_date), cast(month || '-01' as date) as month,
          try_cast(outcome_date || '-01' as date) as outcome_date,
          g.e as easting_bng, g.n as northing_bng, q.postcode, q.admin_district, q.admin_ward, {_BOX} as is_valid_location
        from incidents_point p left join incidents_grid g using (crime_id) left join incident_places q using (crime_id)""",
    # weather
    "weather_first": _first("weather_raw", "location_name, datetime"),
    "daily": """
        select *, max_temperature - min_temperature as temperature_range,
          case when avg_temperature between 15 and 25 and avg_humidity between 30 and 60 and avg_wind_speed < 5 then 'comfortable'
               when avg_temperature < 5 or avg_temperature > 30 then 'extreme'
               when avg_humidity > 80 or avg_wind_speed > 10 then 'uncomfortable' else 'moderate' end as comfort_level
        from (select cast(datetime as date) as date, avg(temp_celsius) avg_temperature, min(temp_celsius) min_temperature,
          max(temp_celsius) max_temperature, avg(feels_like_celsius) avg_feels_like, avg(humidity_percent) avg_humidity,
          min(humidity_percent) min_humidity, max(humidity_percent) max_humidity, avg(pressure_hpa) avg_pressure,
          min(pressure_hpa) min_pressure, max(pressure_hpa) max_pressure, avg(wind_speed_ms) avg_wind_speed,
          max(wind_speed_ms) max_wind_speed, avg(wind_direction_deg) avg_wind_direction, avg(clouds_percent) avg_cloud_coverage,
          avg(visibility_meters) avg_visibility, sum(coalesce(rain_1h_mm, 0)) total_rainfall_mm,
          max(coalesce(rain_1h_mm, 0)) max_hourly_rainfall_mm, sum(coalesce(snow_1h_mm, 0)) total_snowfall_mm,
          max(weather_main) dominant_weather, count(*) observation_count,
          atan2(avg(sin(radians(wind_direction_deg))), avg(cos(radians(wind_direction_deg)))) as bearing
          from weather_first group by 1)""",
    "monthly": """
        select *, round(rainy_days * 1.0::double / total_days * 100, 1) rainy_days_percent,
          round(comfortable_days * 1.0::double / total_days * 100, 1) comfortable_days_percent,
          case when month in (12, 1, 2) then 'Winter' when month in (3, 4, 5) then 'Spring' when month in (6, 7, 8) then 'Summer'
            else 'Autumn' end as season
        from (select cast(extract(year from date) as int) as year, cast(extract(month from date) as int) as month,
          strftime(date, '%Y-%m') as year_month, strftime(date, '%B') as month_name,
          avg(avg_temperature) avg_temperature, avg(min_temperature) avg_min_temperature, avg(max_temperature) avg_max_temperature,
          avg(temperature_range) avg_temperature_range, min(min_temperature) extreme_min_temperature,
          max(max_temperature) extreme_max_temperature, avg(avg_humidity) avg_humidity, avg(avg_pressure) avg_pressure,
          avg(avg_wind_speed) avg_wind_speed, max(max_wind_speed) max_wind_speed, sum(total_rainfall_mm) total_rainfall_mm,
          sum(total_snowfall_mm) total_snowfall_mm, avg(total_rainfall_mm) avg_daily_rainfall_mm,
          count(*) filter (total_rainfall_mm > 0) rainy_days, count(*) filter (total_snowfall_mm > 0) snowy_days,
          avg(avg_cloud_coverage) avg_cloud_coverage, avg(avg_visibility) avg_visibility,
          count(*) filter (comfort_level = 'comfortable') comfortable_days,
          count(*) filter (comfort_level = 'uncomfortable') uncomfortable_days,
          count(*) filter (comfort_level = 'extreme') extreme_days, count(*) total_days
          from daily group by 1, 2, 3, 4)""",
    # gold grids
    "density": f"""
        select {grid_id(1000)} as grid_cell_id, (easting_bng // 1000) * 1000 + 500.0::double as grid_center_easting,
          (northing_bng // 1000) * 1000 + 500.0::double as grid_center_northing, infrastructure_type,
          count(*) as infrastructure_count, avg(metadata_quality_score) as avg_quality_score,
          array_to_string(list_sort(list(distinct quality_tier)), ',') as quality_tiers, count(*) / 1.0::double as density_per_km2
        from assets group by 1, 2, 3, 4""",
    "hotspots": f"""
        select *, crime_count * 4.0::double as density_per_km2,
          case when crime_count * 4 >= 20 then 'high' when crime_count * 4 >= 10 then 'medium' else 'low' end as hotspot_level
        from (select {grid_id(500)} as grid_cell_id, (easting_bng // 500) * 500 + 250.0::double as grid_center_easting,
          (northing_bng // 500) * 500 + 250.0::double as grid_center_northing, category, count(*) as crime_count,
          count(distinct month) as months_with_crimes,
          array_to_string(list_sort(list(distinct cast(month as varchar))), ',') as crime_months
          from incidents group by 1, 2, 3, 4)""",
    "infra_cells": """
        select grid_center_easting as grid_easting, grid_center_northing as grid_northing,
          sum(infrastructure_count) as total_infrastructure_count, sum(density_per_km2) as total_infrastructure_density,
          array_to_string(list_sort(list(distinct infrastructure_type)), ',') as infrastructure_types,
          count(distinct infrastructure_type) as infrastructure_type_count, avg(avg_quality_score) as avg_quality_score
        from density group by 1, 2""",
    "crime_cells": """
        select floor(grid_center_easting / 1000) * 1000 + 500 as grid_easting, floor(grid_center_northing / 1000) * 1000 + 500 as grid_northing,
          sum(crime_count) as total_crime_count, sum(density_per_km2) as total_crime_density,
          array_to_string(list_sort(list(distinct category)), ',') as crime_categories, count(distinct category) as crime_category_count,
          max(case hotspot_level when 'high' then 1.0::double when 'medium' then 0.5::double else 0.0::double end) as max_hotspot_score
        from hotspots group by 1, 2""",
    "cells_joined": """
        select coalesce(i.grid_easting, c.grid_easting) as grid_easting, coalesce(i.grid_northing, c.grid_northing) as grid_northing,
          coalesce(total_infrastructure_count, 0) as total_infrastructure_count,
          coalesce(total_infrastructure_density, 0) as total_infrastructure_density, infrastructure_types,
          coalesce(infrastructure_type_count, 0) as infrastructure_type_count, coalesce(avg_quality_score, 0) as avg_quality_score,
          coalesce(total_crime_count, 0) as total_crime_count, coalesce(total_crime_density, 0) as total_crime_density,
          crime_categories, coalesce(crime_category_count, 0) as crime_category_count, coalesce(max_hotspot_score, 0) as max_hotspot_score
        from infra_cells i full join crime_cells c on i.grid_easting = c.grid_easting and i.grid_northing = c.grid_northing""",
    "cells": """
        select *, case when correlation_score >= 0.7 then 'high' when correlation_score >= 0.4 then 'medium'
            when correlation_score >= 0.1 then 'low' else 'none' end as correlation_level
        from (select *, 'grid_' || cast(cast(grid_easting as decimal(20,1)) as varchar) || '_' || cast(cast(grid_northing as decimal(20,1)) as varchar) as grid_cell_id,
          least(total_infrastructure_density / 100.0::double * (total_crime_density / 50.0::double), 1.0::double) as correlation_score,
          case when max_hotspot_score >= 0.5 and total_infrastructure_count > 10 then 'high_risk'
               when total_crime_count > 5 and total_infrastructure_count > 5 then 'medium_risk'
               when total_crime_count > 0 or total_infrastructure_count > 0 then 'low_risk' else 'no_data' end as risk_level,
          case when total_infrastructure_count > 0 then total_crime_density / 50.0::double * (1 - avg_quality_score) else 0 end as infrastructure_vulnerability,
          case when total_infrastructure_count > 0 then total_infrastructure_density / 100.0::double * (1 - total_crime_density / 50.0::double) else 0 end as safety_index
          from cells_joined)""",
    # postcode profiles
    "postcode_infra": """
        select *, round(high_quality_count * 1.0::double / total_infrastructure_count * 100, 1) as high_quality_percent,
          round(with_coordinates_count * 1.0::double / total_infrastructure_count * 100, 1) as coordinate_coverage_percent,
          infrastructure_type_count / 6.0::double as infrastructure_diversity_score
        from (select postcode, count(*) total_infrastructure_count, count(distinct infrastructure_type) infrastructure_type_count,
          count(*) filter (infrastructure_type = 'power') power_count, count(*) filter (infrastructure_type = 'communication') communication_count,
          count(*) filter (infrastructure_type = 'water') water_count, count(*) filter (infrastructure_type = 'gas') gas_count,
          count(*) filter (infrastructure_type = 'sewerage') sewerage_count, count(*) filter (infrastructure_type = 'fuel') fuel_count,
          avg(metadata_quality_score) avg_quality_score, count(*) filter (quality_tier = 'high') high_quality_count,
          count(*) filter (quality_tier = 'medium') medium_quality_count, count(*) filter (quality_tier = 'basic') basic_quality_count,
          count(*) filter (lat is not null and lon is not null) with_coordinates_count,
          count(*) filter (easting_bng is not null) with_bng_coords_count,
          array_to_string(list_sort(list(distinct infrastructure_type)), ',') infrastructure_types
          from assets where postcode is not null group by 1)""",
    "postcode_crime": """
        select *, round(crimes_with_outcome * 1.0::double / total_crime_count * 100, 1) as outcome_rate_percent,
          (violence_count * 3 + burglary_count * 2 + vehicle_crime_count * 2 + theft_count + drugs_count * 1.5::double + antisocial_count)
            / total_crime_count::double as crime_severity_score
        from (select postcode, count(*) total_crime_count, count(distinct category) crime_category_count,
          count(*) filter (contains(category, 'violence')) violence_count, count(*) filter (contains(category, 'burglary')) burglary_count,
          count(*) filter (contains(category, 'vehicle')) vehicle_crime_count, count(*) filter (contains(category, 'theft')) theft_count,
          count(*) filter (contains(category, 'drugs')) drugs_count, count(*) filter (contains(category, 'antisocial')) antisocial_count,
          count(outcome_category) crimes_with_outcome, array_to_string(list_sort(list(distinct category)), ',') crime_categories
          from incidents where postcode is not null group by 1)""",
    "places": """
        select postcode, postcode_type, admin_district, admin_ward, parish, parliamentary_constituency as constituency, region, country,
          eastings as easting_bng, northings as northing_bng,
          ((admin_district is not null)::int + (admin_ward is not null)::int + (parish is not null)::int + (region is not null)::int
            + (country is not null)::int + (parliamentary_constituency is not null)::int) / 6.0::double as quality_score
        from places_first""",
    "profile_joined": """
        select p.postcode, p.admin_district, p.admin_ward, p.quality_score as postcode_quality_score,
          coalesce(i.total_infrastructure_count, 0) as total_infrastructure_count, coalesce(i.infrastructure_type_count, 0) as infrastructure_type_count,
          coalesce(i.infrastructure_diversity_score, 0) as infrastructure_diversity_score, coalesce(i.avg_quality_score, 0) as avg_quality_score,
          coalesce(c.total_crime_count, 0) as total_crime_count, coalesce(c.crime_category_count, 0) as crime_category_count,
          coalesce(c.crime_severity_score, 0) as crime_severity_score, coalesce(c.outcome_rate_percent, 0) as outcome_rate_percent,
          i.water_count, c.burglary_count
        from places p left join postcode_infra i using (postcode) left join postcode_crime c using (postcode)""",
    "profile": """
        select *, 100 - area_risk_score as safety_index,
          case when area_risk_score >= 70 then 'high_risk' when area_risk_score >= 40 then 'medium_risk'
               when area_risk_score >= 10 then 'low_risk' else 'minimal_risk' end as risk_classification
        from (select *, round(normalized_crime_risk * 50 + infrastructure_vulnerability_score * 50, 1) as area_risk_score
        from (select *, case when total_infrastructure_count > 0 then normalized_crime_risk * (1 - avg_quality_score) else 0 end as infrastructure_vulnerability_score
        from (select *, case when max(total_crime_count) over () > 0 then total_crime_count::double / max(total_crime_count) over () else 0 end as normalized_crime_risk
        from profile_joined)))""",
}


def query(text: str, **extra: str) -> str:
    """``text`` with every common table expression it needs in front, in dependency order."""
    import re

    pool = {**CTES, **extra}
    ordered: list[str] = []

    def visit(sql: str, seen: tuple[str, ...] = ()) -> None:
        for word in re.findall(r"[a-z_][a-z_0-9]*", sql):
            if word in pool and word not in ordered and word not in seen:
                visit(pool[word], (*seen, word))
                ordered.append(word)

    visit(text)
    head = ",\n".join(f"{name} as ({pool[name]})" for name in ordered)
    return f"with {head}\n{text}" if ordered else text
