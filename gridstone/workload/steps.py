"""Queries for the single operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridstone import constants as K
from gridstone import schemas
from gridstone.functions import classify, geo, scalars
from gridstone.operators import clean, filters, quality, summarise
from gridstone.operators.nearest import nearest_join
from gridstone.plans import silver
from gridstone.sources import flatten
from gridstone.workload.oracle import grid_id, stable
from gridstone.workload.registry import flag, listed, query, six, text
from gridstone.workload.views import (
    INGESTED, bronze_assets, bronze_incidents, bronze_places, bronze_weather, latitude, longitude, table, view,
)

RUN_TIME = datetime(2025, 1, 1)

# --- geospatial -------------------------------------------------------------------
_POINTS = f"select o_orderkey as id, {latitude('o_orderkey')} as lat, case when o_orderkey % 50 = 0 then null else {longitude('o_orderkey')} end as lon from orders"


def order_points(spark, sf):
    orders = table(spark, sf, "orders")
    return spark.sql(_POINTS.replace("from orders", "from {orders}"), orders=orders)


def _points_ctes():
    from gridstone.workload.oracle import projected

    return {"points": _POINTS, **projected("points", "id")}


def _asset_points(spark, sf):
    return geo.with_bng(silver.repaired_assets(clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True)))


@query("geo1_project", "select p.id, cast(round_even(e, 0) as bigint) as easting_bng, cast(round_even(n, 0) as bigint) as northing_bng "
       "from points p left join points_bng g on p.id = g.id", **_points_ctes())
def geo1(spark, sf):
    return geo.with_bng(order_points(spark, sf)).select("id", "easting_bng", "northing_bng")


@query("geo2_centroid", "select id, "
       + ", ".join(stable(f"case vertices when 3 then (v0{a} + v1{a} + v2{a}) / 3 when 2 then (v0{a} + v1{a}) / 2 else v0{a} end") + f" as {a}" for a in ("lat", "lon"))
       + " from assets_first where type = 'way' and vertices > 0 and broken = 0")
def geo2(spark, sf):
    first = clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True)
    point = geo.centroid(geo.parse_geometry(F.col("geometry_json")))
    return first.select("id", point.alias("c")).where("c is not null").select("id", six("c.lat", "lat"), six("c.lon", "lon"))


@query("geo3_repair", f"select id, type, {stable('lat')} as lat, {stable('lon')} as lon from assets_point")
def geo3(spark, sf):
    repaired = silver.repaired_assets(clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True))
    return repaired.select("id", "type", six("lat"), six("lon"))


@query("geo4_length", "select id, round(length_meters + 1e-9, 3) as length_meters from asset_lengths")
def geo4(spark, sf):
    repaired = silver.repaired_assets(clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True))
    return repaired.where("length_meters is not null").select("id", F.round(F.col("length_meters") + 1e-9, 3).alias("length_meters"))


@query("geo5_grid_cell", f"select id, {grid_id(1000)} as grid_cell_id, (easting_bng // 1000) * 1000 + 500.0::double as grid_center_easting, "
       "(northing_bng // 1000) * 1000 + 500.0::double as grid_center_northing from (select p.id, e as easting_bng, n as northing_bng "
       "from assets_point p left join assets_grid g on p.id = g.id)")
def geo5(spark, sf):
    cells = geo.with_grid_cell(_asset_points(spark, sf), K.ASSET_CELL_M)
    return cells.select("id", "grid_cell_id", "grid_center_easting", "grid_center_northing")


@query("geo6_regrid", "select fine_easting, fine_northing, floor(fine_easting / 1000) * 1000 as corner_easting, floor(fine_northing / 1000) * 1000 + 500 as center_northing, "
       "count(*) as records from (select (e // 500) * 500 + 250.0::double as fine_easting, (n // 500) * 500 + 250.0::double as fine_northing from incidents_grid) group by all")
def geo6(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    cells = geo.with_grid_cell(geo.with_bng(clean.numbers_from_text(first)), K.INCIDENT_CELL_M).where("grid_cell_id is not null")
    return cells.groupBy(F.col("grid_center_easting").alias("fine_easting"), F.col("grid_center_northing").alias("fine_northing")).agg(
        F.count("*").alias("records")
    ).select(
        "fine_easting", "fine_northing", "records",
        geo.regrid(F.col("fine_easting"), 1000).cast("double").alias("corner_easting"),
        geo.regrid(F.col("fine_northing"), 1000, "center").alias("center_northing"),
    )


@query("geo7_distance", f"select id, {stable('sqrt((lat - 53.4::double) * (lat - 53.4::double) + (lon + 2.15::double) * (lon + 2.15::double))')} as degrees from points", **_points_ctes())
def geo7(spark, sf):
    away = geo.distance(F.col("lat"), F.col("lon"), F.lit(53.4), F.lit(-2.15))
    return order_points(spark, sf).select("id", six(away, "degrees"))


@query("geo8_density", "select grid_cell_x, grid_cell_y, count(*) as records, count(*) / 0.25::double as density_per_km2 from "
       "(select e // 500 as grid_cell_x, n // 500 as grid_cell_y from incidents_grid) group by all")
def geo8(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    cells = geo.with_grid_cell(geo.with_bng(clean.numbers_from_text(first)), 500).where("grid_cell_x is not null and grid_cell_y is not null")
    counts = cells.groupBy(F.col("grid_cell_x").cast("long").alias("grid_cell_x"), F.col("grid_cell_y").cast("long").alias("grid_cell_y")).agg(F.count("*").alias("records"))
    return counts.withColumn("density_per_km2", geo.density_per_km2(F.col("records"), 500))


@query("src7_sample_grid", "select i as grid_row, j as grid_col, " + stable("53.35::double + (i + 0.5::double) * ((53.45::double - 53.35::double) / 3)") + " as lat, "
       + stable("-2.20::double + (j + 0.5::double) * ((-2.05::double + 2.20::double) / 3)") + " as lon, count(o.id) as incidents from "
       "(select unnest(range(3)) as i) cross join (select unnest(range(3)) as j) left join points o on "
       "least(floor((o.lat - 53.35::double) / ((53.45::double - 53.35::double) / 3)), 2) = i and least(floor((o.lon + 2.20::double) / ((-2.05::double + 2.20::double) / 3)), 2) = j "
       "and o.lat between 53.35::double and 53.45::double and o.lon between -2.20::double and -2.05::double group by i, j", **_points_ctes())
def src7(spark, sf):
    """Incidents around each sample point: the point whose square they fall into."""
    box, n = K.BBOX, 3
    points = order_points(spark, sf).where(geo.within_bbox(F.col("lat"), F.col("lon")))

    def slot(c, low, high):
        return F.least(F.floor((F.col(c) - box[low]) / F.lit((box[high] - box[low]) / n)), F.lit(n - 1)).cast("int")

    counts = points.groupBy(slot("lat", "lat_min", "lat_max").alias("grid_row"), slot("lon", "lon_min", "lon_max").alias("grid_col")).agg(F.count("id").alias("incidents"))
    grid = geo.sample_grid(spark, box, n)
    return grid.join(counts, ["grid_row", "grid_col"], "left").select(
        F.col("grid_row").cast("long").alias("grid_row"), F.col("grid_col").cast("long").alias("grid_col"), six("lat"), six("lon"),
        F.coalesce("incidents", F.lit(0)).alias("incidents"),
    )


# --- joins ------------------------------------------------------------------------
@query("join1_nearest", f"select p.crime_id, q.postcode, q.admin_district, q.admin_ward, {stable('q.d')} as distance_m from incidents_point p left join incident_places q on p.crime_id = q.crime_id")
def join1(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    left = geo.with_bng(clean.numbers_from_text(first))
    joined = nearest_join(left, silver.reference_places(bronze_places(spark, sf)), max_distance=K.INCIDENT_PLACE_RADIUS_M, distance_column="distance_m")
    return joined.select("crime_id", "postcode", "admin_district", "admin_ward", six("distance_m"))


# Every customer a point of one millimetre grid, forty to a row.
_DENSE = {
    "dense_ref": "select c_custkey as code, 390000e0 + cast(c_custkey % 40 as double) / 1000e0 as x, 389000e0 + cast(c_custkey // 40 as double) / 1000e0 as y from customer",
    "dense_nearest": "select crime_id, min(struct_pack(d2 := (e - x) * (e - x) + (n - y) * (n - y), code := code)) as hit from incidents_grid cross join dense_ref where e is not null group by 1",
}


@query("join1_dense", f"select p.crime_id, hit.code as code, {stable('sqrt(hit.d2)')} as distance_m from incidents_point p left join (select * from dense_nearest where sqrt(hit.d2) <= 9000) q on p.crime_id = q.crime_id", **_DENSE)
def join1_dense(spark, sf):
    """A reference that is one cluster, far denser than the positions that ask for it."""
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    left = geo.with_bng(clean.numbers_from_text(first)).select("crime_id", "easting_bng", "northing_bng")
    points = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("code"), F.expr("390000D + cast(c_custkey % 40 as double) / 1000D").alias("eastings"),
        F.expr("389000D + cast(c_custkey div 40 as double) / 1000D").alias("northings"),
    )
    joined = nearest_join(left, points, right_columns=["code"], max_distance=9000, tie_break="code", distance_column="distance_m")
    return joined.select("crime_id", "code", six("distance_m"))


_SIDES = """
select coalesce(a.ym, b.ym) as month, coalesce(a.n, 0) as ordered, coalesce(b.n, 0) as shipped
from (select substring(cast(o_orderdate as varchar), 1, 7) ym, count(*) n from orders group by 1) a
full join (select substring(cast(l_shipdate as varchar), 1, 7) ym, count(*) n from lineitem group by 1) b on a.ym = b.ym"""


@query("join2_full_outer", _SIDES)
def join2(spark, sf):
    def per_month(name, column, out):
        month = F.substring(F.col(column).cast("string"), 1, 7)
        return table(spark, sf, name).groupBy(month.alias("month")).agg(F.count("*").alias(out))

    both = per_month("orders", "o_orderdate", "ordered").join(per_month("lineitem", "l_shipdate", "shipped"), "month", "full_outer")
    return both.fillna(0, ["ordered", "shipped"])


@query("join3_left", "select c_custkey, c_mktsegment, count(o_orderkey) as orders, coalesce(max(o_totalprice), 0) as largest from customer left join orders on c_custkey = o_custkey group by 1, 2")
def join3(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("largest"))
    joined = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(per_customer, "c_custkey", "left")
    return joined.fillna({"orders": 0, "largest": 0.0})


@query("join4_fill", "select grid_easting, grid_northing, total_infrastructure_count::bigint as total_infrastructure_count, total_crime_count::bigint as total_crime_count, "
       "infrastructure_type_count::int as infrastructure_type_count, crime_category_count::int as crime_category_count, max_hotspot_score, "
       "(max_hotspot_score >= 0.5)::int as is_crime_hotspot, infrastructure_types, crime_categories from cells_joined")
def join4(spark, sf):
    from gridstone.plans import correlation
    from gridstone.workload.plans import density_frame, hotspots_frame

    cells = correlation.joined_cells(density_frame(spark, sf), hotspots_frame(spark, sf))
    return cells.select(
        "grid_easting", "grid_northing", "total_infrastructure_count", "total_crime_count", "infrastructure_type_count",
        "crime_category_count", "max_hotspot_score", flag("is_crime_hotspot"), listed("infrastructure_types"), listed("crime_categories"),
    )


@query("join5_lookup", "select o_orderkey, postcode, admin_district from (select o_orderkey, case when o_custkey % 7 = 0 then 'zz ' || o_custkey else 'sk ' || lpad(cast(o_custkey as varchar), 8, '0') end as code from orders) "
       "join places_first on replace(upper(code), ' ', '') = replace(upper(postcode), ' ', '')")
def join5(spark, sf):
    unknown = F.col("o_custkey") % 7 == 0
    key = F.col("o_custkey").cast("string")
    code = F.when(unknown, F.concat(F.lit("zz "), key)).otherwise(F.concat(F.lit("sk "), F.lpad(key, 8, "0")))
    codes = table(spark, sf, "orders").select("o_orderkey", code.alias("code"))
    places = bronze_places(spark, sf)
    twice = places.unionByName(places.where(F.pmod(F.xxhash64("postcode"), F.lit(3)) == 0))  # every third code comes again
    return filters.lookup(codes, twice, "code").select("o_orderkey", "postcode", "admin_district")


@query("join5_lookup_misses", "select o_orderkey from orders where o_custkey % 7 = 0 or o_custkey not in (select c_custkey from customer)")
def join5_misses(spark, sf):
    unknown = F.col("o_custkey") % 7 == 0
    key = F.col("o_custkey").cast("string")
    code = F.when(unknown, F.concat(F.lit("zz "), key)).otherwise(F.concat(F.lit("sk "), F.lpad(key, 8, "0")))
    codes = table(spark, sf, "orders").select("o_orderkey", code.alias("code"))
    return filters.lookup(codes, bronze_places(spark, sf), "code", how="left_anti").select("o_orderkey")


@query("join6_norm_max", f"select c_custkey, {stable('n::double / max(n) over ()')} as share_of_max from (select o_custkey as c_custkey, count(*) n from orders group by 1)")
def join6(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return summarise.with_share_of_max(counts, "n", "share_of_max").select("c_custkey", six("share_of_max"))


# --- filters and ladders ----------------------------------------------------------
_ELEMENTS = """
select id, type, case when id % 3 = 0 then '' else infrastructure_type end as man_made,
  case when id % 3 = 0 then case when id % 2 = 0 then 'pole' else 'cable' end end as power_tag,
  operator, name, substance, material, diameter, location, lat, lon, vertices, v0lat, v0lon, v1lat, v1lon, v2lat, v2lon
from assets_first"""


def raw_elements(spark, sf):
    """Nested element records built from the first version of every element."""
    base = clean.keep_first(view(spark, sf, "assets_raw"), ["id"], INGESTED, total_order=True)
    man_made = F.when(F.col("id") % 3 == 0, "").otherwise(F.col("infrastructure_type"))
    power = F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "pole").otherwise("cable"))
    values = {"man_made": man_made, "power": power, **{t: F.col(t) for t in flatten.ELEMENT_TAGS}}
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    vertices = F.array(*[F.struct(F.col(f"v{i}lat").alias("lat"), F.col(f"v{i}lon").alias("lon")) for i in range(3)])
    return base.select(
        "id", "type", "lat", "lon",
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("tags"),
        F.when(F.col("type") == "way", F.slice(F.array(F.lit(1), F.lit(2), F.lit(3)), F.lit(1), F.col("vertices"))).cast("array<bigint>").alias("nodes"),
        F.when(F.col("type") == "way", F.slice(vertices, F.lit(1), F.col("vertices"))).alias("geometry"),
    )


_IN_BOX = "({0} between 53.35::double and 53.45::double and {1} between -2.20::double and -2.05::double)"


@query("fil1_features", "select id, feature from (select *, case when type = 'node' and man_made = 'manhole' then 'manhole' when type = 'way' and man_made = 'pipeline' then 'pipeline' "
       "when type = 'way' and power_tag = 'cable' then 'power_cable' when type = 'way' and man_made = 'cable' then 'cable' when type = 'way' and man_made = 'duct' then 'duct' "
       "when type = 'node' and power_tag = 'pole' then 'utility_pole' end as feature from elements) where feature is not null and ("
       + _IN_BOX.format("lat", "lon") + " or (vertices >= 1 and " + _IN_BOX.format("v0lat", "v0lon") + ") or (vertices >= 2 and " + _IN_BOX.format("v1lat", "v1lon")
       + ") or (vertices >= 3 and " + _IN_BOX.format("v2lat", "v2lon") + "))", elements=_ELEMENTS)
def fil1(spark, sf):
    return filters.select_features(raw_elements(spark, sf)).select("id", "feature")


@query("fil2_not_null", "select id, operator from assets_first where operator is not null")
def fil2(spark, sf):
    return clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True).where(filters.present("operator")).select("id", "operator")


@query("fil3_fallback", "select 'present' as wanted, count(*) as places from places_raw where postcode_type = 'full_postcode' "
       "union all select 'absent', count(*) from places_raw where postcode_type = 'outward_code'")
def fil3(spark, sf):
    places = bronze_places(spark, sf)
    present = filters.prefer(places, "postcode_type", ("full_postcode", "outward_code"))
    absent = filters.prefer(places, "postcode_type", ("no_such_type", "outward_code"))
    return present.agg(F.lit("present").alias("wanted"), F.count("*").alias("places")).unionAll(
        absent.agg(F.lit("absent").alias("wanted"), F.count("*").alias("places"))
    )


@query("fil4_bbox", "select id, coalesce(" + _IN_BOX.format("lat", "lon") + ", false)::int as is_valid_location from points", **_points_ctes())
def fil4(spark, sf):
    return filters.flag_inside(order_points(spark, sf)).select("id", flag("is_valid_location"))


@query("fil5_ladder", "select o_orderkey, case when n >= 20 then 'high' when n >= 10 then 'medium' else 'low' end as hotspot_level, case when n / 40.0::double > 0.5 then 'high' when n > 0 then 'medium' else 'basic' end as quality_tier, "
       "case when m in (12, 1, 2) then 'Winter' when m in (3, 4, 5) then 'Spring' when m in (6, 7, 8) then 'Summer' else 'Autumn' end as season, "
       "case when n * 2 >= 70 then 'high_risk' when n * 2 >= 40 then 'medium_risk' when n * 2 >= 10 then 'low_risk' else 'minimal_risk' end as area_risk "
       "from (select o_orderkey, o_orderkey % 41 as n, extract(month from o_orderdate) as m from orders)")
def fil5(spark, sf):
    n = F.col("o_orderkey") % 41
    return table(spark, sf, "orders").select(
        "o_orderkey", classify.hotspot_level(n).alias("hotspot_level"), classify.quality_tier(n / 40.0).alias("quality_tier"),
        classify.season(F.month("o_orderdate")).alias("season"), classify.area_risk(n * 2).alias("area_risk"),
    )


@query("fil6_contains", "select crime_id, category from incidents_first where contains(category, 'theft') or contains(category, 'violent')")
def fil6(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    return first.where(F.col("category").contains("theft") | F.col("category").contains("violent")).select("crime_id", "category")


@query("prj1_keep_existing", "select id, infrastructure_type, type, operator, id as osm_id from assets_first")
def prj1(spark, sf):
    first = clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True)
    return clean.keep_existing(first, ["id", "infrastructure_type", "no_such_column", "type", "operator"], {"osm_id": "id"})


@query("prj3_drop_original", "select p.id, cast(round_even(e, 0) as bigint) as easting, cast(round_even(n, 0) as bigint) as northing from points p left join points_bng g on p.id = g.id", **_points_ctes())
def prj3(spark, sf):
    return geo.with_bng(order_points(spark, sf), easting="easting", northing="northing", drop_original=True)


@query("prj4_audit", "select o_orderkey, '2025-01-01' as transformation_date, 'silver' as data_layer, 'orders_feed' as source_system from orders")
def prj4(spark, sf):
    audited = clean.with_audit(table(spark, sf, "orders").select("o_orderkey"), "orders_feed", "silver", RUN_TIME)
    return audited.select("o_orderkey", text("transformation_date"), "data_layer", "source_system")


# --- aggregation ------------------------------------------------------------------
@query("agg1_set", "select p_brand, count(*) as parts, round(avg(p_size) + 1e-9, 6) as avg_size, array_to_string(list_sort(list(distinct p_type)), ',') as types from part group by 1")
def agg1(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.count("*").alias("parts"), six(F.avg("p_size"), "avg_size"), summarise.value_set("p_type").alias("types")
    ).withColumn("types", listed("types"))


@query("agg2_distinct", "select l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers, count(distinct l_orderkey) as orders from lineitem group by 1")
def agg2(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_orderkey").alias("orders")
    )


@query("agg3_conditional", "select o_orderpriority, count(*) filter (o_orderstatus = 'F') as filled, count(*) filter (o_orderstatus = 'Z') as none, count(*) filter (o_totalprice > 200000) as large from orders group by 1")
def agg3(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        summarise.counted(F.col("o_orderstatus") == "F").alias("filled"), summarise.counted(F.col("o_orderstatus") == "Z").alias("none"),
        summarise.counted(F.col("o_totalprice") > 200000).alias("large"),
    )


@query("agg4_measures", f"select location_name, min(temp_celsius) as low, max(temp_celsius) as high, {stable('avg(temp_celsius)')} as mean, {stable('sum(coalesce(rain_1h_mm, 0))')} as rain, "
       f"{stable('sum(coalesce(snow_1h_mm, 0))')} as snow from weather_first group by 1")
def agg4(spark, sf):
    first = clean.keep_first(bronze_weather(spark, sf), ["location_name", "datetime"], INGESTED, total_order=True)
    return first.groupBy("location_name").agg(
        F.min("temp_celsius").alias("low"), F.max("temp_celsius").alias("high"), six(F.avg("temp_celsius"), "mean"),
        six(F.sum(F.coalesce("rain_1h_mm", F.lit(0.0))), "rain"), six(F.sum(F.coalesce("snow_1h_mm", F.lit(0.0))), "snow"),
    )


@query("agg5_dominant", "select u.user_id, u.last_type, m.event_type as mode_type from (select user_id, max(event_type) last_type from events group by 1) u join "
       "(select user_id, event_type, row_number() over (partition by user_id order by count(*) desc, event_type) rn from events group by 1, 2) m on u.user_id = m.user_id and m.rn = 1")
def agg5(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        scalars.dominant(F.col("event_type")).alias("last_type"), scalars.dominant(F.col("event_type"), "mode").alias("mode_type")
    )


@query("agg6_rollup", f"select substring(day, 1, 7) as month, {stable('avg(mean)')} as mean_of_means, max(n) as busiest_day from (select cast(cast(o_orderdate as date) as varchar) as day, avg(o_totalprice) as mean, count(*) as n from orders group by 1) group by 1")
def agg6(spark, sf):
    day = F.to_date("o_orderdate").cast("string")
    daily = table(spark, sf, "orders").groupBy(day.alias("day")).agg(F.avg("o_totalprice").alias("mean"), F.count("*").alias("n"))
    return daily.groupBy(F.substring("day", 1, 7).alias("month")).agg(six(F.avg("mean"), "mean_of_means"), F.max("n").alias("busiest_day"))


@query("agg7_max_score", "select category, max(case when n >= 20 then 1.0::double when n >= 10 then 0.5::double else 0.0::double end) as best from "
       "(select category, street_id, count(*) as n from incidents_first group by 1, 2) group by 1")
def agg7(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    streets = first.groupBy("category", "street_id").agg(F.count("*").alias("n"))
    return streets.groupBy("category").agg(F.max(classify.hotspot_score(classify.hotspot_level(F.col("n")))).alias("best"))


@query("agg8_set_size", "select c_nationkey, count(distinct c_mktsegment)::int as segments from customer group by 1")
def agg8(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.size(summarise.value_set("c_mktsegment")).alias("segments"))


@query("agg9_global", f"select count(*) as n, {stable('avg(value)')} as mean, min(value) as low, max(value) as high from events")
def agg9(spark, sf):
    return table(spark, sf, "events").agg(F.count("*").alias("n"), six(F.avg("value"), "mean"), F.min("value").alias("low"), F.max("value").alias("high"))


@query("agg10_value_counts", "select category, count(*) as records from incidents_first group by 1 order by 2 desc, 1")
def agg10(spark, sf):
    return summarise.value_counts(clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True), "category")


@query("agg11_monthly", "select substring(cast(o_orderdate as varchar), 1, 7) || '-01' as month, count(*) as records from orders group by 1")
def agg11(spark, sf):
    return summarise.monthly_counts(table(spark, sf, "orders"), "o_orderdate").select(text("month"), "records")


@query("agg12_sql", "select infrastructure_type, substring(cast(ingestion_timestamp as varchar), 1, 4) as ingestion_year, count(*) as records, count(distinct id) as unique_elements from assets_raw group by 1, 2")
def agg12(spark, sf):
    return spark.sql(
        "select infrastructure_type, date_format(ingestion_timestamp, 'yyyy') as ingestion_year, count(*) as records, "
        "count(distinct id) as unique_elements from {assets} group by 1, 2 order by 2 desc, 3 desc", assets=bronze_assets(spark, sf),
    )


@query("agg13_district", "select n_name, round(sum(c_acctbal) + 1e-9, 4) as total, count(*) as customers from customer join nation on c_nationkey = n_nationkey group by 1 order by sum(c_acctbal) desc, 1 limit 5")
def agg13(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    grouped = joined.groupBy("n_name").agg(F.sum("c_acctbal").alias("total"), F.count("*").alias("customers"))
    return summarise.top_k(grouped, 5, F.desc("total"), F.asc("n_name")).withColumn("total", F.round(F.col("total") + 1e-9, 4))


def _describe_sql(column: str) -> str:
    q = ", ".join(f"{stable(f'quantile_cont({column}, {p})')} as p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return (f"select '{column}' as column_name, count({column}) as n, {stable(f'avg({column})')} as mean, {stable(f'stddev_samp({column})')} as std, "
            f"min({column})::double as min, {q}, max({column})::double as max, round(sum({column}) + 1e-9, 3) as total from lineitem")


@query("agg14_describe", _describe_sql("l_quantity") + " union all " + _describe_sql("l_extendedprice"))
def agg14(spark, sf):
    stats = summarise.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return stats.select("column_name", "n", six("mean"), six("std"), "min", six("p25"), six("p50"), six("p75"), "max", F.round(F.col("total") + 1e-9, 3).alias("total"))


@query("agg15_percent", "select o_orderpriority, count(*) filter (o_orderstatus = 'F') as filled, count(*) as total, round(count(*) filter (o_orderstatus = 'F') * 1.0::double / count(*) * 100, 1) as filled_percent from orders group by 1")
def agg15(spark, sf):
    grouped = table(spark, sf, "orders").groupBy("o_orderpriority").agg(summarise.counted(F.col("o_orderstatus") == "F").alias("filled"), F.count("*").alias("total"))
    return grouped.withColumn("filled_percent", scalars.percent(F.col("filled"), F.col("total")))


# --- windows, top-k, sets ---------------------------------------------------------
@query("win1_rank", "select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as price_rank from orders")
def win1(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return summarise.global_rank(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], "price_rank")


@query("win2_dedup_first", "select id, cast(ingestion_timestamp as varchar) as first_seen, source_seq, operator from assets_first")
def win2(spark, sf):
    first = clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True)
    return first.select("id", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("first_seen"), "source_seq", "operator")


@query("win3_coalesced_key", "select record_key, count(*) as records from (select coalesce(nullif(case when o_orderkey % 4 = 0 then '' when o_orderkey % 5 = 0 then null else 'o' || o_custkey end, ''), "
       "case when o_orderkey % 7 = 0 then null else 'c' || o_custkey end) as record_key from orders) where record_key is not null group by 1")
def win3(spark, sf):
    key = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    orders = table(spark, sf, "orders").select(
        F.when(key % 4 == 0, "").when(key % 5 != 0, F.concat(F.lit("o"), cust)).alias("id"),
        F.when(key % 7 != 0, F.concat(F.lit("c"), cust)).alias("persistent_id"),
    )
    return clean.first_key(orders, "id", "persistent_id").groupBy("record_key").agg(F.count("*").alias("records"))


@query("win4_batches", "select batch_id, count(*) as records, min(c_custkey) as first_key, max(c_custkey) as last_key "
       "from (select c_custkey, (row_number() over (order by c_custkey) - 1) // 100 as batch_id from customer) group by 1")
def win4(spark, sf):
    batched = clean.batches(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 100)
    return batched.groupBy("batch_id").agg(F.count("*").alias("records"), F.min("c_custkey").alias("first_key"), F.max("c_custkey").alias("last_key"))


@query("top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def top1(spark, sf):
    return summarise.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 20, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("top_nearest_k", f"select id, {stable('d')} as distance from (select id, sqrt((lat - 53.4::double) * (lat - 53.4::double) + (lon + 2.15::double) * (lon + 2.15::double)) as d from points) where d is not null order by d, id limit 5", **_points_ctes())
def top2(spark, sf):
    return summarise.nearest_k(order_points(spark, sf), (53.4, -2.15)).select("id", six("distance"))


@query("top_sorted", "select cast(date as varchar) as date, observation_count from daily order by 1")
def top3(spark, sf):
    from gridstone.workload.plans import daily_frame

    return daily_frame(spark, sf).orderBy("date").select(text("date"), "observation_count")


@query("set1_union", "select postcode, postcode_type, admin_ward from places_raw")
def set1(spark, sf):
    return _flattened_places(spark, sf).select("postcode", "postcode_type", "admin_ward")


@query("set3_distinct", f"select count(distinct {grid_id(1000)}) as cells from (select e as easting_bng, n as northing_bng from assets_grid)")
def set3(spark, sf):
    cells = geo.with_grid_cell(_asset_points(spark, sf), 1000).where("grid_cell_id is not null")
    return summarise.distinct_count(cells, "grid_cell_id", name="cells")


# --- scalars ----------------------------------------------------------------------
@query("sca1_to_number", f"select crime_id, {stable('try_cast(lat as double)')} as lat, {stable('try_cast(lon as double)')} as lon from incidents_first")
def sca1(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    return clean.numbers_from_text(first).select("crime_id", six("lat"), six("lon"))


@query("sca2_parse_dates", "select crime_id, month || '-01' as month, cast(try_cast(outcome_date || case when crime_id % 3 = 0 then '-17' else '-01' end as date) as varchar) as outcome_date from incidents_first")
def sca2(spark, sf):
    """Outcome dates are months or, for every third incident, whole dates."""
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    mixed = first.withColumn("outcome_date", F.when(F.col("crime_id") % 3 == 0, F.concat("outcome_date", F.lit("-17"))).otherwise(F.col("outcome_date")))
    parsed = clean.parse_dates(mixed, months=["month", "absent_column"], days=["outcome_date"])
    return parsed.select("crime_id", text("month"), text("outcome_date"))


@query("sca3_calendar", "select event_id, cast(cast(ts as date) as varchar) as date, extract(year from ts)::int as year, extract(month from ts)::int as month, strftime(ts, '%Y-%m') as year_month, strftime(ts, '%B') as month_name from events")
def sca3(spark, sf):
    parts = scalars.calendar(F.col("ts"))
    return table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in parts.items()]).withColumn("date", text("date"))


@query("sca4_concat", "select n_nationkey, 'E' || n_nationkey || 'N' || n_regionkey as id, case when n_nationkey % 2 = 0 then n_name || '-' || r_name else n_name end as joined from nation join region on n_regionkey = r_regionkey")
def sca4(spark, sf):
    joined = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        "n_nationkey", F.concat(F.lit("E"), "n_nationkey", F.lit("N"), "n_regionkey").alias("id"),
        F.concat_ws("-", "n_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name"))).alias("joined"),
    )


@query("sca6_capped", f"select event_id, {stable('least(value / 100.0::double * (value / 50.0::double), 1.0::double)')} as score from events")
def sca6(spark, sf):
    return table(spark, sf, "events").select("event_id", six(scalars.capped_product(F.col("value") / 100.0, F.col("value") / 50.0), "score"))


@query("sca7_round", "select event_id, round(value, 1) as one_place, cast(round_even(value, 0) as bigint) as whole from events")
def sca7(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round("value", 1).alias("one_place"), F.rint("value").cast("long").alias("whole"))


@query("sca10_json", "select cast(json_extract(props, '$.k') as bigint) as k, count(*) as records, min(json_extract_string(props, '$.k')) as k_text from events group by 1")
def sca10(spark, sf):
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf, "events").select(parsed["k"].alias("k"), F.get_json_object(F.to_json(parsed), "$.k").alias("t")).groupBy("k").agg(
        F.count("*").alias("records"), F.min("t").alias("k_text")
    )


@query("sca11_replace", "select o_orderkey, replace(upper(o_orderpriority), ' ', '') as code, replace(o_orderpriority, '-', '_') as file_label from orders")
def sca11(spark, sf):
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select("o_orderkey", scalars.lookup_code(priority).alias("code"), scalars.file_label(priority).alias("file_label"))


@query("sca12_enforce", "select crime_id::int as crime_id, try_cast(lat as double) is null as no_lat, month, street_id::varchar as street_id from incidents_first")
def sca12(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    typed = clean.enforce_schema(first, schemas.struct("crime_id int, lat double, street_id string, not_there date"))
    return typed.select("crime_id", F.col("lat").isNull().alias("no_lat"), "month", "street_id")


@query("sca12_cast_losses", "select 'lat' as column_name, count(*) filter (lat is not null and try_cast(lat as double) is null) as lost_in_cast from incidents_first "
       "union all select 'outcome_date', count(*) filter (outcome_date is not null and try_cast(outcome_date || '-01' as date) is null) from incidents_first")
def sca12_losses(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    return clean.cast_losses(first, schemas.struct("lat double, outcome_date date"))


@query("sca14_epoch", "select event_id, 1700000000 + event_id * 977 as seconds from events")
def sca14(spark, sf):
    moment = scalars.epoch_time(F.lit(1700000000) + F.col("event_id") * 977)
    return table(spark, sf, "events").select("event_id", F.unix_timestamp(moment).alias("seconds"))


# --- quality ----------------------------------------------------------------------
@query("dq1_score", "select id, metadata_quality_score, quality_tier from assets")
def dq1(spark, sf):
    first = clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True)
    scored = first.withColumn("metadata_quality_score", quality.completeness_score(first, K.ASSET_METADATA_FIELDS))
    return scored.select("id", "metadata_quality_score", classify.quality_tier(F.col("metadata_quality_score")).alias("quality_tier"))


@query("dq2_flags", "select id, (lat is not null and lon is not null)::int as has_coordinates, (easting_bng is not null)::int as has_bng_coords from assets")
def dq2(spark, sf):
    return quality.with_flags(_asset_points(spark, sf)).select("id", flag("has_coordinates"), flag("has_bng_coords"))


@query("dq3_incident_flags", "select crime_id, (outcome_category is not null)::int as has_outcome, (street_name is not null)::int as has_street from incidents_first")
def dq3(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    return quality.with_incident_flags(first).select("crime_id", flag("has_outcome"), flag("has_street"))


@query("dq4_flag_summary", "select flag, n as true_count, total, round(n * 1.0::double / total * 100, 1) as true_percent from (select 'has_outcome' as flag, count(outcome_category) as n, count(*) as total from incidents_first "
       "union all select 'has_street', count(street_name), count(*) from incidents_first)")
def dq4(spark, sf):
    first = clean.keep_first(bronze_incidents(spark, sf), ["crime_id"], INGESTED, total_order=True)
    return quality.flag_summary(quality.with_incident_flags(first), ["has_outcome", "has_street", "has_nothing"])


_NULLS = " union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as null_count, count(*) as total from assets_raw" for c in ("lat", "lon", "operator", "name", "substance", "material", "diameter", "location", "id"))


@query("dq5_nulls", f"select column_name, null_count, round(null_count * 1.0::double / total * 100, 1) as null_percent from ({_NULLS}) where null_count > 0 order by 2 desc, 1")
def dq5(spark, sf):
    return quality.null_counts(bronze_assets(spark, sf), ["lat", "lon", "operator", "name", "substance", "material", "diameter", "location", "id"])


@query("dq7_ranges", f"select count(*) as records, count(la) as with_lat, {stable('min(la)')} as min_lat, {stable('max(la)')} as max_lat, {stable('min(lo)')} as min_lon, {stable('max(lo)')} as max_lon, "
       "count(*) filter (" + _IN_BOX.format("la", "lo") + ") as inside_bbox from (select try_cast(lat as double) as la, try_cast(lon as double) as lo from incidents_raw)")
def dq7(spark, sf):
    ranges = quality.coordinate_ranges(bronze_incidents(spark, sf))
    return ranges.select("records", "with_lat", six("min_lat"), six("max_lat"), six("min_lon"), six("max_lon"), "inside_bbox")


@query("dq8_missing", "select type, infrastructure_type, count(*) as missing from assets_raw where lat is null group by 1, 2")
def dq8(spark, sf):
    return quality.missing_coordinates(bronze_assets(spark, sf))


_FIELDS = " union all ".join(f"select '{c}' as field, count({c}) as filled, count(*) as total from assets_raw" for c in K.ASSET_REPORTED_FIELDS)


@query("dq9_completeness", f"select field, filled, total, round(filled * 1.0::double / total * 100, 1) as filled_percent, case when filled * 1.0::double / total * 100 > 50 then 'good' else 'sparse' end as status from ({_FIELDS})")
def dq9(spark, sf):
    return quality.field_completeness(bronze_assets(spark, sf))


@query("dq10_ratios", f"select {stable('avg((lat is not null)::int)')} as completeness, {stable('avg((operator is not null)::int)')} as has_operator, "
       f"{stable('avg((substance is not null or material is not null or diameter is not null)::int)')} as has_metadata from assets_raw")
def dq10(spark, sf):
    return quality.asset_ratios(bronze_assets(spark, sf)).select(six("completeness"), six("has_operator"), six("has_metadata"))


@query("dq10_incident_ratios", f"select {stable('avg((try_cast(lat as double) is not null)::int)')} as has_coords, {stable('avg((outcome_category is not null)::int)')} as has_outcome, "
       f"{stable('avg((street_name is not null)::int)')} as has_location from incidents_raw")
def dq10_incidents(spark, sf):
    return quality.incident_ratios(bronze_incidents(spark, sf)).select(six("has_coords"), six("has_outcome"), six("has_location"))


@query("dq11_duplicates", "select count(*) as records, count(distinct id) as distinct_keys, count(*) - count(distinct id) as duplicates from assets_raw")
def dq11(spark, sf):
    return quality.duplicate_counts(bronze_assets(spark, sf), ["id"])


@query("dq12_profile", "select dataset, records, columns, types from (select 'assets' as dataset, (select count(*) from assets_raw) as records, 16::bigint as columns, "
       "(select string_agg(t || '=' || n, ',' order by t) from (select infrastructure_type t, count(*) n from assets_raw group by 1)) as types "
       "union all select 'incidents', (select count(*) from incidents_raw), 13, (select string_agg(t || '=' || n, ',' order by t) from (select category t, count(*) n from incidents_raw group by 1)) "
       "union all select 'weather', (select count(*) from weather_raw), 20, null)")
def dq12(spark, sf):
    report = quality.profile({
        "assets": (bronze_assets(spark, sf), "infrastructure_type"), "incidents": (bronze_incidents(spark, sf), "category"),
        "weather": (bronze_weather(spark, sf), None),
    })
    shown = F.array_join(F.transform(F.map_entries("types"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return report.select("dataset", "records", F.size("columns").cast("long").alias("columns"), F.when(F.size("types") > 0, shown).alias("types"))


@query("dq12_types", "select 'assets' as dataset, infrastructure_type as type, count(*) as records from assets_raw group by 2 union all "
       "select 'incidents', category, count(*) from incidents_raw group by 2 union all select 'streets', cast(street_id as varchar), count(*) from incidents_raw group by 2 union all select 'weather', null, count(*) from weather_raw")
def dq12_types(spark, sf):
    incidents = bronze_incidents(spark, sf)
    return quality.type_counts({
        "assets": (bronze_assets(spark, sf), "infrastructure_type"), "incidents": (incidents, "category"), "streets": (incidents, "street_id"),
        "weather": (bronze_weather(spark, sf), None),
    })


@query("dq13_gates", f"select gate, {stable('value')} as value, lim as limit_value, (case when gate = 'bbox_outliers' then value <= lim else value >= lim end)::int as passed from "
       "(select 'coordinate_completeness' as gate, avg((lat is not null and lon is not null)::int) as value, 0.9::double as lim from assets union all "
       "select 'projection_success', count(easting_bng) * 1.0::double / count(*) filter (lat is not null and lon is not null), 0.95::double from assets union all "
       "select 'bbox_outliers', count(*) filter (lat is not null and lon is not null and not is_valid_location) * 1.0::double / count(*) filter (lat is not null and lon is not null), 0.05::double from assets)")
def dq13(spark, sf):
    gates = quality.quality_gates(filters.flag_inside(_asset_points(spark, sf)))
    return gates.select("gate", six("value"), F.col("limit").alias("limit_value"), flag("passed"))


@query("dq14_reconcile", "select 'rows_in' as metric, count(*) as value from assets_raw union all select 'missing_in', count(*) from assets_raw where lat is null union all "
       "select 'rows_out', count(*) from assets union all select 'missing_out', count(*) from assets where lat is null union all "
       "select 'enriched', count(postcode) from assets union all select 'measured', count(length_meters) from assets")
def dq14(spark, sf):
    bronze = bronze_assets(spark, sf)
    return quality.asset_reconciliation(bronze, silver.silver_assets(bronze, bronze_places(spark, sf), RUN_TIME, INGESTED))


@query("dq16_grid_range", "select min(eastings) as min_easting, max(eastings) as max_easting, min(northings) as min_northing, max(northings) as max_northing from places_raw where postcode_type = 'outward_code'")
def dq16(spark, sf):
    return bronze_places(spark, sf).where("postcode_type = 'outward_code'").agg(
        F.min("eastings").alias("min_easting"), F.max("eastings").alias("max_easting"), F.min("northings").alias("min_northing"), F.max("northings").alias("max_northing"),
    )


# --- flattening -------------------------------------------------------------------
@query("flt1_elements", "select id, type, coalesce(nullif(man_made, ''), nullif(power_tag, ''), 'unknown') as infrastructure_type, operator, substance, "
       f"case when type = 'way' then vertices end as node_count, case when type = 'way' then vertices end as geometry_points, {stable('case when vertices > 0 then v0lat end')} as first_lat, "
       f"{stable('case vertices when 1 then v0lon when 2 then v1lon when 3 then v2lon end')} as last_lon, (vertices > 0)::int as drawn from (select * replace (coalesce(vertices, 0) as vertices) from elements)",
       elements=_ELEMENTS)
def flt1(spark, sf):
    flat = flatten.flatten_elements(raw_elements(spark, sf))
    return flat.select("id", "type", "infrastructure_type", "operator", "substance", "node_count", "geometry_points", six("first_lat"), six("last_lon"),
                       flag(F.col("geometry_json").isNotNull(), "drawn"))


@query("flt2_incidents", "select crime_id, category, month, (try_cast(lat as double) is not null)::int as numeric_lat, street_id, street_name, outcome_category, outcome_date from incidents_raw")
def flt2(spark, sf):
    flat = view(spark, sf, "incidents_raw")
    outcome = F.when(F.col("outcome_category").isNotNull(), F.struct(F.col("outcome_category").alias("category"), F.col("outcome_date").alias("date")))
    nested = flat.select(
        F.col("crime_id").alias("id"), "persistent_id", "category", "month", "location_type", F.lit(None).cast("string").alias("location_subtype"), F.lit("").alias("context"),
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.struct(F.col("street_id").alias("id"), F.col("street_name").alias("name")).alias("street")).alias("location"),
        outcome.alias("outcome_status"),
    )
    out = flatten.flatten_incidents(nested)
    return out.select("crime_id", "category", "month", flag(scalars.to_number(F.col("lat")).isNotNull(), "numeric_lat"), "street_id", "street_name", "outcome_category", "outcome_date")


@query("flt3_weather", "select coalesce(case when event_id % 9 = 0 then null else 1700000000 + event_id * 977 end, 0) as seconds, 500 + event_id % 5 as weather_id, event_type as weather_main, value as temp_celsius, "
       "case when event_id % 4 = 0 then value end as rain_1h_mm, case when event_id % 3 = 0 then value end as wind_gust_ms, 'GB' as country from events")
def flt3(spark, sf):
    e = table(spark, sf, "events")
    value, key = F.col("value"), F.col("event_id")
    main = ("temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity")
    condition = F.struct((500 + key % 5).cast("int").alias("id"), F.col("event_type").alias("main"), F.lit("d").alias("description"), F.lit("01d").alias("icon"))
    nested = e.select(
        F.lit("Town").alias("name"), F.when(key % 9 != 0, F.lit(1700000000) + key * 977).alias("dt"), F.lit(0).alias("timezone"), F.lit(10000.0).alias("visibility"),
        F.struct(F.lit(53.4).alias("lat"), F.lit(-2.15).alias("lon")).alias("coord"), F.array(condition, condition).alias("weather"),
        F.struct(*[value.alias(m) for m in main]).alias("main"),
        F.struct(value.alias("speed"), value.alias("deg"), F.when(key % 3 == 0, value).alias("gust")).alias("wind"), F.struct(value.alias("all")).alias("clouds"),
        F.struct(F.lit("GB").alias("country"), key.alias("sunrise"), key.alias("sunset")).alias("sys"),
        F.when(key % 4 == 0, F.struct(value.alias("1h"))).alias("rain"), F.lit(None).cast("struct<`1h`:double>").alias("snow"),
    )
    return flatten.flatten_weather(nested).select(F.unix_timestamp("datetime").alias("seconds"), F.col("weather_id").cast("long").alias("weather_id"), "weather_main", "temp_celsius", "rain_1h_mm", "wind_gust_ms", "country")


def _flattened_places(spark, sf):
    base = bronze_places(spark, sf).withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
    outward = base.where("postcode_type = 'outward_code'").select(
        F.col("postcode").alias("outcode"), "latitude", "longitude", "eastings", "northings", F.array("admin_district").alias("admin_district"),
        F.array().cast("array<string>").alias("admin_county"), F.array("country", F.lit("other")).alias("country"), "region",
    )
    full = base.where("postcode_type = 'full_postcode'").withColumn("admin_county", F.lit(None).cast("string"))
    return flatten.flatten_places(outward, full)


@query("flt4_places", "select postcode, postcode_type, eastings, northings, admin_district, admin_ward, parish_kept as parish, region, country, case when postcode_type = 'outward_code' then null else parliamentary_constituency end as parliamentary_constituency "
       "from (select *, case when postcode_type = 'outward_code' then null else parish end as parish_kept from places_raw)")
def flt4(spark, sf):
    return _flattened_places(spark, sf).select("postcode", "postcode_type", "eastings", "northings", "admin_district", "admin_ward", "parish", "region", "country", "parliamentary_constituency")


@query("flt5_ingestion", "select o_orderkey, '2025-01-01' as ingestion_date, 'orders_feed' as source_api, o_orderstatus as area from orders")
def flt5(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("area"))
    return clean.with_ingestion(orders, RUN_TIME, source="orders_feed", area="kept as given").select("o_orderkey", text("ingestion_date"), "source_api", "area")
