"""Queries for incremental loads, sketches, partial states, stateful streams and audited publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridstone.functions import geo
from gridstone.operators import clean, filters, sketches, summarise
from gridstone.plans import silver
from gridstone.session import scratch_path
from gridstone.sources import incremental, publish, readers
from gridstone.streaming import jobs, partials, stateful
from gridstone.workload.files import RUN_TIME, _arriving, _by_month, _finished, _kept, _table_name
from gridstone.workload.oracle import stable
from gridstone.workload.registry import flag, query, six, text
from gridstone.workload.views import INGESTED, bronze_assets, bronze_places, table

_ASSET_COLUMNS = ("id", "ingestion_timestamp", "source_seq", "type", "infrastructure_type", "operator", "name")


@query("win2_incremental", "select id, cast(ingestion_timestamp as varchar) as first_seen, source_seq, infrastructure_type, operator, name from assets_first")
def win2_incremental(spark, sf):
    """Elements loaded in three parts that overlap and bring earlier copies late, into a table partitioned by type."""
    name, assets = _table_name(spark, "win2"), bronze_assets(spark, sf).select(*_ASSET_COLUMNS)
    for part in range(3):
        incremental.load_first(assets.where(F.col("source_seq") % 3 != part), name, ["id"], INGESTED, ["infrastructure_type"])
    stored = readers.read_table(spark, name).select("id", text("ingestion_timestamp", "first_seen"), "source_seq", "infrastructure_type", "operator", "name")
    return _kept(stored, "win2", name, incremental.directory_of(name))


@query("snk4_incremental", "select infrastructure_type, count(*) as records, min(id) as first_id, (select count(*) from assets_first) as added, 0 as again from assets_first group by 1")
def snk4_incremental(spark, sf):
    """One load of everything, and the same once more, which changes nothing."""
    name, assets = _table_name(spark, "snk4i"), bronze_assets(spark, sf).select(*_ASSET_COLUMNS)
    first, second = (incremental.load_first(assets, name, ["id"], INGESTED, ["infrastructure_type"]) for _ in range(2))
    stored = readers.read_table(spark, name).groupBy("infrastructure_type").agg(F.count("*").alias("records"), F.min("id").alias("first_id"))
    stored = stored.withColumns({"added": F.lit(first.added).cast("long"), "again": F.lit(second.added + second.replaced + second.partitions)})
    return _kept(stored, "snk4i", name, incremental.directory_of(name))


# --- sketches ----------------------------------------------------------------------
_LINES = ("l_orderkey", "l_partkey", "l_suppkey")


@query("agg2_sketch", "select l_returnflag, count(*) as records, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers, 1 as within from lineitem group by 1")
def agg2_sketch(spark, sf):
    """Monthly cells keep sketches; flags get theirs from the cells. The exact counts stand beside them."""
    lines = table(spark, sf, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    stored = scratch_path(spark, "agg2-cells")
    sketches.distinct_cells(lines, ["l_returnflag", "month"], _LINES).write.parquet(stored)
    merged = sketches.estimated(sketches.rolled_up(spark.read.parquet(stored), ["l_returnflag"], _LINES), _LINES)
    exact = lines.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))
    within = [sketches.agrees(f"{c}_estimate", e) for c, e in zip(_LINES, ("orders", "parts", "suppliers"), strict=True)]
    return merged.join(exact, "l_returnflag").select("l_returnflag", "records", "orders", "parts", "suppliers", (within[0] & within[1] & within[2]).cast("int").alias("within"))


@query("agg6_sketch", "select cast(date_trunc('month', ts) as date)::varchar as month, count(*) as records, count(distinct user_id) as users, 1 as within from events group by 1")
def agg6_sketch(spark, sf):
    """Days rolled up to months."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    months = sketches.rolled_up(sketches.distinct_cells(events, ["day", "event_type"], ["user_id"]), [F.trunc("day", "month").alias("month")], ["user_id"])
    exact = events.groupBy(F.trunc("day", "month").alias("month")).agg(F.count_distinct("user_id").alias("users"))
    both = sketches.estimated(months, ["user_id"]).join(exact, "month")
    return both.select(text("month"), "records", "users", sketches.agrees("user_id_estimate", "users").cast("int").alias("within"))


@query("agg13_sketch", "select c_mktsegment as district, count(*) as records, count(distinct c_nationkey) as wards, count(distinct c_custkey) as customers, 1 as within from customer group by 1")
def agg13_sketch(spark, sf):
    """Wards rolled up to districts."""
    customers = table(spark, sf, "customer")
    cells = sketches.distinct_cells(customers, ["c_mktsegment", "c_nationkey"], ["c_custkey", "c_nationkey"])
    districts = sketches.estimated(sketches.rolled_up(cells.withColumnRenamed("c_mktsegment", "district"), ["district"], ["c_custkey", "c_nationkey"]), ["c_custkey", "c_nationkey"])
    exact = customers.groupBy(F.col("c_mktsegment").alias("district")).agg(F.count_distinct("c_nationkey").alias("wards"), F.count_distinct("c_custkey").alias("customers"))
    within = sketches.agrees("c_custkey_estimate", "customers") & sketches.agrees("c_nationkey_estimate", "wards")
    return districts.join(exact, "district").select("district", "records", "wards", "customers", within.cast("int").alias("within"))


@query("agg14_sketch", "select l_returnflag, count(l_extendedprice) as n, 1 as within from lineitem group by 1")
def agg14_sketch(spark, sf):
    """Quartiles merged from monthly sketches; the share of rows up to each is off by less than the stated error."""
    lines = table(spark, sf, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    cells = sketches.quantile_cells(lines, ["l_returnflag", "month"], "l_extendedprice")
    cut = sketches.at_ranks(sketches.merged_quantiles(cells, ["l_returnflag"]), summarise.QUARTILES)
    price = F.col("l_extendedprice")
    checks = []
    for name, share in summarise.QUARTILES.items():
        below, upto = F.count_if(price < F.col(name)), F.count_if(price <= F.col(name))
        near = F.lit(share + sketches.RANK_ERROR) * F.count(price) >= below
        checks.append(near & (F.lit(share - sketches.RANK_ERROR) * F.count(price) <= upto))
    judged = lines.join(F.broadcast(cut), "l_returnflag").groupBy("l_returnflag").agg(F.count(price).alias("n"), (checks[0] & checks[1] & checks[2]).cast("int").alias("within"))
    return judged


# --- streams -----------------------------------------------------------------------
@query("str4_partials", f"select substring(cast(o_orderdate as varchar), 1, 7) as month, count(*) as records, round(sum(o_totalprice) + 1e-9, 2) as total, min(o_totalprice) as smallest, max(o_totalprice) as largest, {stable('avg(o_totalprice)')} as average, "
       "count(distinct o_custkey) as customers, 1 as within from orders group by 1")
def str4_partials(spark, sf):
    """Three batches, the states of the first two merged into one before the third comes; then all merged again."""
    out, state = (scratch_path(spark, f"str4p-{n}") for n in ("out", "state"))
    orders = _by_month(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "month")
    args = (["month"], ["o_totalprice"], ["o_custkey"])
    parts = [orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == i) for i in range(3)]
    landing = scratch_path(spark, "str4p-in")
    for i, part in enumerate(parts):
        if i == 2:
            partials.compact(spark, out, args[0])
        part.write.mode("append").parquet(landing)
        _finished(partials.keep_partials(jobs.follow_snapshots(spark, landing, part.schema, "parquet"), out, state, *args))
    done = partials.finished(partials.read_partials(spark, out), *args)
    exact = orders.groupBy("month").agg(F.count_distinct("o_custkey").alias("customers"))
    return done.join(exact, "month").select(
        "month", "records", F.round(F.col("total_o_totalprice") + 1e-9, 2).alias("total"), F.col("min_o_totalprice").alias("smallest"), F.col("max_o_totalprice").alias("largest"),
        six("avg_o_totalprice", "average"), "customers", sketches.agrees("o_custkey_estimate", "customers").cast("int").alias("within"))


@query("str2_earliest", "select user_id, event_type, min(event_id) as event_id from (select user_id, event_type, event_id, rank() over (partition by user_id, event_type order by ts) as r from events) where r = 1 group by 1, 2")
def str2_earliest(spark, sf):
    """Three batches in the order of time, a third of each batch's last two days arriving with the next one,
    so that first answers are corrected; a key is forgotten three days later, long before the data end."""
    out, state = (scratch_path(spark, f"str2e-{n}") for n in ("out", "state"))
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    seconds = F.unix_seconds("ts")
    low, high, count = events.agg(F.min(seconds), F.max(seconds), F.count("*")).first()
    turn = F.floor((seconds - low) * 3 / F.lit(high - low + 1))
    late = (F.col("event_id") % 3 == 0) & (F.floor((seconds + 2 * 86_400 - low) * 3 / F.lit(high - low + 1)) > turn) & (turn < 2)
    parts = [events.where(turn + late.cast("int") == i) for i in range(3)]

    def run(stream):
        return jobs.append_files(stateful.first_by_ingestion(stream, ["user_id", "event_type"], "ts", ["event_id"], "3 days", max(64, count // 5000)), out, state, mode="update")

    before = spark.conf.get(stateful.STORE[0], None)
    spark.conf.set(*stateful.STORE)
    try:
        _arriving(spark, parts, "str2e", run)
    finally:
        spark.conf.set(stateful.STORE[0], before) if before else spark.conf.unset(stateful.STORE[0])
    # A key that came again after it was forgotten has been answered more than once.
    return clean.keep_first(readers.read_path(spark, out), ["user_id", "event_type"], ["ts", "event_id"], total_order=True).select("user_id", "event_type", "event_id")


# --- audited loads -----------------------------------------------------------------
_GATE = "select '{load}' as load, gate, {value} as value, passed, {out} as published, {good} as visible, {bad} as quarantined from ({gates})"


def _gates_sql(source: str) -> str:
    located = "lat is not null and lon is not null"
    return (f"select 'coordinate_completeness' as gate, avg(({located})::int) as value, (avg(({located})::int) >= 0.9)::int as passed from {source} union all "
            f"select 'projection_success', count(easting_bng) filter ({located}) * 1.0::double / count(*) filter ({located}), 1 from {source} union all "
            f"select 'bbox_outliers', count(*) filter ({located} and not is_valid_location) * 1.0::double / count(*) filter ({located}), "
            f"(count(*) filter ({located} and not is_valid_location) * 1.0::double / count(*) filter ({located}) <= 0.6)::int from {source}")


_PUBLISH = {
    "pub_points": "select p.id, p.lat, p.lon, g.e as easting_bng, a.is_valid_location from assets_point p left join assets_grid g using (id) join assets a using (id)",
    "pub_damaged": "select id, case when id % 4 <> 0 then lat end as lat, lon, case when id % 4 <> 0 then easting_bng end as easting_bng, is_valid_location and id % 4 <> 0 as is_valid_location from pub_points",
}


# The elements lie around the box rather than in it, so its gate is wider here.
_GATES = (("coordinate_completeness", ">=", 0.9), ("projection_success", ">=", 0.95), ("bbox_outliers", "<=", 0.6))


@query("dq13_publish", " union all ".join(_GATE.format(
    load=load, value=stable("value"), gates=_gates_sql(source), out=out, good="(select count(*) from pub_points where lat is not null and lon is not null)",
    bad=f"(select count(*) from {source} where not coalesce(lat is not null and lon is not null, false))") for load, source, out in (("first", "pub_points", 1), ("second", "pub_damaged", 0))), **_PUBLISH)
def dq13_publish(spark, sf):
    """A sound load is published; the next one lost a quarter of its latitudes and is not."""
    points = filters.flag_inside(geo.with_bng(silver.repaired_assets(clean.keep_first(bronze_assets(spark, sf), ["id"], INGESTED, total_order=True))))
    points = points.select("id", "lat", "lon", "easting_bng", "northing_bng", "is_valid_location")
    name, out = _table_name(spark, "published"), []
    lost = F.col("id") % 4 == 0
    damaged = points.withColumns({**{c: F.when(~lost, F.col(c)) for c in ("lat", "easting_bng", "northing_bng")}, "is_valid_location": F.col("is_valid_location") & ~lost})
    for label, rows in (("first", points), ("second", damaged)):
        path = scratch_path(spark, label)
        audit = publish.load(rows, name, path, {"located": F.col("lat").isNotNull() & F.col("lon").isNotNull()}, _GATES)
        counts = {"published": F.lit(int(audit.published)), "visible": F.lit(spark.table(name).count()).cast("long"), "quarantined": F.lit(publish.quarantine(spark, path).count()).cast("long")}
        out.append(audit.report(spark).drop("published").withColumns(counts).select(F.lit(label).alias("load"), "gate", six("value"), flag("passed"), "published", "visible", "quarantined"))
    spark.sql(f"DROP VIEW {name}")
    return out[0].unionByName(out[1])


@query("dq14_observed", "select 'rows_in' as metric, count(*) as value from assets_raw union all select 'missing_in', count(*) from assets_raw where lat is null union all "
       "select 'rows_out', count(*) from assets union all select 'missing_out', count(*) from assets where lat is null union all "
       "select 'enriched', count(postcode) from assets union all select 'measured', count(length_meters) from assets")
def dq14_observed(spark, sf):
    """The figures of the load itself, observed while it writes."""
    return silver.load_assets(bronze_assets(spark, sf), bronze_places(spark, sf), scratch_path(spark, "dq14"), RUN_TIME, INGESTED)
