"""Queries for sources, sinks and streams. Each writes to the shared folder and reads back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridstone import schemas
from gridstone.session import scratch_path
from gridstone.sources import flatten, readers, sinks
from gridstone.streaming import jobs
from gridstone.workload.oracle import stable
from gridstone.workload.registry import query, six, text
from gridstone.workload.steps import _ELEMENTS, raw_elements
from gridstone.workload.views import bronze_assets, bronze_incidents, bronze_places, bronze_weather, table

RUN_TIME = datetime(2025, 1, 1)
_ORDERS = "o_orderkey bigint, o_orderpriority string, o_totalprice double, o_orderdate date, o_clerk string"


@query("src1_csv", f"select o_orderpriority, count(*) as records, {stable('sum(o_totalprice)')} as total, cast(min(cast(o_orderdate as date)) as varchar) as first_day, count(*) as no_clerk from orders group by 1")
def src1(spark, sf):
    path = scratch_path(spark, "src1")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    sinks.write_summary_csv(orders.withColumn("o_clerk", F.lit(None).cast("string")), path, ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate", "o_clerk"])
    back = readers.read_csv(spark, path, _ORDERS)
    return back.groupBy("o_orderpriority").agg(
        F.count("*").alias("records"), six(F.sum("o_totalprice"), "total"), F.min("o_orderdate").cast("string").alias("first_day"),
        F.count_if(F.col("o_clerk").isNull()).alias("no_clerk"),
    )


@query("src2_partitioned", "select substring(cast(o_orderdate as varchar), 1, 4) as order_year, o_orderpriority, count(*) as records from orders where substring(cast(o_orderdate as varchar), 1, 4) in ('1996', '1998') group by 1, 2")
def src2(spark, sf):
    path = scratch_path(spark, "src2")
    orders = table(spark, sf, "orders").withColumn("order_year", F.date_format("o_orderdate", "yyyy"))
    sinks.write_parquet(orders, path, ["order_year"])
    back = readers.read_partitioned(spark, path, "o_orderkey bigint, o_orderpriority string, order_year string")
    return back.where(F.col("order_year").isin("1996", "1998")).groupBy("order_year", "o_orderpriority").agg(F.count("*").alias("records"))


@query("src4_external_table", "select l_returnflag, count(*) as records, count(*) as by_path from lineitem group by 1")
def src4(spark, sf):
    path = scratch_path(spark, "src4")
    name = "lines_" + path.rsplit("-", 1)[1]
    sinks.write_external(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), name, path)
    by_name = readers.read_table(spark, name).groupBy("l_returnflag").agg(F.count("*").alias("records"))
    by_path = readers.read_path(spark, path).groupBy("l_returnflag").agg(F.count("*").alias("by_path"))
    return _kept(by_name.join(by_path, "l_returnflag"), "src4-report", name)


@query("src5_snapshots", "select coalesce(nullif(man_made, ''), nullif(power_tag, ''), 'unknown') as infrastructure_type, count(*) as records, coalesce(sum(vertices), 0)::bigint as points, 'elements_api' as source_api from elements group by 1", elements=_ELEMENTS)
def src5(spark, sf):
    wrapped = raw_elements(spark, sf).select(
        F.struct(F.array(F.struct("*")).alias("elements")).alias("raw_data"),
        F.struct(F.lit(RUN_TIME).alias("ingestion_timestamp"), F.lit("elements_api").alias("source_api"), F.lit("area").alias("area"), F.lit(RUN_TIME.date()).alias("ingestion_date")).alias("metadata"),
    )
    written = sinks.write_snapshot(wrapped, scratch_path(spark, "src5"), RUN_TIME)
    snapshots = readers.read_snapshots(spark, written.path, schemas.ELEMENT_SNAPSHOT, multi_line=False)
    flat = flatten.flatten_elements(flatten.unwrap(snapshots, "raw_data.elements"))
    return flat.groupBy("infrastructure_type").agg(F.count("*").alias("records"), F.coalesce(F.sum("geometry_points"), F.lit(0)).alias("points"), F.first("source_api").alias("source_api"))


@query("snk1_partitioned", "select infrastructure_type, count(*) as records, (select count(*) from assets_raw) as written from assets_raw group by 1")
def snk1(spark, sf):
    result = sinks.write_parquet(bronze_assets(spark, sf), scratch_path(spark, "snk1"), ["infrastructure_type"], files_per_partition=4)
    return readers.read_partitioned(spark, result.path).groupBy("infrastructure_type").agg(F.count("*").alias("records"), F.lit(result.records).cast("long").alias("written"))


@query("snk8_export", "select 'by_category' as export, replace(category, '-', '_') as export_group, count(*) as records from incidents_raw group by 2 union all "
       "select 'coordinates', null, count(*) from incidents_raw where try_cast(lat as double) is not null and try_cast(lon as double) is not null union all select 'full', null, count(*) from incidents_raw union all select 'simple', null, count(*) from incidents_raw")
def snk8(spark, sf):
    root = scratch_path(spark, "snk8")
    sinks.export_csv(bronze_incidents(spark, sf), root, ["crime_id", "category", "month"], "category", ["crime_id", "category", "lat", "lon"])

    def counted(name, *by):
        rows = spark.read.option("header", True).csv(f"{root}/{name}").groupBy(*by).agg(F.count("*").alias("records"))
        return rows.select(F.lit(name).alias("export"), (F.col("export_group") if by else F.lit(None)).cast("string").alias("export_group"), "records")

    return counted("by_category", "export_group").unionAll(counted("coordinates")).unionAll(counted("full")).unionAll(counted("simple"))


@query("snk8_summary", "select 'assets' as dataset, count(*) as total_records, count(*) filter (lat is not null and lon is not null) as has_coordinates from assets_raw union all "
       "select 'incidents', count(*), count(*) filter (try_cast(lat as double) is not null and try_cast(lon as double) is not null) from incidents_raw union all "
       "select 'weather', count(*), count(*) from weather_raw union all select 'places', count(*), count(*) from places_raw")
def snk8_summary(spark, sf):
    return sinks.dataset_summary({
        "assets": bronze_assets(spark, sf), "incidents": bronze_incidents(spark, sf), "weather": bronze_weather(spark, sf), "places": bronze_places(spark, sf),
    })


@query("snk9_log", "select 'incidents' as data_type, count(*) as record_count, 'success' as status from incidents_raw union all select 'nothing', 0, 'no_data'")
def snk9(spark, sf):
    log = scratch_path(spark, "snk9")
    incidents = bronze_incidents(spark, sf)
    for name, frame in (("incidents", incidents), ("nothing", incidents.where("crime_id < 0"))):
        sinks.log_ingestion(spark, log, name, sinks.write_parquet(frame, scratch_path(spark, name)), RUN_TIME)
    return readers.read_path(spark, log).select("data_type", "record_count", "status")


@query("snk_clustered", "select infrastructure_type, count(*) as records, min(id) as first_id from assets_raw group by 1")
def clustered_rewrite(spark, sf):
    path = scratch_path(spark, "clustered")
    sinks.cluster_files(bronze_assets(spark, sf), path, ["infrastructure_type", "id"])
    return readers.read_path(spark, path).groupBy("infrastructure_type").agg(F.count("*").alias("records"), F.min("id").alias("first_id"))


# --- managed tables ----------------------------------------------------------------
def _table_name(spark, label):
    return scratch_path(spark, label).rsplit("/", 1)[1].replace("-", "_")


def _kept(df, label, *tables):
    """The rows of a report, written; the tables it was made from are dropped."""
    path, spark = scratch_path(df.sparkSession, label), df.sparkSession
    df.write.parquet(path)
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema(df.schema).parquet(path)


def _by_month(spark, sf):
    return table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))


@query("snk3_overwrite", "select substring(cast(o_orderdate as varchar), 1, 7) as month, count(*) as records, round(max(o_totalprice), 2) as largest, "
       "'o_orderkey,o_totalprice,month' as columns, (select count(*) from orders) as written from orders group by 1")
def snk3(spark, sf):
    """A table replaced by one of another schema and partitioning."""
    name = _table_name(spark, "snk3")
    sinks.overwrite_table(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), name)
    result = sinks.overwrite_table(_by_month(spark, sf).select("o_orderkey", "o_totalprice", "month"), name, partition_by=["month"])
    back = readers.read_table(spark, name)
    report = back.groupBy("month").agg(F.count("*").alias("records"), F.round(F.max("o_totalprice"), 2).alias("largest"))
    report = report.withColumns({"columns": F.lit(",".join(back.columns)), "written": F.lit(result.records).cast("long")})
    return _kept(report, "snk3", name)


@query("snk4_append", "select o_orderstatus, count(*) as records, count(case when o_orderkey % 2 = 1 then o_totalprice end) as priced from orders group by 1")
def snk4(spark, sf):
    """The second append brings a column the table lacks."""
    name, orders = _table_name(spark, "snk4"), table(spark, sf, "orders")
    sinks.append_table(orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus"), name, partition_by=["o_orderstatus"])
    sinks.append_table(orders.where("o_orderkey % 2 = 1").select("o_totalprice", "o_orderkey", "o_orderstatus"), name, partition_by=["o_orderstatus"])
    report = readers.read_table(spark, name).groupBy("o_orderstatus").agg(F.count("*").alias("records"), F.count("o_totalprice").alias("priced"))
    return _kept(report, "snk4", name)


@query("snk6_move", "select o_orderstatus, count(*) as records, 0 as source_left, 'o_orderstatus' as partitioned_by from orders group by 1")
def snk6(spark, sf):
    source, target = _table_name(spark, "snk6"), _table_name(spark, "snk6_moved")
    sinks.overwrite_table(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), source, partition_by=["o_orderstatus"])
    sinks.move_table(spark, source, target)
    by = ",".join(c.name for c in spark.catalog.listColumns(target) if c.isPartition)
    report = readers.read_table(spark, target).groupBy("o_orderstatus").agg(F.count("*").alias("records"))
    report = report.withColumns({"source_left": F.lit(int(spark.catalog.tableExists(source))), "partitioned_by": F.lit(by)})
    return _kept(report, "snk6", target)


@query("snk12_verify", "select count(*) as written, count(*) as read_back, count(*) filter (lat is null or lon is null) as null_coordinates, "
       "count(distinct infrastructure_type) as partitions, 1 as complete from assets_raw")
def snk12(spark, sf):
    name = _table_name(spark, "snk12")
    assets = bronze_assets(spark, sf).select("id", "lat", "lon", "infrastructure_type")
    result = sinks.overwrite_table(assets, name, partition_by=["infrastructure_type"])
    report = sinks.verification(spark, name, result, partition_by="infrastructure_type")
    return _kept(report.withColumn("complete", F.col("complete").cast("int")), "snk12", name)


# --- streams ----------------------------------------------------------------------
def _stream(spark, sf, name):
    # A stream follows a folder or a pattern, not a single file.
    return jobs.follow_snapshots(spark, f"{sf}/{name}[.]parquet", table(spark, sf, name).schema, "parquet")


def _arriving(spark, parts, label, start):
    """Writes each part into a landing folder and runs the stream on it up to there."""
    landing = scratch_path(spark, f"{label}-in")
    for part in parts:
        part.write.mode("append").parquet(landing)
        _finished(start(jobs.follow_snapshots(spark, landing, part.schema, "parquet")))


def _finished(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@query("str1_ingest", "select category, count(*) as records, count(outcome_category) as with_outcome from incidents_raw group by 1")
def str1(spark, sf):
    landing, out, state = (scratch_path(spark, f"str1-{n}") for n in ("in", "out", "state"))
    outcome = F.when(F.col("outcome_category").isNotNull(), F.struct(F.col("outcome_category").alias("category"), F.col("outcome_date").alias("date")))
    raw = bronze_incidents(spark, sf).select(F.col("crime_id").alias("id"), "persistent_id", "category", "month", "location_type",
                                             F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("location"), outcome.alias("outcome_status"))
    sinks.write_snapshot(raw, landing, RUN_TIME)
    stream = jobs.follow_snapshots(spark, f"{landing}/*", schemas.RAW_INCIDENT)
    _finished(jobs.append_files(flatten.flatten_incidents(stream), out, state))
    return readers.read_path(spark, out).groupBy("category").agg(F.count("*").alias("records"), F.count("outcome_category").alias("with_outcome"))


@query("str2_dedup", "select distinct user_id, event_type from events")
def str2(spark, sf):
    out, state = (scratch_path(spark, f"str2-{n}") for n in ("out", "state"))
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))

    def unique(stream):
        return jobs.append_files(jobs.drop_reingested(stream, ["user_id", "event_type"], "ts", "60 days"), out, state)

    _arriving(spark, [events, events], "str2", unique)  # everything comes twice, in batches of their own
    return readers.read_path(spark, out).select("user_id", "event_type")


@query("str3_daily", f"select cast(cast(ts as date) as varchar) as date, {stable('avg(value)')} as avg_temperature, min(value) as min_temperature, max(event_type) as dominant_weather, count(*) as observation_count "
       "from events group by 1")
def str3(spark, sf):
    """All days, the open ones as far as they have come; the day between two batches gets rows from both."""
    out, state = (scratch_path(spark, f"str3-{n}") for n in ("out", "state"))
    value = F.col("value")
    # The table's times carry no zone; they are read as UTC.
    moment = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    events = table(spark, sf, "events").select(
        moment.alias("datetime"), value.alias("temp_celsius"), value.alias("humidity_percent"), value.alias("wind_speed_ms"),
        F.lit(None).cast("double").alias("rain_1h_mm"), F.col("event_type").alias("weather_main"),
    )
    middle = F.lit(events.agg(F.percentile_approx(F.unix_micros("datetime"), 0.5)).first()[0])
    early = F.unix_micros("datetime") < middle
    parts = [events.where(early), events.where(~F.coalesce(early, F.lit(False)))]
    _arriving(spark, parts, "str3", lambda s: jobs.replace_changed(jobs.daily_weather(s, "2 days"), "date", out, state))
    return readers.read_path(spark, out).select(text("date"), six("avg_temperature"), "min_temperature", "dominant_weather", "observation_count")


@query("str4_refresh", "select substring(cast(o_orderdate as varchar), 1, 7) as month, count(*) as records, round(max(o_totalprice), 2) as largest from orders group by 1")
def str4(spark, sf):
    out, state = (scratch_path(spark, f"str4-{n}") for n in ("out", "state"))

    stored = scratch_path(spark, "str4-history")
    history = _by_month(spark, sf).select("o_orderkey", "o_totalprice", "month")
    sinks.write_parquet(history, stored, ["month"])

    def per_month(orders):
        return orders.groupBy("month").agg(F.count("*").alias("records"), F.round(F.max("o_totalprice"), 2).alias("largest"))

    arriving = _stream(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    _finished(jobs.refresh_partitions(arriving, lambda: spark.read.schema(history.schema).parquet(stored), per_month, "month", out, state))
    return readers.read_partitioned(spark, out, "records bigint, largest double, month string")
