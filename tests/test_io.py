from datetime import datetime

import pytest
from pyspark.sql import functions as F

import fixtures
from gridstone import schemas
from gridstone.sources import flatten, readers, sinks
from gridstone.streaming import jobs

RUN = datetime(2025, 1, 1, 12)


def test_csv_keeps_lines_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name,day\n1,"a, quoted",2025-01-02\nx,b,2025-01-03\n')
    rows = readers.read_csv(spark, str(path), "id int, name string, day date", "corrupt").collect()
    assert (rows[0].id, rows[0].name, rows[0].corrupt) == (1, "a, quoted", None)
    assert rows[1].id is None and rows[1].corrupt == "x,b,2025-01-03"


def test_parquet_partitions_come_back_and_prune(spark, tmp_path):
    path = str(tmp_path / "out")
    written = sinks.write_parquet(fixtures.incidents(spark), path, ["category"])
    assert (written.path, written.records) == (path, 27)
    back = readers.read_partitioned(spark, path).where("category = 'burglary'")
    assert back.count() == 3
    assert "PartitionFilters: [isnotnull(category" in back._jdf.queryExecution().executedPlan().toString()


def test_empty_input_writes_nothing(spark, tmp_path):
    path = tmp_path / "nothing"
    assert sinks.write_parquet(fixtures.incidents(spark).where("false"), str(path)) == sinks.Written(None, 0)
    assert not path.exists()


def test_ingestion_log(spark, tmp_path):
    log = str(tmp_path / "log")
    sinks.log_ingestion(spark, log, "crime", sinks.Written("p", 5), RUN)
    sinks.log_ingestion(spark, log, "weather", sinks.Written(None, 0), RUN)
    assert sorted((r.data_type, r.status) for r in readers.read_path(spark, log).collect()) == [("crime", "success"), ("weather", "no_data")]


def test_snapshot_round_trip(spark, tmp_path):
    raw = spark.createDataFrame([(([(1, "node", 1.0, 2.0, {"power": "pole"}, None, None)],), (RUN, "api", "area", RUN.date()))], schemas.ELEMENT_SNAPSHOT)
    written = sinks.write_snapshot(raw, str(tmp_path), RUN)
    assert written.path.endswith("ingestion_ts=20250101_120000")
    back = readers.read_snapshots(spark, written.path, schemas.ELEMENT_SNAPSHOT)
    row = flatten.flatten_elements(flatten.unwrap(back, "raw_data.elements")).first()
    assert (row.infrastructure_type, row.source_api, row.ingestion_timestamp) == ("pole", "api", RUN)


def test_tables(spark, tmp_path):
    spark.sql("create schema if not exists bronze")
    spark.sql("create schema if not exists silver")
    df = spark.createDataFrame([(1, "a")], "id int, kind string")
    assert sinks.overwrite_table(df, "bronze.t_over").records == 1
    sinks.overwrite_table(df.withColumn("extra", F.lit(2)), "bronze.t_over")
    assert spark.table("bronze.t_over").columns == ["id", "kind", "extra"] and sinks.verify_table(spark, "bronze.t_over", 1)

    sinks.append_table(df, "bronze.t_app", partition_by=["kind"])
    sinks.append_table(df.select("kind", F.lit(9).alias("fresh"), "id"), "bronze.t_app", partition_by=["kind"])
    got = sorted((r.id, r.fresh or 0, r.kind) for r in spark.table("bronze.t_app").collect())
    assert got == [(1, 0, "a"), (1, 9, "a")]

    sinks.write_external(df, "bronze.t_ext", str(tmp_path / "ext"))
    assert spark.table("bronze.t_ext").count() == 1 and readers.read_path(spark, str(tmp_path / "ext")).count() == 1

    assert sinks.move_table(spark, "bronze.t_over", "silver.t_moved")
    assert not spark.catalog.tableExists("bronze.t_over") and readers.read_table(spark, "silver.t_moved").count() == 1
    assert not sinks.move_table(spark, "bronze.no_such", "silver.x")
    assert ("bronze", "t_app") in {tuple(r) for r in sinks.list_layers(spark).collect()}
    assert sinks.describe_table(spark, "silver.t_moved").count() > 3


def test_layers_are_created_twice_without_harm(spark):
    for _ in range(2):
        schemas.create_layers(spark)
    names = {(r.layer, r.table_name) for r in sinks.list_layers(spark).collect()}
    assert {(t.layer, t.name) for t in schemas.TABLES} <= names
    table = spark.table("silver.crime")
    assert dict(table.dtypes)["month"] == "date" and table.count() == 0


def test_export(spark, tmp_path):
    root = str(tmp_path)
    sinks.export_csv(fixtures.incidents(spark), root, ["crime_id", "category"], "category", ["crime_id", "lat", "lon"])
    read = spark.read.option("header", True).csv
    assert read(f"{root}/simple").columns == ["crime_id", "category"] and read(f"{root}/full").count() == 27
    assert (tmp_path / "by_category" / "export_group=violent_crime").exists()
    summary = {r.dataset: (r.total_records, r.has_coordinates) for r in sinks.dataset_summary({"crime": fixtures.incidents(spark), "elements": fixtures.elements(spark)}).collect()}
    assert summary == {"crime": (27, 27), "elements": (10, 4)}


def test_records_get_ingestion_columns(spark):
    row = readers.from_records(spark, [{"id": 1, "area": "mine"}], "id int, area string", RUN, source="feed", area="other").first()
    assert (row.id, row.area, row.source_api) == (1, "mine", "feed")


def test_stream_of_snapshots_equals_batch(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    raw = "id bigint, category string, ingestion_timestamp timestamp"
    for run in fixtures.RUNS[:2]:
        spark.createDataFrame([(c[0], c[3], run) for c in fixtures.INCIDENTS], raw).coalesce(1).write.mode("append").json(landing)
        stream = jobs.drop_reingested(jobs.follow_snapshots(spark, landing, schemas.struct(raw), max_files=1), ["id"])
        jobs.append_files(stream, out, state).awaitTermination()
    assert readers.read_path(spark, out).count() == 9


def test_partition_refresh_is_repeatable(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("2025-01", 1), ("2025-02", 2)], "month string, n int").write.parquet(landing)

    def refresh(state):
        jobs.refresh_partitions(
            jobs.follow_snapshots(spark, landing, "month string, n int", "parquet"), lambda: spark.read.parquet(landing),
            lambda df: df.groupBy("month").agg(F.sum("n").alias("n")), "month", out, str(tmp_path / state),
        ).awaitTermination()

    refresh("s1")
    spark.createDataFrame([("2025-02", 5)], "month string, n int").write.mode("append").parquet(landing)
    refresh("s1")
    refresh("s2")
    assert sorted((str(r.month), r.n) for r in spark.read.parquet(out).collect()) == [("2025-01", 1), ("2025-02", 7)]


def test_a_large_share_of_a_partition_is_split(spark, tmp_path):
    """However large the input, a task writes about the advisory size."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64k")
    try:
        df = spark.range(0, 200_000, 1, 8).withColumns({"kind": F.lit("a"), "noise": F.xxhash64("id")})
        written = sinks.write_parquet(df, str(tmp_path / "split"), ["kind"], files_per_partition=2)
    finally:
        spark.conf.set(setting, before)
    assert written.records == 200_000 and len(spark.read.parquet(written.path).inputFiles()) > 4


def test_snapshots_are_compressed(spark, tmp_path):
    written = sinks.write_snapshot(spark.range(1000).select("id", F.lit("some text " * 20).alias("t")), str(tmp_path / "raw"), datetime(2025, 1, 1))
    files = list((tmp_path / "raw").rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files) and sum(f.stat().st_size for f in files) < 50_000
    assert spark.read.json(written.path).count() == 1000
