from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstone import schemas
from gridstone.functions import classify, scalars
from gridstone.operators import clean, filters, quality, summarise
from gridstone.sources import flatten

RUN = datetime(2025, 1, 1)


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("text,want", [("1.5", 1.5), (" 2 ", 2.0), ("bad", None), ("", None), (None, None), ("NaN", None)])
def test_to_number(spark, text, want):
    assert one(spark, scalars.to_number, text) == want


@pytest.mark.parametrize("text,want", [("2025-08", date(2025, 8, 1)), ("2025-08-17", date(2025, 8, 1)), ("soon", None), (None, None), ("2025-13", None)])
def test_month_start(spark, text, want):
    assert one(spark, scalars.month_start, text) == want


@pytest.mark.parametrize("text,want", [("2025-08", date(2025, 8, 1)), ("2025-08-17T10:00:00", date(2025, 8, 17)), ("soon", None)])
def test_to_day(spark, text, want):
    assert one(spark, scalars.to_day, text) == want


def test_epoch_time_defaults_to_the_epoch(spark):
    assert one(spark, lambda c: F.unix_timestamp(scalars.epoch_time(c)), None, "long") == 0


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(scalars.percent(F.lit(1), F.lit(0))).first()[0] is None


@pytest.mark.parametrize("t,h,w,want", [
    (20.0, 50.0, 2.0, "comfortable"), (15.0, 30.0, 4.9, "comfortable"), (4.9, 50.0, 2.0, "extreme"), (31.0, 90.0, 2.0, "extreme"),
    (20.0, 81.0, 2.0, "uncomfortable"), (20.0, 50.0, 10.5, "uncomfortable"), (10.0, 70.0, 6.0, "moderate"), (None, None, None, "moderate"),
])
def test_comfort_ladder(spark, t, h, w, want):
    df = spark.createDataFrame([(t, h, w)], "t double, h double, w double")
    assert df.select(classify.comfort_level(F.col("t"), F.col("h"), F.col("w"))).first()[0] == want


def test_first_key_skips_blanks_and_drops_rows_without_any(spark):
    df = spark.createDataFrame([("1", "a"), ("", "b"), (None, "c"), (None, None), ("", "")], "id string, persistent_id string")
    assert sorted(r.record_key for r in clean.first_key(df, "id", "persistent_id").collect()) == ["1", "b", "c"]


def test_batches_hold_at_most_the_asked_number(spark):
    out = clean.batches(spark.range(1050).withColumnRenamed("id", "k"), "k", 100)
    sizes = [r["count"] for r in out.groupBy("batch_id").count().collect()]
    assert sum(sizes) == 1050 and max(sizes) <= 100


def test_enforce_schema_nulls_bad_values_and_ignores_absent_columns(spark):
    df = spark.createDataFrame([("7", "x", "2025-08"), ("bad", "y", "never")], "a string, b string, d string")
    out = clean.enforce_schema(df, schemas.struct("a bigint, d date, not_there double"))
    assert out.dtypes == [("a", "bigint"), ("b", "string"), ("d", "date")]
    assert [(r.a, r.d) for r in out.collect()] == [(7, date(2025, 8, 1)), (None, None)]
    lost = {r.column_name: r.lost_in_cast for r in clean.cast_losses(df, schemas.struct("a bigint, d date")).collect()}
    assert lost == {"a": 1, "d": 1}


def test_conform_gives_the_declared_columns(spark):
    out = schemas.conform(spark.createDataFrame([("5",)], "crime_id string"), schemas.BRONZE_CRIME)
    assert out.schema == schemas.struct(schemas.BRONZE_CRIME) and out.first().crime_id == 5


def test_ingestion_columns_only_where_absent(spark):
    df = spark.createDataFrame([("mine",)], "area string")
    row = clean.with_ingestion(df, RUN, source="feed", area="other", osm_timestamp="t").first()
    assert (row.area, row.source_api, row.ingestion_date, row.osm_timestamp) == ("mine", "feed", date(2025, 1, 1), "t")


def test_prefer_falls_back(spark):
    df = spark.createDataFrame([("b", 1), ("b", 2), ("c", 3)], "kind string, n int")
    assert [r.n for r in filters.prefer(df, "kind", ("a", "b", "c")).collect()] == [1, 2]
    assert filters.prefer(df, "kind", ("x", "y")).count() == 0


def test_lookup_ignores_case_and_spaces(spark):
    codes = spark.createDataFrame([("sk1 1eb",), ("ZZ9",)], "code string")
    ref = spark.createDataFrame([("SK1 1EB", "D")], "postcode string, admin_district string")
    assert [(r.code, r.admin_district) for r in filters.lookup(codes, ref.unionByName(ref), "code").collect()] == [("sk1 1eb", "D")]
    assert [r.code for r in filters.lookup(codes, ref, "code", how="left_anti").collect()] == ["ZZ9"]


def test_quality_score_of_unknown_columns_is_zero(spark):
    df = spark.createDataFrame([("x",)], "a string")
    assert df.select(quality.completeness_score(df, ["no_such"])).first()[0] == 0.0
    assert df.select(quality.completeness_score(df, ["a", "no_such"])).first()[0] == 1.0


def test_flags_only_for_columns_that_exist(spark):
    out = quality.with_flags(spark.createDataFrame([(1.0, None)], "lat double, lon double"))
    assert out.columns == ["lat", "lon", "has_coordinates"] and out.first().has_coordinates is False


def test_null_counts_and_listing(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string").withColumn("c", F.lit(1))
    assert [(r.column_name, r.null_count) for r in quality.null_counts(df).collect()] == [("b", 2), ("a", 1)]
    assert [(r.column_name, r.data_type) for r in quality.column_listing(df).collect()] == [("a", "int"), ("b", "string"), ("c", "int")]


def test_gates(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1, 1, True)] * 19 + [(1.0, 1.0, 1, 1, False)], "lat double, lon double, easting_bng int, northing_bng int, is_valid_location boolean")
    assert {r.gate: r.passed for r in quality.quality_gates(df).collect()} == {"coordinate_completeness": True, "projection_success": True, "bbox_outliers": True}
    worse = df.unionAll(spark.createDataFrame([(1.0, 1.0, None, None, False)] * 5, df.schema))
    assert {r.gate: r.passed for r in quality.quality_gates(worse).collect()} == {"coordinate_completeness": True, "projection_success": False, "bbox_outliers": False}


def test_profile_of_an_empty_table(spark):
    report = quality.profile({"none": (spark.createDataFrame([], "a int, kind string"), "kind")}).first()
    assert (report.records, report["columns"]) == (0, ["a", "kind"])


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ingestion_timestamp"))
    plan = plan_of(clean.keep_first(df, ["k"]))
    partial = plan.index("Partial")
    assert plan.index("Exchange") < partial  # printed top down: the partial limit feeds the exchange


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(summarise.top_k(spark.range(100), 5, F.desc("id")))


def test_nearest_k(spark):
    df = spark.createDataFrame([(1, 0.0, 3.0), (2, 0.0, 1.0), (3, 0.0, -1.0), (4, None, 0.0)], "id int, lat double, lon double")
    assert [r.id for r in summarise.nearest_k(df, (0.0, 0.0), 2).collect()] == [2, 3]


ELEMENTS = [
    (1, "node", 1.0, 2.0, {"man_made": "manhole", "name": "n"}, None, None),
    (2, "way", None, None, {"man_made": "", "power": "cable"}, [1, 2], [(5.0, 6.0), (7.0, 8.0)]),
    (3, "way", None, None, {}, [], []),
    (4, "way", None, None, None, None, None),
    (5, "node", 1.0, 2.0, {"power": "pole"}, [1], [(1.0, 1.0)]),
]


def test_flatten_elements(spark):
    rows = {r.id: r for r in flatten.flatten_elements(spark.createDataFrame(ELEMENTS, schemas.RAW_ELEMENT)).collect()}
    assert [rows[i].infrastructure_type for i in range(1, 6)] == ["manhole", "cable", "unknown", "unknown", "pole"]
    assert (rows[2].node_count, rows[2].geometry_points, rows[2].first_lat, rows[2].last_lon) == (2, 2, 5.0, 8.0)
    assert rows[2].geometry_json == '[{"lat":5.0,"lon":6.0},{"lat":7.0,"lon":8.0}]'
    assert (rows[3].node_count, rows[3].first_lat, rows[3].geometry_json) == (0, None, None)
    assert (rows[4].node_count, rows[4].geometry_points, rows[4].all_tags) == (0, 0, "{}")
    assert (rows[5].node_count, rows[5].geometry_json, rows[1].name) == (None, None, "n")


def test_select_features(spark):
    rows = [
        (1, "node", 53.4, -2.1, {"man_made": "manhole"}, None, None), (2, "way", None, None, {"man_made": "manhole"}, None, [(53.4, -2.1)]),
        (3, "way", None, None, {"power": "cable"}, None, [(10.0, 10.0), (53.4, -2.1)]), (4, "node", 10.0, 10.0, {"power": "pole"}, None, None),
    ]
    got = {r.id: r.feature for r in filters.select_features(spark.createDataFrame(rows, schemas.RAW_ELEMENT)).collect()}
    assert got == {1: "manhole", 3: "power_cable"}


def test_flatten_incident_without_outcome(spark):
    rows = [(1, "p", "burglary", "2025-08", "Force", None, "", ("53.4", "-2.1", (9, "St")), None)]
    row = flatten.flatten_incidents(spark.createDataFrame(rows, schemas.RAW_INCIDENT)).first()
    assert (row.lat, row.street_name, row.outcome_category, row.outcome_date) == ("53.4", "St", None, None)


def test_flatten_weather_with_missing_parts(spark):
    row = (None, None, 0, None, (1.0, 2.0), [], (1.0,) * 6, None, None, None, (0.5,), None)
    got = flatten.flatten_weather(spark.createDataFrame([row], schemas.RAW_WEATHER)).first()
    assert (got.weather_id, got.rain_1h_mm, got.snow_1h_mm, got.wind_speed_ms) == (None, 0.5, None, None)
    assert got.datetime == datetime(1970, 1, 1)


def test_flatten_places(spark):
    outward = spark.createDataFrame([("SK1", 1.0, 2.0, 3, 4, ["D", "E"], [], ["England"], None)], schemas.RAW_OUTWARD)
    full = spark.createDataFrame([("SK1 1EB", 1.0, 2.0, 3, 4, "D", None, "W", "P", "R", "England", "C")], schemas.RAW_POSTCODE)
    rows = {r.postcode: r for r in flatten.flatten_places(outward, full).collect()}
    assert (rows["SK1"].admin_district, rows["SK1"].admin_county, rows["SK1"].admin_ward) == ("D", None, None)
    assert rows["SK1 1EB"].parish == "P"
