"""Sketches, partial states, the stateful stream, audited publishing and single evaluation."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstone.operators import sketches, summarise
from gridstone.session import scratch_path
from gridstone.sources import publish
from gridstone.streaming import jobs, partials, stateful


# --- sketches ----------------------------------------------------------------------
def test_sketches_merge_to_the_distinct_count(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 20_011).alias("user"), F.lit(None).cast("string").alias("none"))
    cells = sketches.distinct_cells(df, ["day"], ["user", "none"])
    merged = sketches.estimated(sketches.rolled_up(cells, [F.lit(1).alias("all")], ["user", "none"]), ["user", "none"]).first()
    assert merged.records == 60_000 and merged.none_estimate == 0
    assert abs(merged.user_estimate - 20_011) <= 20_011 * sketches.relative_error()
    # Merging once more over the same cells counts nobody twice.
    twice = sketches.rolled_up(cells.unionAll(cells), [F.lit(1).alias("all")], ["user", "none"])
    assert sketches.estimated(twice, ["user", "none"]).first().user_estimate == merged.user_estimate
    assert spark.range(1).select(sketches.agrees(F.lit(110), F.lit(100))).first()[0] is False
    assert spark.range(1).select(sketches.agrees(F.lit(1), F.lit(0))).first()[0] is True


def test_quantile_sketches_keep_their_rank_error(spark):
    rnd = random.Random(3)
    values = sorted(rnd.lognormvariate(0, 2) for _ in range(20_000))
    df = spark.createDataFrame([(i % 9, v) for i, v in enumerate(values)] + [(0, None), (1, float("nan"))], "cell int, v double")
    merged = sketches.merged_quantiles(sketches.quantile_cells(df, ["cell"], "v"), [F.lit(0).alias("all")])
    got = sketches.at_ranks(merged, {"low": 0.1, "mid": 0.5, "high": 0.99}).first()
    for value, share in ((got.low, 0.1), (got.mid, 0.5), (got.high, 0.99)):
        assert abs(np.searchsorted(values, value) / len(values) - share) < sketches.RANK_ERROR


# --- describe ----------------------------------------------------------------------
def test_describe_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 1e6), ("b", 5.0), (None, 3.0), (None, 4.0), ("b", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").mapInArrow(watched, "g string, v double")
    got = {r.g: r for r in summarise.describe(df, ["v"], by=["g"]).collect()}
    assert seen.value == len(rows)
    assert set(got) == {"a", "b", None} and got["b"].n == 1 and got["b"]["std"] is None
    a = [1.0, 2.0, 2.0, 1e6]
    assert got["a"].n == 4 and got["a"]["mean"] == pytest.approx(statistics.mean(a)) and got["a"]["std"] == pytest.approx(statistics.stdev(a))
    assert (got["a"]["min"], got["a"].p50, got["a"]["max"], got["a"].total) == (1.0, 2.0, 1e6, 1000005.0)
    assert got[None].p25 == 3.25 and got[None]["std"] == pytest.approx(statistics.stdev([3.0, 4.0]))


# --- partial states ----------------------------------------------------------------
ARGS = (["cell"], ["v"], ["who"])


def batch(spark, rows):
    return spark.createDataFrame(rows, "cell string, v double, who string")


def finished(spark, path):
    rows = partials.finished(partials.read_partials(spark, path), *ARGS).collect()
    return {r.cell: (r.records, r.avg_v, r.total_v, r.min_v, r.max_v, r.who_estimate) for r in rows}


def test_partial_states_of_batches_equal_one_aggregation(spark):
    path = scratch_path(spark, "states")
    parts = [[("a", 1.0, "x"), ("b", 4.0, "y"), (None, None, None)], [("a", 3.0, "y"), ("a", None, "x")], [("c", 2.0, "z"), ("a", 8.0, "z")]]
    for i, part in enumerate(parts):
        partials.write_batch(batch(spark, part), i, path, *ARGS)
    want = {"a": (4, 4.0, 12.0, 1.0, 8.0, 3), "b": (1, 4.0, 4.0, 4.0, 4.0, 1), "c": (1, 2.0, 2.0, 2.0, 2.0, 1), None: (1, None, None, None, None, 0)}
    assert {k: tuple(v) for k, v in finished(spark, path).items()} == want
    partials.write_batch(batch(spark, parts[1]), 1, path, *ARGS)  # a repeated batch
    assert finished(spark, path) == want
    assert partials.compact(spark, path, ["cell"]) == 2 and finished(spark, path) == want
    partials.write_batch(batch(spark, [("b", 6.0, "y")]), 3, path, *ARGS)
    assert finished(spark, path)["b"] == (2, 5.0, 10.0, 4.0, 6.0, 1)
    assert len(partials.read_partials(spark, path).select("batch_id").distinct().collect()) == 2  # the whole state and one batch
    assert partials.compact(spark, path, ["cell"]) == 3 and finished(spark, path)["a"] == want["a"]


def test_a_batch_reads_no_history(spark):
    plan = plan_of(partials.partial_states(batch(spark, [("a", 1.0, "x")]), *ARGS))
    assert "FileScan" not in plan and "Join" not in plan


# --- stateful stream ---------------------------------------------------------------
@pytest.fixture
def store(spark):
    spark.conf.set(*stateful.STORE)
    yield
    spark.conf.unset(stateful.STORE[0])


def test_earliest_record_is_corrected_and_forgotten(spark, store):
    landing, out, state = (scratch_path(spark, n) for n in ("first-in", "first-out", "first-state"))
    day = lambda d, h=0: f"2024-01-{d:02d} {h:02d}:00:00"
    batches = [
        [("k", day(10, 5), "k5"), ("k", day(10, 7), "k7"), ("m", day(10, 2), "m2"), (None, day(10, 1), "null"), ("t", None, "untimed")],
        [("k", day(10, 3), "k3"), ("k", day(10, 9), "k9"), ("m", day(10, 4), "m4")],  # an earlier k corrects, a later one and m do not
        [("x", day(20), "x")],  # moves the watermark far beyond k and m
        [("x", day(21), "x2")],
        [("k", day(20, 1), "k-again")],  # k was forgotten, so this is a first record
    ]

    def run(stream):
        typed = stream.withColumn("at", F.to_timestamp("at"))
        return jobs.append_files(stateful.first_by_ingestion(typed, ["key"], "at", within="2 days"), out, state, mode="update")

    for rows in batches:
        part = spark.createDataFrame(rows, "key string, at string, note string")
        part.write.mode("append").parquet(landing)
        query = run(jobs.follow_snapshots(spark, landing, part.schema, "parquet"))
        query.awaitTermination()
        assert query.exception() is None
    got = {(r.key, r.note, r.correction) for r in spark.read.parquet(out).collect()}
    assert got == {("k", "k5", False), ("m", "m2", False), (None, "null", False), ("k", "k3", True), ("x", "x", False), ("k", "k-again", False)}


def test_keys_of_a_group_are_handled_together(spark, store):
    """One group only: keys are told apart, nulls and large whole numbers among them, and each has its own end."""
    landing, out, state = (scratch_path(spark, n) for n in ("group-in", "group-out", "group-state"))
    big = (1 << 60) + 1
    batches = [
        [(big, "a", 10, 5), (big + 1, "a", 10, 6), (None, "a", 10, 7), (big, None, 12, 8), (big, "a", 10, 4)],
        [(big, "a", 9, 3), (None, "a", 11, 2), (None, None, 12, None), (big, None, 11, big)],  # the first is too late
        [(7, "x", 20, 1)],  # forgets all keys before it
        [(big, "a", 20, 9), (7, "x", 20, 0)],
    ]
    for rows in batches:
        part = spark.createDataFrame(rows, "k long, kind string, day int, n long")
        part.write.mode("append").parquet(landing)
        stream = jobs.follow_snapshots(spark, landing, part.schema, "parquet").withColumn("at", F.timestamp_seconds(F.lit(1704067200) + F.col("day") * 86_400))
        query = jobs.append_files(stateful.first_by_ingestion(stream, ["k", "kind"], "at", ["n"], "2 days", groups=1), out, state, mode="update")
        query.awaitTermination()
        assert query.exception() is None
    got = sorted(((r.k, r.kind, r.day, r.n, r.correction) for r in spark.read.parquet(out).collect()), key=repr)
    assert got == sorted([
        (big, "a", 10, 4, False), (big + 1, "a", 10, 6, False), (None, "a", 10, 7, False), (big, None, 12, 8, False), (None, None, 12, None, False),
        (big, None, 11, big, True), (7, "x", 20, 1, False), (big, "a", 20, 9, False), (7, "x", 20, 0, True),
    ], key=repr)


def test_state_needs_its_store(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(RuntimeError):
        stateful.first_by_ingestion(stream, ["value"], "timestamp")


# --- publishing --------------------------------------------------------------------
def test_only_passing_loads_are_published(spark):
    name, gates = "published_points", (("full", ">=", 0.5),)
    checks, figures = {"positive": F.col("v") > 0, "named": F.col("n").isNotNull()}, {"full": F.avg((F.col("v") > 0).cast("double"))}

    def load(rows):
        df = spark.createDataFrame(rows, "v int, n string")
        return publish.load(df, name, scratch_path(spark, "load"), checks, gates, figures)

    first = load([(1, "a"), (2, None), (-1, None), (3, "c")])
    assert first.published and first.records == 4 and first.rejected == {"positive": 1, "named": 2}
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 3] and spark.table(name).columns == ["v", "n"]
    bad = {r.v: r.failed_checks for r in publish.quarantine(spark, first.path).collect()}
    assert bad == {2: ["named"], -1: ["positive", "named"]}
    second = load([(-3, "a"), (-2, "b"), (None, "b"), (5, "c")])
    assert not second.published and second.gates[0][1:] == (pytest.approx(1 / 3), ">=", 0.5, False) and second.rejected["positive"] == 3
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 3]  # readers see the former load
    assert not load([]).published
    third = load([(7, "z")])
    assert third.published and [r.v for r in spark.table(name).collect()] == [7]
    publish.publish(spark, name, first.path, ["v", "n"])  # and back
    assert spark.table(name).count() == 2
    spark.sql(f"DROP VIEW {name}")
