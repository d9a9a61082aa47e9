"""Keyed incremental loads against one deduplication of everything."""

import random

import pytest

from pyspark.sql import Row

from conftest import plan_of
from gridstone.operators.clean import keep_first
from gridstone.session import written_once
from gridstone.sources import incremental
from gridstone.sources.incremental import _within, directory_of, load_first

TYPES = "id long, part string, at long, seq long, note string"


@pytest.fixture
def name(spark):
    made = f"loaded_{random.randrange(10**9)}"
    yield made
    for t in (made, directory_of(made)):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def rows(seed, n, ids):
    rnd = random.Random(seed)
    return [(rnd.choice([None, *range(ids)]), rnd.choice(["a", "b", "it's", None]), rnd.randrange(50), rnd.randrange(3), rnd.choice("xyz")) for _ in range(n)]


def load(spark, name, some):
    return load_first(spark.createDataFrame(some, TYPES), name, ["id"], ["at", "seq"], ["part"])


def stored(spark, name):
    return sorted(map(tuple, spark.table(name).select("id", "part", "at", "seq", "note").collect()), key=repr)


def expected(spark, some):
    return sorted(map(tuple, keep_first(spark.createDataFrame(some, TYPES), ["id"], ["at", "seq"]).collect()), key=repr)


def test_loads_equal_one_deduplication(spark, name):
    parts = [rows(1, 60, 40), rows(2, 60, 60), rows(3, 80, 60), rows(2, 60, 60)]
    done = []
    for part in parts:
        done += part
        result = load(spark, name, part)
        assert stored(spark, name) == expected(spark, done)
    assert result.added == result.replaced == 0 and result.partitions == 0 and result.known > 0  # the last part came before


def test_an_earlier_row_moves_a_key_to_another_partition(spark, name):
    load(spark, name, [(1, "a", 10, 0, "x"), (2, "b", 10, 0, "x")])
    result = load(spark, name, [(1, "c", 5, 0, "y"), (2, "c", 20, 0, "y"), (3, None, 1, 0, "z")])
    assert (result.added, result.replaced, result.known, result.partitions) == (1, 1, 1, 3)
    assert stored(spark, name) == [(1, "c", 5, 0, "y"), (2, "b", 10, 0, "x"), (3, None, 1, 0, "z")]
    assert {r.part for r in spark.table(name).select("part").distinct().collect()} == {"b", "c", None}
    load(spark, name, [(3, "b", 0, 0, "w")])  # the null partition is emptied
    assert stored(spark, name) == [(1, "c", 5, 0, "y"), (2, "b", 10, 0, "x"), (3, "b", 0, 0, "w")]


def test_a_load_that_lost_its_directory_entry_can_be_repeated(spark, name):
    load(spark, name, [(1, "a", 10, 0, "x")])
    load(spark, name, [(2, "a", 3, 0, "x")])
    before = spark.table(directory_of(name)).where("id = 2").first()["__bucket"]
    spark.sql(f"ALTER TABLE {directory_of(name)} DROP PARTITION (`__bucket` = {before})")
    assert load(spark, name, [(2, "a", 3, 0, "x")]).added == 1
    assert stored(spark, name) == [(1, "a", 10, 0, "x"), (2, "a", 3, 0, "x")]


def test_rows_are_staged_only_where_a_load_changes_some(spark, name, monkeypatch):
    staged = {}

    def noted(df, label):
        back = written_once(df, label)
        staged[label] = back.count()
        return back

    monkeypatch.setattr(incremental, "written_once", noted)
    some = [(i, "ab"[i % 2], i, 0, "x") for i in range(20)]
    assert load(spark, name, some).added == 20 and staged == {"load_first": 20}
    staged.clear()
    assert load(spark, name, some).known == 20 and staged == {"load_first": 20, "load_judged": 0}
    result = load(spark, name, [(0, "b", -1, 0, "y"), (1, "b", 5, 0, "y"), (20, "a", 5, 0, "y")])
    assert (result.added, result.replaced, result.known) == (1, 1, 1) and staged["load_judged"] == 2


def test_only_affected_partitions_are_read(spark, name):
    load(spark, name, [(i, p, i, 0, "x") for i, p in enumerate("abcd" * 5)])
    some = spark.table(name).where(_within([Row(part="a"), Row(part=None)], ["part"]))
    assert {f.rsplit("part=", 1)[1][0] for f in some.inputFiles()} >= {"a"} and "PartitionFilters: [((part" in plan_of(some)
    assert some.count() == 5
