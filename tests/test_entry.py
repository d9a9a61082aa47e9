"""The registered queries against their reference SQL."""

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
CHECKED = (
    "geo1_project", "join1_nearest", "win2_dedup_first", "win1_rank", "agg14_describe", "silver_incidents", "gold_infrastructure_density",
    "gold_weather_monthly", "gold_high_risk_zones", "dq13_gates", "flt1_elements", "fil1_features",
)


@pytest.fixture(scope="module")
def database(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_reference_sql(spark, small, database, name):
    df = entry.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    cursor = database.execute(entry.oracle_sql()[name])
    position = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(position) == columns
    want = sorted((tuple(r[position[c]] for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want


def test_flagship(spark, small):
    df = entry.entry(spark)
    assert df.count() == 150 and "area_risk_score" in df.columns


def test_every_query_has_a_builder_and_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(q.sql for q in entry.QUERIES.values())
