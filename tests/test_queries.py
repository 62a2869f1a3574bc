"""Registered queries against their SQL on the small driver tables."""

import os

import pytest

from headway.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
SAMPLE = (
    "stop_times",
    "service_patterns",
    "supersession",
    "revision_moves",
    "operating_days",
    "similar_tracks",
    "connected_components",
    "fares_revision",
    "fares_violations",
    "document_profiles",
    "feed_archive_latest",
)


@pytest.fixture(scope="module")
def con():
    from check import TABLES

    if not os.path.isdir(FOLDER):
        pytest.skip("driver tables not present")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    from check import rows_of

    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ("stop_times", "supersession", "similar_tracks", "service_regions"))
def test_plans_hold_no_cross_join(spark, name):
    if not os.path.isdir(FOLDER):
        pytest.skip("driver tables not present")
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"):
        assert node not in plan


def test_network_queries_deal_a_file_out_once(spark):
    """Rows of a file stay together: the links' joins, windows and groups add no shuffle of their own."""
    from headway.plans import network as net
    from headway.plans.registry import Tables
    from headway.session import BOUNDED, BY_FILE, DEFAULTS, apply_defaults

    names = ("stop_times", "consecutive_pairs", "terminal_stops", "pattern_geometry", "pattern_distance",
             "pattern_admin_areas", "pattern_localities", "pattern_metadata")
    lineitem = spark.createDataFrame(
        [(o, n, 7 * n, 5 * n, 10.0 * n, 0.03, 0.02 * n, "A", "F", None) for o in (1, 2, 150, None) for n in (1, 2, 4)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate date",
    )
    orders = spark.createDataFrame([(o, 3, "F") for o in (1, 2, 3, 150, None)], "o_orderkey long, o_custkey long, o_orderstatus string")

    class Made(Tables):
        def __getattr__(self, name):
            return {"lineitem": lineitem, "orders": orders}[name]

    apply_defaults(spark, {**DEFAULTS, **BOUNDED, **BY_FILE})
    t = Made(spark, "")
    got = sorted((r.jp_id, r.section_refs) for r in net.journey_patterns(t).collect())
    assert got == [("JP1", ["S1-A", "S1-B"]), ("JP150", ["S150-A", "S150-B"]), ("JP2", ["S2-A", "S2-B"])]
    if os.path.isdir(FOLDER):
        for name in names:
            df = QUERIES[name](spark, FOLDER)
            assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "2000", name
            if name in ("stop_times", "consecutive_pairs", "terminal_stops"):
                plan = df._jdf.queryExecution().executedPlan().toString()
                shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line and ("vj_code" in line or "jp_id" in line or "section_id" in line)]
                assert not shuffles, (name, shuffles)
    apply_defaults(spark, {**DEFAULTS, **BOUNDED})
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
