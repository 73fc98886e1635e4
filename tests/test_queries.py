import math
import os
from pathlib import Path

import pytest

import __spark_entry__
from trackloom.plans import registry
from trackloom.plans.store import Kept

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    connection = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        connection.sql(f"create view {p.stem} as select * from '{p}'")
    return connection


def alike(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-12))


@pytest.mark.parametrize("name", sorted(registry.PLANS))
def test_query_agrees_with_its_oracle(spark, db, name):
    got = registry.queries()[name](spark, DATA)
    want = db.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = lambda names, rows: sorted((tuple(r[names.index(c)] for c in columns) for r in rows), key=repr)
    a, b = order(got.columns, got.collect()), order(list(want.columns), want.fetchall())
    assert len(a) == len(b) and all(alike(x, y) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True))


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    if os.path.isdir(DATA):
        assert __spark_entry__.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["stop_events", "mart_punctuality", "dq_deltas_chain", "dq_cancellations_unresolved", "stg_realtime_reports", "stg_swiss_events"])
def test_what_grows_with_the_trips_is_not_broadcast(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    broadcast = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert not [line for line in broadcast if "orderkey" in line or "trip_" in line], broadcast


#: Checks and reports that make kept tables, which stand between them and the raw tables.
OVER_KEPT = (
    "dq_arrivals_add_up", "dq_buffer_within_origin", "dq_cancellations_unresolved", "dq_curve_monotone", "dq_first_stop_alone_without_section", "dq_no_run_provable", "dq_outside_service_day",
    "rep_asymmetry", "rep_buffer_sources", "rep_coverage", "rep_data_state", "rep_heatmap_top", "rep_one_source", "rep_reserve_works", "rep_run_lines", "rep_section_sources", "rep_split_total",
)


@pytest.mark.parametrize("name", OVER_KEPT)
def test_what_grows_with_the_trips_is_not_broadcast_for_a_kept_table(spark, monkeypatch, name):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    monkeypatch.setattr(Kept, "table", lambda self, name, build: build())  # the plan goes down to the raw tables
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in plan
    broadcast = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert not [line for line in broadcast if "orderkey" in line or "trip_" in line], broadcast


def test_cancelled_stops_without_actuals_need_no_table(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    plan = registry.queries()["dq_resolved_without_actuals"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "Exchange SinglePartition" in plan


def test_rows_by_trip_are_shuffled_once(spark):
    """Consolidation and the windows by trip find the reports as the join dealt them: only narrow rows of the raw tables are shuffled by trip."""
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    plan = registry.queries()["mart_run_detail"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert dealt and not [line for line in dealt if "stop_sequence" in line or "_trip" in line or "source" in line and "trip_key" in line and "last" not in line and "trip_id" not in line], dealt


def test_coverage_reads_the_kept_run_detail(spark):
    """Where the run detail is kept, coverage doesn't consolidate the raw reports again."""
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    rail = registry.Rail(spark, DATA)
    want = sorted(map(repr, rail.coverage.collect()))
    rail = registry.Rail(spark, DATA)
    rail.runs  # noqa: B018
    assert "l_orderkey" not in rail.coverage._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, rail.coverage.collect())) == want != []


def test_few_stop_names_are_broadcast_and_many_are_not(spark, monkeypatch):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    by_broadcast = lambda: "BroadcastHashJoin [stop_id" in registry.queries()["mart_run_detail"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert by_broadcast()
        monkeypatch.setattr(registry, "MOST_NAMES", 0)
        assert not by_broadcast()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
