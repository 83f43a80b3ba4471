"""Physical-plan guards: the scale properties the design relies on, for every registered query."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

# Queries that write files while being built (their plans read back what they wrote).
WRITERS = {"scan_csv", "csv_layouts", "scan_periods", "filter_pings", "scan_filtered", "scan_core", "port_subset",
           "write_outputs", "load_tables", "table_overview", "export_payload", "tracks_json",
           "incremental_ingest", "incremental_tables", "filter_counts", "map_documents",
           "stored_port_summary", "stored_constraint_check", "stored_congestion_heatmap", "period_manifest", "size_reduction", "constraint_check"}
BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "BatchEvalPython", "ArrowEvalPython",
          "FlatMapGroupsInPandas"]


def _plan(spark, name):
    return entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


entry.registry.load_all()


@pytest.mark.parametrize("name", sorted(set(entry.registry.QUERIES) - WRITERS))
def test_no_quadratic_or_python_operators(spark, name):
    plan = _plan(spark, name)
    assert not [b for b in BANNED if b in plan]


@pytest.mark.parametrize("name", ["port_hourly_stats", "vessel_visits", "zone_speed_stats", "peak_hour"])
def test_source_scan_is_pruned(spark, name):
    """Only the columns a query needs reach the scan (``props`` is never read)."""
    plan = _plan(spark, name)
    assert "ReadSchema: struct<" in plan or "ReadSchema" in plan
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_filtered_scan_pushes_port_and_class(spark):
    from quayside.plans.tables import Tables
    from quayside.session import scratch_path
    from quayside.sources import filtered
    path = scratch_path(spark, "t-plan")
    filtered.write_filtered(Tables(spark, SF_SMALL).raw, path)
    plan = filtered.read_core(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(port,aarhus)" in plan and "In(mobile_type" in plan


def _stored(spark):
    from quayside.plans.tables import Tables
    from quayside.session import scratch_path
    from quayside.sources import filtered
    filtered.write_filtered(Tables(spark, SF_SMALL).raw, path := scratch_path(spark, "t-plans"))
    return filtered.read_filtered(spark, path)


def _final(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")   # whole filters in the plan's text
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_window_prunes_days_and_columns_of_the_stored_table(spark):
    from quayside.plans.tables import Tables
    plan = _final(Tables(spark, pings=_stored(spark), date_from="2024-01-05", date_to="2024-01-07").vessel_visits)
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-05" in plan
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "mmsi" in read and not any(c in read for c in ("destination", "heading", "nav_status", "latitude"))


def test_zone_boxes_reach_the_scan_of_the_stored_table(spark):
    from quayside.plans.tables import Tables
    plan = _final(Tables(spark, pings=_stored(spark)).zone_hourly_stats)
    assert "EqualTo(port,aarhus)" in plan and "GreaterThanOrEqual(latitude" in plan


def test_types_are_hash_aggregated_before_the_shuffle(spark):
    from quayside.plans.tables import Tables
    plan = _final(Tables(spark, pings=_stored(spark)).type_distribution)
    below = plan.split("Scan parquet")[0].split("Exchange")[-1]   # from the last exchange down to the scan
    assert "HashAggregate" in below and "SortAggregate" not in below


def test_histograms_read_their_source_once(spark):
    from quayside.operators import explore
    from quayside.plans.tables import Tables
    t = Tables(spark, pings=_stored(spark))
    for df in (explore.speed_histogram(t.pings), explore.dwell_histogram(t.vessel_visits)):
        assert _final(df).split("Initial Plan")[0].count("Scan parquet") == 1


def test_kpis_on_stored_tables_read_no_pings(spark):
    """From stored tables, the port summary scans the three tables that it needs, and only the days asked for."""
    from quayside.plans import kpis
    from quayside.plans.tables import StoredTables, Tables
    from quayside.session import scratch_path
    from quayside.streaming import maintain
    root = scratch_path(spark, "t-stored")
    maintain.write_tables(Tables(spark, SF_SMALL), root)
    stored = StoredTables(spark, root).window("2024-01-03", "2024-01-09")
    df = kpis.port_summary_df(stored)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert {f.split("/")[-3] for f in df.inputFiles()} == {"port_hourly_stats", "vessel_visits", "port_daily_flow"}
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("PartitionFilters: [isnotnull(date" in s for s in scans)
    assert not [b for b in BANNED if b in plan]
    want = kpis.port_summary_df(Tables(spark, SF_SMALL).window("2024-01-03", "2024-01-09")).select("port", "total_vessel_hours", "avg_dwell_minutes")
    assert sorted(map(tuple, kpis.port_summary_df(stored).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
