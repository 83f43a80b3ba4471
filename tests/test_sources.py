"""CSV scan edge cases, sinks, streaming idempotence."""
from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quayside.plans.tables import Tables
from quayside.session import scratch_path
from quayside.sources import ais_csv, filtered
from quayside.streaming import ingest

HEADER = ("# Timestamp,Type of mobile,MMSI,Latitude,Longitude,Navigational status,ROT,SOG,COG,Heading,IMO,"
          "Callsign,Name,Ship type,Cargo type,Width,Length,Destination")


def _write(path, lines, header=HEADER):
    path = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def _layout_archive(spark):
    """A file of just the twelve columns, one with coordinates swapped and quoted fields, a monthly one with bad lines."""
    root = scratch_path(spark, "t-lay")
    plain = "# Timestamp,Type of mobile,MMSI,Latitude,Longitude,Navigational status,SOG,COG,Heading,Name,Ship type,Destination"
    swapped = plain.replace("Latitude,Longitude", "Longitude,Latitude")
    _write(f"{root}/aisdk-2026-02-01/a.csv", ["01/02/2026 08:00:00,Class A,11,55.45,8.45,Moored,1.5,1,2,ANNA,Cargo,AARHUS",
                                              "not a time,Class A,12,55.45,8.45,Moored,1.5,1,2,BO,Tug,"], plain)
    _write(f"{root}/aisdk-2026-02-02/b.csv", ['02/02/2026 09:00:00,Class A,13,8.45,55.45,Moored,1.5,1,2,"C, THE SHIP",Cargo,',
                                              "02/02/2026 09:00:00,Class A,14,8.45,55.45,Moored,1.5,1,2,D,Cargo,,"], swapped)
    _write(f"{root}/aisdk-2024-01/aisdk_20240107.csv",
           ["07/01/2024 08:00:00,Class A,15,55.45,8.45,Moored,0,1.5,10,20,x,y,E,Cargo,,1,2,X",
            "07/01/2024 08:00:00,Class A,16,55.45,8.45,Moored,0,1.5,10,20,x,y,F,Cargo,,1,2,X,MORE",
            "07/01/2024 08:00:00,Class A,17,55.45,8.45", ""])
    _write(f"{root}/aisdk-2024-01/empty.csv", [], "")
    return root


def test_layouts_go_by_the_header_of_each_file(spark):
    root = _layout_archive(spark)
    want = {(11, "2026-02-01"), (12, "2026-02-01"), (13, "2026-02-02"), (15, "2024-01-01"), (17, "2024-01-01")}
    df = ais_csv.raw_pings_from_csv(spark, root)
    rows = df.collect()
    assert {(r.mmsi, str(r.date)) for r in rows} == want and len(rows) == len(want)
    assert all(abs(r.latitude - 55.45) < 1e-4 and abs(r.longitude - 8.45) < 1e-4 for r in rows)
    by = {r.mmsi: r for r in rows}
    assert by[12].ts is None and by[13].name == "C, THE SHIP" and by[17].name is None and by[11].destination == "AARHUS"
    # the same rows whatever columns are selected
    for cols in (["mmsi"], ["mmsi", "latitude"], ["mmsi", "name", "ts"], ["mmsi", *ais_csv.ENGINE_NAMES[3:5]], df.columns):
        assert {r.mmsi for r in df.select(*cols).collect()} == {m for m, _ in want} and df.select(*cols).count() == len(want)
    assert not [r for r in Tables(spark, raw=df).vessel_visits.collect() if r.date is None]


def test_stream_equals_batch(spark):
    root = _layout_archive(spark)
    out, ck = scratch_path(spark, "t-so"), scratch_path(spark, "t-sc")
    ingest.run_ingest(spark, f"{root}/*/*.csv", out, ck)
    filtered.write_filtered(ais_csv.raw_pings_from_csv(spark, root), batch := scratch_path(spark, "t-sb"))
    a, b = (sorted(map(str, spark.read.parquet(p).select(*filtered.FILTERED_COLUMNS).collect())) for p in (out, batch))
    assert a == b and len(a) == 5
    tables = Tables(spark, pings=spark.read.parquet(out))
    for name in ("type_distribution", "vessel_visits", "port_hourly_stats"):
        assert tables.table(name).count() > 0
    # a file of a new layout, later
    _write(f"{root}/aisdk-2026-02-03/c.csv", ["21,03/02/2026 08:00:00,55.45,8.45"], "MMSI,# Timestamp,Latitude,Longitude")
    ingest.run_ingest(spark, f"{root}/*/*.csv", out, ck)
    assert spark.read.parquet(out).count() == 6


def test_all_columns_are_stored_and_a_hot_day_is_split(spark):
    t = Tables(spark, SF_SMALL)
    path = scratch_path(spark, "t-hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        hot = t.raw.repartition(8).withColumn("date", F.when(F.col("event_id") % 3 > 0, F.lit("2024-01-05").cast("date")).otherwise(F.col("date")))
        filtered.write_filtered(hot, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    df = spark.read.parquet(path)
    assert set(df.columns) == set(filtered.FILTERED_COLUMNS) and {"cog", "heading", "destination"} <= set(df.columns)
    files = df.where("date = '2024-01-05'").select(F.input_file_name()).distinct().count()
    assert files > 1 and df.count() == t.pings.count()


def test_csv_bad_values_become_null(spark):
    root = scratch_path(spark, "t-csv")
    _write(f"{root}/aisdk-2026-02-01/a.csv", [
        "01/02/2026 08:00:00,Class A,219000001,55.45,8.45,Moored,0,1.5,10,20,x,y,ANNA,Cargo,,1,2,AARHUS",
        "31/02/2026 08:00:00,Class A,219000002,55.45,8.45,Moored,0,abc,10,20,x,y,BO,Tanker,,1,2,",
        "01/02/2026 09:00:00,Class B,notanumber,55.45,8.45,Moored,0,1.5,10,20,x,y,C,Tug,,1,2,",
    ])
    df = ais_csv.read_raw_csv(spark, root).orderBy("name").collect()
    assert df[0].mmsi == 219000001 and df[0].sog == 1.5 and df[0].destination == "AARHUS"
    assert df[1].ts is None and df[1].sog is None          # invalid day, unparsable speed -> null
    assert df[2].mmsi is None                              # bad MMSI -> null, dropped by clean_rows
    assert ais_csv.clean_rows(ais_csv.read_raw_csv(spark, root)).count() == 2


def test_csv_long_rows_flagged_short_rows_kept(spark):
    root = scratch_path(spark, "t-csv2")
    _write(f"{root}/aisdk-2026-02-01/a.csv", [
        "01/02/2026 08:00:00,Class A,219000001,55.45,8.45,Moored,0,1.5,10,20,x,y,ANNA,Cargo,,1,2,AARHUS,EXTRA,MORE",
        "01/02/2026 08:00:00,Class A,219000003,55.45,8.45",
    ])
    rows = ais_csv.read_raw_csv(spark, root).collect()
    by_mmsi = {r.mmsi: r for r in rows}
    assert by_mmsi[219000001][ais_csv.TOO_LONG] and not by_mmsi[219000003][ais_csv.TOO_LONG]
    assert by_mmsi[219000003].latitude is not None                # short row: padded with nulls
    assert [r.mmsi for r in ais_csv.clean_rows(ais_csv.read_raw_csv(spark, root)).collect()] == [219000003]


def test_periods_daily_and_monthly(spark):
    root = scratch_path(spark, "t-per")
    _write(f"{root}/aisdk-2026-02-01/aisdk-2026-02-01.csv",
           ["01/02/2026 08:00:00,Class A,1,55.45,8.45,Moored,0,1.5,10,20,x,y,A,Cargo,,1,2,"])
    _write(f"{root}/aisdk-2024-01/aisdk_20240101.csv",
           ["01/01/2024 08:00:00,Class A,2,55.45,8.45,Moored,0,1.5,10,20,x,y,B,Cargo,,1,2,"])
    _write(f"{root}/aisdk-2024-01/aisdk_20240102.csv",
           ["02/01/2024 08:00:00,Class A,3,55.45,8.45,Moored,0,1.5,10,20,x,y,C,Cargo,,1,2,"])
    got = sorted((r.period, str(r.period_date)) for r in ais_csv.scan_periods(spark, root).collect())
    assert got == [("2024-01", "2024-01-01"), ("2024-01", "2024-01-01"), ("2026-02-01", "2026-02-01")]


def test_empty_input_writes_no_partition(spark):
    t = Tables(spark, SF_SMALL)
    path = scratch_path(spark, "t-empty")
    filtered.write_filtered(t.raw.where(F.lit(False)), path)
    local = path[len("file:"):] if path.startswith("file:") else path
    files = [f for _, _, fs in os.walk(local) for f in fs if f.endswith(".parquet")]
    assert files == []


def test_filtered_rerun_replaces_only_its_days(spark):
    t = Tables(spark, SF_SMALL)
    path = scratch_path(spark, "t-filt")
    filtered.write_filtered(t.raw, path)
    n = spark.read.parquet(path).count()
    filtered.write_filtered(t.raw.where(F.col("date") == F.lit("2024-01-05").cast("date")), path)
    assert spark.read.parquet(path).count() == n


def test_streaming_rerun_adds_nothing(spark):
    t = Tables(spark, SF_SMALL)
    src = scratch_path(spark, "t-src")
    ais_csv.write_raw_csv(t.raw.withColumn("period", F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM-dd"))),
                          src, period_col="period")
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    ingest.run_ingest(spark, f"{src}/*/*.csv", out, ck, max_files=5)
    n1 = spark.read.parquet(out).count()
    ingest.run_ingest(spark, f"{src}/*/*.csv", out, ck, max_files=5)
    assert spark.read.parquet(out).count() == n1 == t.pings.count()


def test_tables_from_csv_match_fixture(spark):
    """The same plans run on archive CSV input give the fixture's tables (tie-free ones)."""
    from quayside.plans.tables import published
    t = Tables(spark, SF_SMALL)
    path = scratch_path(spark, "t-csvsrc")
    ais_csv.write_raw_csv(t.raw, path)
    c = Tables(spark, raw=ais_csv.raw_pings_from_csv(spark, path))
    for name in ("port_hourly_stats", "port_navstatus_stats", "port_speed_stats", "vessel_visits",
                 "aarhus_zone_hourly_stats", "port_daily_flow"):
        a = sorted(map(tuple, published(t.table(name), name).collect()))
        b = sorted(map(tuple, published(c.table(name), name).collect()))
        assert a == b, name


def test_tables_from_filtered_parquet(spark):
    from quayside.plans.tables import published
    t = Tables(spark, SF_SMALL)
    path = scratch_path(spark, "t-fsrc")
    filtered.write_filtered(t.raw, path)
    f = Tables(spark, pings=filtered.read_filtered(spark, path), date_from="2024-01-05", date_to="2024-01-20")
    w = Tables(spark, SF_SMALL, "2024-01-05", "2024-01-20")
    for name in ("port_hourly_stats", "type_distribution", "aarhus_zone_visits"):
        assert sorted(map(tuple, published(f.table(name), name).collect())) == \
               sorted(map(tuple, published(w.table(name), name).collect())), name


def test_pipeline_filter_transform_export(spark):
    from quayside import pipeline
    t = Tables(spark, SF_SMALL)
    csv_root, filt, tabs, pay = (scratch_path(spark, n) for n in ("p-csv", "p-filt", "p-tabs", "p-pay"))
    ais_csv.write_raw_csv(t.raw.withColumn("period", F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM-dd"))),
                          csv_root, period_col="period")
    pipeline.run_filter(spark, csv_root, filt)
    assert spark.read.parquet(filt).count() == t.pings.count()
    pipeline.run_transform(spark, filt, tabs)
    assert spark.read.parquet(f"{tabs}/port_hourly_stats").count() == t.port_hourly_stats.count()
    pipeline.run_export(spark, filt, pay)
    doc = spark.read.json(f"{pay}/ports").first()
    assert len(doc["summary"]) == 5 and doc["ports"] == sorted(r["port"] for r in doc["summary"])
    assert doc["date_from"] == "2024-01-01" and doc["date_to"] == max(r["date"] for r in doc["daily_traffic"])
    zones = spark.read.json(f"{pay}/zones").first()
    assert zones["zones"] == list(zones["zone_labels"].asDict()) or set(zones["zones"]) == set(zones["zone_labels"].asDict())
    assert zones["summary"]["total_vessel_hours"] == sum(r["vessel_count"] for r in zones["zone_daily_traffic"])
    assert zones["zone_polygons"]["anchorage"][1] == [56.14, 10.21] and zones["summary"]["busiest_zone"] in zones["zones"]
    # a window: the flow of its first day knows the day before
    pipeline.run_export(spark, filt, win := scratch_path(spark, "p-win"), "2024-01-10", "2024-01-12")
    part = spark.read.json(f"{win}/ports").first()
    whole = {(r["port"], r["date"]): (r["entries"], r["exits"]) for r in doc["daily_flow"]}
    assert {r["date"] for r in part["daily_flow"]} == {"2024-01-10", "2024-01-11", "2024-01-12"}
    assert all(whole[r["port"], r["date"]] == (r["entries"], r["exits"]) for r in part["daily_flow"])


def test_payload_sets_are_ordered(spark):
    from quayside.plans import kpis
    from quayside.sources import sinks
    t = Tables(spark, SF_SMALL)
    path = scratch_path(spark, "p-ord")
    sets = {"hourly_totals": kpis.hourly_totals(t), "summary": kpis.port_summary_df(t)}
    sinks.export_payload(sets, {"x": "1"}, path, {"hourly_totals": kpis.ORDER_BY["hourly_totals"],
                                                   "summary": kpis.ORDER_BY["port_summary"]})
    doc = spark.read.json(path).first()
    keys = [(r["port"], r["date"], r["hour"]) for r in doc["hourly_totals"]]
    assert keys == sorted(keys) and len(keys) == kpis.hourly_totals(t).count()
    hours = [r["total_vessel_hours"] for r in doc["summary"]]
    assert hours == sorted(hours, reverse=True)
    o = kpis.ordered("hourly_totals", kpis.hourly_totals(t)).collect()
    assert [(r.port, r.date, r.hour) for r in o] == keys
