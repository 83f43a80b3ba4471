"""Maintained tables, map documents, counts of the filter step, layouts and mergeable aggregates."""
from __future__ import annotations

import datetime as dt
import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ping
from quayside import config, pipeline
from quayside.functions import numeric
from quayside.operators import facts, regions, sketches, tracks
from quayside.plans.tables import TABLE_ATTRS, Tables, published
from quayside.session import scratch_path
from quayside.sources import ais_csv, documents, filtered
from quayside.streaming import ingest, maintain


def pings_of(days, vessels=6, start="2026-02-01"):
    """Two pings a vessel and day, vessels of some days only, inside the first port's box."""
    lat, lon = (sum(b) / 2 for b in (config.PORTS["aarhus"][:2], config.PORTS["aarhus"][2:]))
    rows, first = [], dt.date.fromisoformat(start)
    for d in days:
        for v in range(vessels):
            if (d * 7 + v) % 3:
                for h in (3 + v, 15):
                    rows.append(ping(len(rows) + 1000 * d, 100 + v, f"{first + dt.timedelta(d)} {h:02d}:00:00", lat, lon, float(v), ship_type=["Cargo", "Tug"][h % 2]))
    return rows


def content(spark, root):
    return {t: sorted(map(repr, maintain.stored_table(spark, root, t).collect())) for t in TABLE_ATTRS}


def computed(pings):
    t = Tables(pings.sparkSession, pings=regions.filter_and_label(pings))
    return {n: sorted(map(repr, published(t.table(n), n).collect())) for n in TABLE_ATTRS}


def files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root.removeprefix('file:')}/**/*", recursive=True) if os.path.isfile(f)}


def padded(pings):
    for name, typ in ais_csv.RAW_FIELDS.values():
        if name not in pings.columns:
            pings = pings.withColumn(name, F.lit(None).cast("timestamp_ntz" if typ == "timestamp" else typ))
    return regions.filter_and_label(pings)


# --- maintained tables --------------------------------------------------------------------------------------------

def test_batches_out_of_order_and_repeated(spark, make_pings):
    """A day in the middle comes last, and with a batch that is repeated: its neighbours' arrivals and departures change too."""
    root = scratch_path(spark, "t-maintain")
    parts = [[0, 1], [4, 5], [3], [2]]
    for i, days in enumerate(parts):
        batch = padded(make_pings(pings_of(days)))
        for _ in range(2 if i == 2 else 1):
            assert len(maintain.apply_batch(root, batch, i)) == len(days)
        before = computed(make_pings([p for part in parts[: i + 1] for p in pings_of(part)]))
        assert content(spark, root) == before
    # what batch 1 replaced is only the days it touched and the flow of their neighbours
    seen = files(root)
    maintain.apply_batch(root, padded(make_pings(pings_of([9]))), 4)
    kept = {f for f, t in files(root).items() if seen.get(f) == t and "date=" in f}
    assert {f for f in seen if "date=" in f} == kept and kept  # day 9 has no neighbour in the data: nothing that was there is written anew


def test_late_rows_of_a_finished_day(spark, make_pings):
    root = scratch_path(spark, "t-late")
    rows = pings_of(range(5))
    maintain.apply_batch(root, padded(make_pings(rows[::2])), 0)
    maintain.apply_batch(root, padded(make_pings(rows[1::2])), 1)
    assert content(spark, root) == computed(make_pings(rows))


def test_a_batch_without_pings_in_any_port(spark, make_pings):
    root = scratch_path(spark, "t-outside")
    assert maintain.apply_batch(root, padded(make_pings([ping(lat=0.0, lon=0.0)])), 0) == []
    assert len(maintain.apply_batch(root, padded(make_pings(pings_of([1]))), 1)) == 1


def test_stream_writes_nothing_without_new_files(spark, make_pings):
    src, root, ckpt = (scratch_path(spark, n) for n in ("t-src", "t-tables", "t-ckpt"))
    maintain.run_maintenance(spark, f"{src}/*/*.csv", root, ckpt)  # no files at all
    day = F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM-dd"))
    rows = make_pings(pings_of(range(4)))
    for part in (F.dayofmonth("date") <= 2, F.dayofmonth("date") > 2):
        ais_csv.write_raw_csv(rows.where(part).withColumn("period", day), src, "period", mode="append")
        maintain.run_maintenance(spark, f"{src}/*/*.csv", root, ckpt)
    seen = files(root)
    maintain.run_maintenance(spark, f"{src}/*/*.csv", root, ckpt)
    assert files(root) == seen and seen
    want = computed(rows)
    for table, got in content(spark, root).items():
        assert got == want[table], table


# --- layouts ------------------------------------------------------------------------------------------------------

def test_layouts_of_many_files_and_the_catalogue_reads_new_ones_only(spark):
    root = scratch_path(spark, "t-layouts")
    local = root.removeprefix("file:")
    headers = ["MMSI,Latitude", "Latitude,MMSI,Name", '"Name","MMSI"']
    for i in range(60):
        os.makedirs(f"{local}/d {i % 7}", exist_ok=True)
        with open(f"{local}/d {i % 7}/f{i}.csv", "w") as f:
            f.write("" if i == 59 else headers[i % 3] + "\n" + "1,2\n" * (i % 4))
    open(f"{local}/notes.txt", "w").write("MMSI\n")
    found = ais_csv.layouts(spark, root)
    assert {h: len(f) for h, f in found.items()} == {headers[0]: 20, headers[1]: 20, headers[2]: 19}
    assert all(os.path.exists(f.removeprefix("file:")) for fs in found.values() for f in fs)
    assert ais_csv.layouts(spark, root + "-absent") == {}

    store = scratch_path(spark, "t-catalogue")
    assert ais_csv.catalogue(spark, root + "-absent", store).count() == 0
    assert ais_csv.catalogue(spark, root, store).count() == 59
    written = files(store)
    with open(f"{local}/late.csv", "w") as f:
        f.write("MMSI\n3\n")
    assert ais_csv.catalogue(spark, root, store).where("header = 'MMSI'").count() == 1
    now = files(store)
    assert all(now[f] == t for f, t in written.items() if f.endswith(".parquet"))
    new = [f for f in now if f not in written and f.endswith(".parquet")]
    assert sum(spark.read.parquet(f).count() for f in new) == 1


def test_a_big_file_has_its_first_line_as_header(spark):
    """A file of many splits, and lines that sort before the header."""
    root = scratch_path(spark, "t-split")
    os.makedirs(root.removeprefix("file:"))
    with open(f"{root.removeprefix('file:')}/big.csv", "w") as f:
        f.write("MMSI,Name\n" + "".join(f"{i},A\n" for i in range(40_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        assert list(ais_csv.layouts(spark, root)) == ["MMSI,Name"]
        assert ais_csv.read_raw_csv(spark, root).count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# --- counts of the filter step --------------------------------------------------------------------------------------

def test_counts_of_the_filter_step(spark):
    root = scratch_path(spark, "t-counts")
    os.makedirs(f"{root.removeprefix('file:')}/aisdk-2026-02-01")
    lat, lon = config.PORTS["aarhus"][0], config.PORTS["aarhus"][2]
    with open(f"{root.removeprefix('file:')}/aisdk-2026-02-01/a.csv", "w") as f:
        f.write("MMSI,Latitude,Longitude\n" + f"1,{lat},{lon}\n" * 3 + "2,0,0\n" * 2 + f"x,{lat},{lon}\n" + ",,\n" + "1,2,3,4\n" + "\n")
    out = scratch_path(spark, "t-counted")
    counts = filtered.filter_archive(spark, root, out)
    assert counts == {"read": 8, "too_long": 1, "no_mmsi": 2, "outside": 2, "written": 3}
    assert filtered.read_filtered(spark, out).count() == 3
    assert filtered.write_filtered(filtered.read_filtered(spark, out).where(F.lit(False)), scratch_path(spark, "t-none")) == 0


# --- two months -----------------------------------------------------------------------------------------------------

def test_tracks_of_two_months(spark, make_pings):
    """Each month has its own tracks, minutes and allow-list."""
    lat, lon = (sum(b) / 2 for b in (config.PORTS["aarhus"][:2], config.PORTS["aarhus"][2:]))
    corridor = (config.APPROACH_BOX[0] + 0.01, config.APPROACH_BOX[3] - 0.01)
    rows = [ping(i, 1, f"2026-01-31 23:{50 + i}:30", lat, lon) for i in range(5)] + [ping(10 + i, 1, f"2026-02-01 00:0{i}:00", lat, lon) for i in range(4)]
    rows += [ping(20, 1, "2026-02-28 23:59:59", lat, lon), ping(21, 1, "2028-02-29 23:59:00", lat, lon)]
    rows += [ping(30 + i, 2, f"2026-01-10 0{i}:00:00", lat, lon) for i in range(3)]
    rows += [ping(40, 2, "2026-01-11 00:00:00", *corridor), ping(41, 2, "2026-02-11 00:00:00", *corridor)]
    raw = make_pings(rows)
    t = Tables(spark, raw=raw)
    both = {(r.month, r.mmsi): r.n_points for r in tracks.month_tracks(raw, t.pings).collect()}
    assert both == {("2026-01", 1): 5, ("2026-02", 1): 5, ("2026-01", 2): 4}
    union = tracks.core_union_approach(raw, t.pings)
    assert sorted((r.month, r.t) for r in union.where("mmsi = 1").collect()) == (
        [("2026-01", 44640 - 10 + i) for i in range(5)] + [("2026-02", i) for i in range(4)] + [("2026-02", 28 * 1440 - 1), ("2028-02", 29 * 1440 - 1)])
    assert [r.event_id for r in union.where("src = 1").collect()] == [40]  # in February vessel 2 has no core ping
    points = tracks.track_points(tracks.month_tracks(raw, t.pings))
    asof = {(r.month, r.mmsi): r.t for r in tracks.positions_asof(points, 2).collect()}
    assert asof == {("2026-02", 1): 2}
    many = {(r.month, r.mmsi, r.at_t): r.t for r in tracks.positions_asof_many(points, [2, 50_000]).collect()}
    assert many == {("2026-02", 1, 2): 2, ("2026-02", 1, 50_000): 28 * 1440 - 1, ("2026-01", 1, 50_000): 44640 - 6, ("2026-01", 2, 50_000): 14400}


# --- map documents --------------------------------------------------------------------------------------------------

def test_map_documents_are_scripts_in_order(spark, make_pings):
    lat, lon = (sum(b) / 2 for b in (config.PORTS["aarhus"][:2], config.PORTS["aarhus"][2:]))
    rows = [ping(100 * v + i, v, f"2026-0{1 + v % 2}-03 {i:02d}:00:00", lat, lon + 0.0001 * v, None if i == 2 else 3.0, name=f'V "{v}"') for v in range(1, 24) for i in range(12)]
    t = Tables(spark, raw=make_pings(rows))
    out = scratch_path(spark, "t-maps")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several parts, small as they are
    try:
        pipeline.run_maps(t, out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def script(folder):
        parts = sorted(glob.glob(f"{out.removeprefix('file:')}/{folder}/part-*"))
        return "".join(open(p, encoding="utf-8").read() for p in parts), len(parts)

    text, parts = script("months/document=2026-01")
    assert text.startswith("window.AARHUS_VESSEL_DATA={") and text.rstrip().endswith("};")
    doc = json.loads(text.rstrip()[len("window.AARHUS_VESSEL_DATA="):-1])
    assert list(doc) == ["start_date", "end_date", "bucket_minutes", "total_minutes", "zone_order", "ship_types", "vessels"]
    assert (doc["start_date"], doc["end_date"], doc["total_minutes"]) == ("2026-01-01", "2026-01-31", 44640)
    assert [v["mmsi"] for v in doc["vessels"]] == list(range(2, 24, 2)) and parts > 1
    assert doc["vessels"][0]["name"] == 'V "2"' and [list(v) for v in doc["vessels"]] == [["mmsi", "name", "type", "track"]] * 11
    assert [p["t"] for p in doc["vessels"][0]["track"]] == [2 * 1440 + 60 * i for i in range(12)] and "sog" not in doc["vessels"][0]["track"][2]
    day = json.loads(script("days/document=2026-02-03")[0].rstrip()[len("window.VESSEL_DATA="):-1])
    assert list(day) == ["date", "bbox", "bucket_minutes", "ship_types", "ports", "vessels"] and day["date"] == "2026-02-03"
    assert [v["mmsi"] for v in day["vessels"]] == list(range(1, 24, 2)) and day["vessels"][0]["track"][2]["sog"] is None
    assert day["ports"] == {k: list(v) for k, v in config.PORTS.items()}
    back = documents.read_vessels(spark, f"{out}/days").where("mmsi = 3").first()
    assert (back.document, back.name) == ("2026-02-03", 'V "3"') and len(json.loads(back.track)) == 12


# --- mergeable aggregates -------------------------------------------------------------------------------------------

def test_sketches_count_a_vessel_once_however_they_are_merged(spark, make_pings):
    rows = [ping(i, 1 + i % 3000, f"2026-02-0{1 + i % 5} {i % 24:02d}:00:00") for i in range(30_000)]
    stored = sketches.vessel_sketches(make_pings(rows).withColumn("port", F.when(F.col("mmsi") % 2 == 0, "a").otherwise("b")))
    total = sketches.distinct_vessels(stored).first()[0]
    assert abs(total - 3000) <= 0.03 * 3000
    ports = {r.port: r.vessels for r in sketches.distinct_vessels(stored, "port").collect()}
    assert all(abs(n - 1500) <= 0.03 * 1500 for n in ports.values()) and set(ports) == {"a", "b"}


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_from_counted_speeds(spark, seed):
    rng = np.random.default_rng(seed)
    v = np.round(rng.choice([rng.uniform(0, 3, 400), np.full(400, 0.1), rng.uniform(0, 30, 400)][seed], 300), 1)
    rows = [(i % 3, float(x)) for i, x in enumerate(v)] + [(7, 4.0)]
    counts = spark.createDataFrame(rows, "k int, speed double").groupBy("k", "speed").agg(F.count(F.lit(1)).alias("n"))
    qs = {"a": 0.0, "b": 0.025, "c": 0.5, "d": 0.95, "e": 1.0}
    for r in sketches.speed_summary(counts, ["k"], qs).collect():
        x = [s for k, s in rows if k == r.k]
        np.testing.assert_allclose([r[q] for q in qs], np.quantile(x, list(qs.values())), atol=1e-9)
        assert r.n == len(x) and abs(r["mean"] - np.mean(x)) < 1e-9 and abs(r.share_below - np.mean(np.array(x) < 0.5)) < 1e-12


def test_counted_speeds_give_the_hourly_table(spark, make_pings):
    rng = np.random.default_rng(5)
    rows = [ping(i, i % 9, f"2026-02-0{1 + i % 2} {i % 5:02d}:{i % 60:02d}:00", sog=None if i % 31 == 0 else 102.3 if i % 17 == 0 else float(round(rng.uniform(0, 20), 1)))
            for i in range(900)]
    pings = make_pings(rows).withColumn("port", F.lit("p"))
    want = {(r.date, r.hour): (r.sog_median, r.sog_p95, r.pct_stationary) for r in facts.port_speed_stats(pings).collect()}
    s = sketches.speed_summary(sketches.speed_counts(pings), ["port", "date", "hour"], {"median": 0.5, "p95": 0.95})
    got = {(r.date, r.hour): (r.m, r.p, r.s) for r in s.select(
        "date", "hour", numeric.round_even(F.col("median"), 2).alias("m"), numeric.round_even(F.col("p95"), 2).alias("p"),
        numeric.round_even(F.col("share_below") * F.lit(100.0), 1).alias("s")).collect()}
    assert got == want and len(got) == 10


def test_layout_store_is_beside_the_checkpoint():
    assert ingest.layout_store("/a/ckpt/") == "/a/ckpt-layouts"
