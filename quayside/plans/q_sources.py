"""Registered source/sink round trips (S1-S14), streaming ingest (S11), quality (Q1).

Each query writes what it needs into a fresh folder under the cluster's shared
``spark.checkpoint.dir`` (never a machine-local temp dir), reads it back through the
engine's own readers, and returns what it read.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from quayside import config, pipeline
from quayside.functions import geo
from quayside.operators import quality, tracks
from quayside.plans import oracle as o
from quayside.plans import payload, q_facts, q_kpis, q_tracks  # noqa: F401  (CTEs, oracles)
from quayside.plans.q_joins import reg
from quayside.plans.tables import TABLE_ATTRS, TABLE_COLUMNS, Tables, published
from quayside.session import scratch_path
from quayside.sources import ais_csv, documents, filtered, manifest, sinks
from quayside.streaming import ingest

isod, isots = o.iso_date, o.iso_ts
SPLIT_DAY = "2024-01-15"     # archive layout of the test month: daily folders up to here, then one monthly folder


def _archive(t: Tables, path: str) -> None:
    period = F.when(F.col("date") <= F.lit(SPLIT_DAY).cast("date"),
                    F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM-dd"))) \
              .otherwise(F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM")))
    ais_csv.write_raw_csv(t.raw.withColumn("period", period), path, period_col="period")


@reg("scan_csv", f"""
SELECT {isots('ts')} AS ts, mobile_type, mmsi, latitude, longitude, nav_status, sog, CAST(NULL AS FLOAT) AS cog,
       CAST(NULL AS FLOAT) AS heading, ship_type, name, CAST(NULL AS VARCHAR) AS destination FROM raw""", ["raw"])
def q_scan_csv(spark, sf_dir):
    """Raw pings -> archive CSV (extra columns, other column order) -> typed scan by name."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "csv")
    ais_csv.write_raw_csv(t.raw, path)
    df = ais_csv.clean_rows(ais_csv.read_raw_csv(spark, path))
    return df.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                     *[c for c in df.columns if c != "ts"])


@reg("scan_periods", f"""
SELECT period, {isod('period_date')} AS period_date, count(*) AS rows FROM (
  SELECT CASE WHEN date <= DATE '{SPLIT_DAY}' THEN strftime(date, '%Y-%m-%d') ELSE strftime(date, '%Y-%m') END AS period,
         CASE WHEN date <= DATE '{SPLIT_DAY}' THEN date ELSE date_trunc('month', date)::DATE END AS period_date
  FROM raw) p GROUP BY period, period_date""", ["raw"])
def q_scan_periods(spark, sf_dir):
    """Daily and monthly archive folders discovered and unioned by one recursive scan."""
    path = scratch_path(spark, "archive")
    _archive(Tables(spark, sf_dir), path)
    df = ais_csv.clean_rows(ais_csv.scan_periods(spark, path))
    return (df.groupBy("period", "period_date").agg(F.count(F.lit(1)).alias("rows"))
            .select("period", F.date_format("period_date", "yyyy-MM-dd").alias("period_date"), "rows"))


def _filtered(spark, sf_dir) -> str:
    path = scratch_path(spark, "filtered")
    filtered.write_filtered(Tables(spark, sf_dir).raw, path)
    return path


# Archive layouts of csv_layouts: daily files as written above, monthly ones with just the twelve columns, coordinates
# swapped; every 97th line of the latter has too many fields, and every 89th time is not a time.
_PLAIN = ["MMSI", "Longitude", "Latitude", "# Timestamp", "SOG", "Name", "Ship type", "Type of mobile", "Navigational status",
          "COG", "Heading", "Destination"]


@reg("csv_layouts", f"""
SELECT CASE WHEN event_id % 89 = 0 THEN NULL ELSE {isots('ts')} END AS ts, mmsi, latitude, longitude, sog, nav_status, ship_type,
       mobile_type, name, {isod("CASE WHEN date <= DATE '" + SPLIT_DAY + "' THEN date ELSE date_trunc('month', date)::DATE END")} AS date
FROM raw WHERE NOT (date > DATE '{SPLIT_DAY}' AND event_id % 97 = 0)""", ["raw"])
def q_csv_layouts(spark, sf_dir):
    """Two file layouts, over-long lines and times that are none, in daily and monthly archives: every good row comes back,
    mapped by the header of its own file, under the date of its period."""
    raw = Tables(spark, sf_dir).raw
    path = scratch_path(spark, "layouts")
    bad_time = F.when(F.col("event_id") % 89 == 0, F.lit("no time")).otherwise(F.date_format("ts", config.RAW_TIMESTAMP_FORMAT))
    raw = raw.withColumn("# Timestamp", bad_time)
    early = F.col("date") <= F.lit(SPLIT_DAY).cast("date")
    daily = F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM-dd"))
    monthly = F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM"))
    ais_csv.write_raw_csv(raw.where(early).withColumn("period", daily), path, "period")
    late = raw.where(~early).withColumn("period", monthly).withColumn("Destination", F.when(F.col("event_id") % 97 == 0, F.lit("a,b,c")))
    ais_csv.write_raw_csv(late, path, "period", _PLAIN, "append", quote="")
    df = ais_csv.raw_pings_from_csv(spark, path)
    return df.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "mmsi", "latitude", "longitude", "sog", "nav_status",
                     "ship_type", "mobile_type", "name", F.date_format("date", "yyyy-MM-dd").alias("date"))


_STORED = ("mmsi, latitude, longitude, sog, CAST(NULL AS FLOAT) AS cog, CAST(NULL AS FLOAT) AS heading, nav_status, ship_type, "
           f"mobile_type, name, CAST(NULL AS VARCHAR) AS destination, port, {isots('ts')} AS ts")


def _stored(df, *more):
    """Rows of the filtered table, times and dates as text."""
    return df.select(*more, "mmsi", "latitude", "longitude", "sog", "cog", "heading", "nav_status", "ship_type", "mobile_type", "name",
                     "destination", "port", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                     F.date_format("date", "yyyy-MM-dd").alias("date"))


@reg("filter_pings", f"SELECT event_id, {_STORED}, {isod('date')} AS date FROM pings", ["pings"])
def q_filter_pings(spark, sf_dir):
    """The filter sink: every row and column read back from what was written."""
    df = filtered.read_filtered(spark, _filtered(spark, sf_dir))
    return _stored(df, "event_id")


@reg("scan_filtered", f"SELECT event_id, port, {isod('date')} AS date, latitude, longitude FROM pings", ["pings"])
def q_scan_filtered(spark, sf_dir):
    df = filtered.read_filtered(spark, _filtered(spark, sf_dir))
    return df.select("event_id", "port", F.date_format("date", "yyyy-MM-dd").alias("date"), "latitude", "longitude")


@reg("scan_core", f"SELECT event_id, mmsi, {isots('ts')} AS ts, latitude, longitude, sog, ship_type, name, mobile_type "
                  "FROM core", ["core"])
def q_scan_core(spark, sf_dir):
    df = filtered.read_core(spark, _filtered(spark, sf_dir))
    return df.select("event_id", "mmsi", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "latitude",
                     "longitude", "sog", "ship_type", "name", "mobile_type")


@reg("port_subset", f"SELECT event_id, {_STORED}, {isod('date')} AS date FROM pings WHERE port = 'aarhus'", ["pings"])
def q_port_subset(spark, sf_dir):
    """Per-port copies partitioned by (port, date); reading Aarhus prunes to its folders."""
    src = filtered.read_filtered(spark, _filtered(spark, sf_dir))
    path = scratch_path(spark, "subset")
    filtered.write_port_subset(src, path)
    return _stored(filtered.read_port_subset(spark, path, "aarhus"), "event_id")


_count_sql = " UNION ALL ".join(f"SELECT '{tb}' AS \"table\", count(*) AS rows FROM {o.PUBLISHED[tb][0]}"
                                for tb in TABLE_ATTRS)
_count_needs = [o.PUBLISHED[tb][0] for tb in TABLE_ATTRS]


@reg("write_outputs", _count_sql, _count_needs)
def q_write_outputs(spark, sf_dir):
    """The ten tables written as Parquet and counted back from storage."""
    root = scratch_path(spark, "outputs")
    paths = sinks.write_outputs(Tables(spark, sf_dir).materialized(), root)
    out = None
    for table, path in paths.items():
        part = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


@reg("load_tables", _count_sql, _count_needs)
def q_load_tables(spark, sf_dir):
    """Written tables loaded as (replaced) views; a missing table would be skipped."""
    root = scratch_path(spark, "outputs")
    sinks.write_outputs(Tables(spark, sf_dir).materialized(), root)
    prefix = "qs_" + root.rsplit("-", 1)[-1] + "_"
    views = sinks.load_tables(spark, root, prefix)
    return sinks.table_overview(spark, views).select(F.expr(f"substr(`table`, {len(prefix) + 1})").alias("table"),
                                                     "rows")


_overview_sql = " UNION ALL ".join(
    f"SELECT '{tb}' AS \"table\", count(*) AS rows, '{', '.join(TABLE_COLUMNS[tb])}' AS columns "
    f"FROM {o.PUBLISHED[tb][0]}" for tb in TABLE_ATTRS)


@reg("table_overview", _overview_sql, _count_needs)
def q_table_overview(spark, sf_dir):
    root = scratch_path(spark, "outputs")
    sinks.write_outputs(Tables(spark, sf_dir).materialized(), root)
    prefix = "qo_" + root.rsplit("-", 1)[-1] + "_"
    views = sinks.load_tables(spark, root, prefix)
    ov = sinks.table_overview(spark, views)
    return ov.select(F.expr(f"substr(`table`, {len(prefix) + 1})").alias("table"), "rows", "columns")


# Sets of the documents: columns (text, whole numbers or decimals) and the SQL of their rows.
_DOCUMENT_SQL = {
    "ports": {
        "daily_traffic": "daily_traffic", "congestion_heatmap": "congestion_heatmap", "stationary_heatmap": "stationary_heatmap",
        "summary": "port_summary", "hourly_totals": "hourly_totals",
        "type_distribution": o.build('SELECT port, vessel_type, CAST(sum("count") AS BIGINT) AS "count" FROM port_types GROUP BY ALL', ["port_types"]),
        "daily_flow": o.build(f"SELECT port, {isod('date')} AS date, CAST(sum(entries) AS BIGINT) AS entries, CAST(sum(exits) AS BIGINT) AS exits, "
                              "CAST(sum(unique_vessels) AS BIGINT) AS unique_vessels FROM port_flow GROUP BY ALL", ["port_flow"]),
        "movement_behaviour": o.build(f"SELECT port, hour, {o.round_half_up(o.exact_avg('pct_stationary', 1), 1)} AS avg_pct_stationary "
                                      "FROM port_speed GROUP BY ALL", ["port_speed"]),
    },
    "zones": {
        "zone_daily_traffic": "zone_daily_traffic_type", "zone_type_mix": "zone_type_mix", "dwell_by_zone_type": "zone_dwell",
        "navstatus_by_zone": "zone_navstatus_counts", "zone_speed_all": "zone_speed_profile", "zone_congestion_heatmap": "zone_congestion",
    },
}
_SET_COLUMNS = {
    "daily_traffic": "port string, date string, daily_vessel_count long",
    "type_distribution": "port string, vessel_type string, count long",
    "congestion_heatmap": "port string, dow int, hour int, avg_vessel_count double",
    "stationary_heatmap": "port string, dow int, hour int, avg_pct_stationary double",
    "daily_flow": "port string, date string, entries long, exits long, unique_vessels long",
    "movement_behaviour": "port string, hour int, avg_pct_stationary double",
    "summary": "port string, total_vessel_hours long, peak_hourly_count long, avg_dwell_minutes double, total_entries long, avg_daily_arrivals double",
    "hourly_totals": "port string, date string, hour int, vessel_count long",
    "zone_daily_traffic": "zone string, date string, vessel_type string, vessel_count long",
    "zone_type_mix": "zone string, vessel_type string, visit_count long",
    "dwell_by_zone_type": "zone string, vessel_type string, visit_count long, avg_dwell_minutes double, avg_dwell_hours double",
    "navstatus_by_zone": "zone string, vessel_type string, nav_status string, ping_count long",
    "zone_speed_all": "zone string, hour int, vessel_type string, sog_mean double, sog_median double, sog_p025 double, sog_p95 double, sog_p975 double",
    "zone_congestion_heatmap": "zone string, vessel_type string, dow int, hour int, avg_vessel_count double",
}


def _columns(name: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in _SET_COLUMNS[name].split(", ")]


def _content(name: str, cast: str, named: str) -> str:
    """SQL for the values of a row as one text, decimals with three places; ``named`` is how a column is written."""
    text = lambda c, t: f"CAST({named.format(c)} AS DECIMAL(18, 3))" if t == "double" else named.format(c)
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({text(c, t)} AS {cast}), '')" for c, t in _columns(name)) + ")"


def _document_sql() -> str:
    from quayside.plans import registry
    parts = []
    for document, sets in _DOCUMENT_SQL.items():
        orders = payload.PORT_SETS if document == "ports" else payload.ZONE_SETS
        for name, sql in sets.items():
            sql = registry.ORACLES.get(sql, sql)
            by = orders[name] + [(c, True) for c, _ in _columns(name) if c not in [x for x, _ in orders[name]]]
            order = ", ".join(f'"{c}" ' + ("ASC NULLS FIRST" if asc else "DESC NULLS LAST") for c, asc in by)
            content = _content(name, "VARCHAR", '"{}"')
            parts.append(f"SELECT '{document}' AS document, '{name}' AS dataset, CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS idx, "
                         f"{content} AS content FROM ({sql}) s")
    return " UNION ALL ".join(parts)


@reg("export_payload", _document_sql())
def q_export_payload(spark, sf_dir):
    """Both dashboard documents written and read back: every row of every set, in the order of the document."""
    t = Tables(spark, sf_dir).materialized()
    out = None
    for document, sets, export in (("ports", payload.PORT_SETS, payload.export_ports), ("zones", payload.ZONE_SETS, payload.export_zones)):
        export(t, path := scratch_path(spark, document))
        kind = ", ".join(f"{name} array<struct<{_SET_COLUMNS[name].replace(' ', ':').replace(',:', ',')}>>" for name in sets)
        doc = spark.read.schema(kind).json(path)
        for name in sets:
            rows = (doc.select(F.posexplode(name).alias("idx", "r"))
                    .select(F.lit(document).alias("document"), F.lit(name).alias("dataset"), "idx", F.expr(_content(name, "STRING", "r.`{}`")).alias("content")))
            out = rows if out is None else out.unionByName(rows)
    return out


@reg("filter_counts", f"""
SELECT count(*) AS "read", count(*) FILTER (WHERE long) AS too_long, count(*) FILTER (WHERE NOT long AND nameless) AS no_mmsi,
       count(*) FILTER (WHERE NOT long AND NOT nameless AND NOT inside) AS outside,
       count(*) FILTER (WHERE NOT long AND NOT nameless AND inside) AS written
FROM (SELECT date > DATE '{SPLIT_DAY}' AND event_id % 97 = 0 AS long, event_id % 41 = 0 AS nameless,
             {' OR '.join(o.box(b) for b in config.PORTS.values())} AS inside FROM raw) r""", ["raw"])
def q_filter_counts(spark, sf_dir):
    """What became of the lines of an archive with over-long lines and lines without MMSI, as counted by the filter step itself."""
    raw = Tables(spark, sf_dir).raw.withColumn("mmsi", F.expr("IF(event_id % 41 = 0, NULL, mmsi)"))
    path = scratch_path(spark, "count-archive")
    late = F.col("date") > F.lit(SPLIT_DAY).cast("date")
    ais_csv.write_raw_csv(raw.where(~late), f"{path}/early")
    late_rows = raw.where(late).withColumn("Destination", F.when(F.col("event_id") % 97 == 0, F.lit("a,b,c")))
    ais_csv.write_raw_csv(late_rows, f"{path}/late", columns=_PLAIN, quote="")
    counts = filtered.filter_archive(spark, path, scratch_path(spark, "counted"))
    return spark.createDataFrame([counts], "read long, too_long long, no_mmsi long, outside long, written long")


_map_json = ("'{\"t\":' || CAST(t AS VARCHAR) || ',\"lat\":' || CAST(lat AS VARCHAR) || ',\"lon\":' || CAST(lon AS VARCHAR)"
             " || coalesce(',\"sog\":' || CAST(sog AS VARCHAR), '') || coalesce(',\"z\":' || CAST(z AS VARCHAR), '') || '}'")


@reg("map_documents", f"""
SELECT month AS document, mmsi, name, type, '[' || string_agg({_map_json}, ',' ORDER BY t) || ']' AS track
FROM month_track_pts GROUP BY month, mmsi, name, type
UNION ALL SELECT {isod('date')}, mmsi, name, type, track_json FROM day_tracks_short""", ["month_track_pts", "day_tracks_short"])
def q_map_documents(spark, sf_dir):
    """The map documents of all months and days (vessels of two points and more, as the test data is thin), read back."""
    path = scratch_path(spark, "maps")
    pipeline.run_maps(Tables(spark, sf_dir), path, day_points=2)
    return documents.read_vessels(spark, f"{path}/months").unionByName(documents.read_vessels(spark, f"{path}/days"))


@reg("tracks_json", "SELECT mmsi, n_points FROM month_keep", ["month_keep"])
def q_tracks_json(spark, sf_dir):
    """Month tracks serialised as JSON lines and parsed back: points per vessel."""
    t = Tables(spark, sf_dir)
    tr = tracks.month_tracks(t.raw, t.pings)
    path = scratch_path(spark, "tracks")
    tr.select(F.to_json(F.struct("mmsi", "name", "type", "track")).alias("value")).write.mode("overwrite").text(path)
    back = spark.read.schema("mmsi long, name string, type string, "
                             "track array<struct<t:int,lat:double,lon:double,sog:double,z:int>>").json(path)
    return back.select("mmsi", F.size("track").cast("long").alias("n_points"))


_period_date = f"CASE WHEN date <= DATE '{SPLIT_DAY}' THEN date ELSE date_trunc('month', date)::DATE END"


@reg("incremental_ingest", f"SELECT {_STORED}, {isod(_period_date)} AS date FROM pings", ["pings"])
def q_incremental_ingest(spark, sf_dir):
    """Archive files streamed into the filtered table twice (the second run must add nothing): every row and column.

    Pings carry the date of their archive period, which for a monthly archive is the first of the month."""
    src = scratch_path(spark, "stream-src")
    _archive(Tables(spark, sf_dir), src)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    for _ in range(2):
        ingest.run_ingest(spark, f"{src}/*/*.csv", out, ckpt)
    return _stored(spark.read.parquet(out))


def _storage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    raw_root, filt_root, sub_root = (scratch_path(spark, n) for n in ("archive", "filtered", "subset"))
    ais_csv.write_raw_csv(t.raw.withColumn("period", F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM"))),
                          raw_root, period_col="period")
    filtered.write_filtered(t.raw, filt_root)
    filtered.write_port_subset(filtered.read_filtered(spark, filt_root), sub_root, ["aarhus"])
    return raw_root, filt_root, sub_root


# Two states of a storage in which each ping takes 16 bytes: which days it has as archive, unpacked, filtered and as Aarhus subset.
# In the second state some files of the first are gone, some are new, and the filtered days hold every second ping only.
_STATES = [{"archives": (1, 8), "raw": (1, 20), "filtered": (1, 15), "subset": (1, 10), "step": 1},
           {"archives": (6, 30), "raw": (11, 24), "filtered": (5, 18), "subset": (9, 18), "step": 2}]
_LINE = 16
_KINDS = {"raw": "true", "filtered": "inside", "subset": "inside AND port = 'aarhus'"}


def _state_sql(i: int) -> str:
    """Bytes of one state by period: days and their month."""
    s = _STATES[i]
    days = lambda kind: f"day(date) BETWEEN {s[kind][0]} AND {s[kind][1]}"
    size = lambda kind, step: f"nullif({_LINE} * count(*) FILTER (WHERE {_KINDS[kind]} AND {days(kind)} AND event_id % {step} = 0), 0)"
    period = lambda p: (f"SELECT {p} AS period, bool_or({days('archives')}) AS zipped, {size('raw', 1)} AS raw_size, "  # noqa: E731
                        f"{size('filtered', s['step'])} AS filtered_size, {size('subset', s['step'])} AS subset_size FROM labelled GROUP BY 1")
    by_month = period("strftime(date, '%Y-%m')").replace(size("raw", 1), "NULL").replace(f"bool_or({days('archives')})", "false")
    return f"{period(isod('date'))} UNION ALL {by_month}"


_red = lambda out, inp: f"round_even((1e0 - {out}::DOUBLE / nullif({inp}, 0)::DOUBLE) * 1000e0, 0) / 10e0"


def _manifest_sql(i: int) -> str:
    """The manifest after a state: what was seen once stays, sizes are the new ones where there are any."""
    before = "m0" if i else "(SELECT NULL AS period, false AS raw, false AS unzipped, false AS filtered, 0 AS unzipped_size, 0 AS filtered_size, 0 AS subset_size, NULL::DOUBLE AS fc, NULL::DOUBLE AS ac)"
    return f"""
SELECT *, coalesce(nullif({_red('filtered_size', 'unzipped_size')}, 0e0), p_fc) AS fc, coalesce(nullif({_red('subset_size', 'filtered_size')}, 0e0), p_ac) AS ac FROM (
  SELECT c.period, coalesce(s.zipped, false) OR s.raw_size IS NOT NULL OR coalesce(p.raw, false) AS raw, s.raw_size IS NOT NULL OR coalesce(p.unzipped, false) AS unzipped,
         s.filtered_size IS NOT NULL OR coalesce(p.filtered, false) AS filtered, coalesce(nullif(s.raw_size, 0), nullif(p.unzipped_size, 0)) AS unzipped_size,
         coalesce(nullif(s.filtered_size, 0), nullif(p.filtered_size, 0)) AS filtered_size, coalesce(nullif(s.subset_size, 0), nullif(p.subset_size, 0)) AS subset_size,
         p.fc AS p_fc, p.ac AS p_ac
  FROM calendar c LEFT JOIN s{i} s ON s.period = c.period LEFT JOIN {before} p ON p.period = c.period) x"""


o.cte("labelled", ["raw"], f"SELECT *, {' OR '.join(o.box(b) for b in config.PORTS.values())} AS inside, {o._port_case} AS port FROM raw")
o.cte("calendar", [], f"""
SELECT strftime(d, '%Y-%m') AS period FROM generate_series(DATE '{config.MONTHLY_START}', DATE '{config.MONTHLY_END}', INTERVAL 1 MONTH) g(d)
UNION ALL SELECT strftime(d, '%Y-%m-%d') FROM generate_series(DATE '{config.DAILY_START}', DATE '{config.DAILY_END}', INTERVAL 1 DAY) g(d)""")
for _i in (0, 1):
    o.cte(f"s{_i}", ["labelled"], _state_sql(_i))
    o.cte(f"m{_i}", ["calendar", f"s{_i}", *(["m0"] if _i else [])], _manifest_sql(_i))


def _state(spark, t: Tables, state: dict, prefix: str) -> list:
    """Write one state of the storage and observe it: raw, filtered and subset sizes, archives."""
    root = scratch_path(spark, prefix)
    pings = t.raw.select("event_id", "date", geo.any_region("latitude", "longitude", config.PORTS).alias("inside"),
                         geo.region_label("latitude", "longitude", config.PORTS).alias("port"))
    line = F.lpad(F.col("event_id").cast("string"), _LINE - 1, "0").alias("value")
    days = lambda kind: F.dayofmonth("date").between(*state[kind])
    period = F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM-dd")).alias("period")
    for kind, rows in _KINDS.items():
        step = 1 if kind == "raw" else state["step"]
        kept = pings.where(F.expr(rows) & days(kind) & (F.col("event_id") % step == 0))
        folder = period if kind == "raw" else F.date_format("date", "yyyy-MM-dd").alias("date")
        kept.select(line, folder).write.partitionBy("period" if kind == "raw" else "date").text(f"{root}/{kind}")
    pings.where(days("archives")).select(period).distinct().select(F.lit("").alias("value"), "period").write.partitionBy("period").text(f"{root}/archives")
    return [manifest.observed_raw(spark, f"{root}/raw", "*.txt"), manifest.observed_by_date(spark, f"{root}/filtered", "filtered_size", "*.txt"),
            manifest.observed_by_date(spark, f"{root}/subset", "filtered_aarhus_size", "*.txt"), manifest.observed_archives(spark, f"{root}/archives", "*.txt")]


@reg("period_manifest", """
SELECT period, raw, unzipped, CAST(unzipped_size AS BIGINT) AS unzipped_size, filtered, CAST(filtered_size AS BIGINT) AS filtered_size,
       fc AS filtered_compression, CAST(subset_size AS BIGINT) AS filtered_aarhus_size, ac AS filtered_aarhus_compression FROM m1""", ["m1"])
def q_period_manifest(spark, sf_dir):
    """The manifest of a second state of the storage, with that of the first as previous: calendar x observed artefacts x what
    was known. Flags stay once set, sizes are the new ones where files are there."""
    t, cal = Tables(spark, sf_dir), manifest.period_calendar(spark)
    previous = None
    for i, state in enumerate(_STATES):
        *sizes, archives = _state(spark, t, state, f"state{i}")
        out = manifest.period_manifest(cal, *sizes, previous=previous, archives=archives)
        if i == 0:
            out.write.parquet(path := scratch_path(spark, "manifest"))
            previous = spark.read.parquet(path)
    return out


@reg("size_reduction", None)
def q_size_reduction(spark, sf_dir):
    """Archive -> filtered -> Aarhus size reduction per observed period (bytes on storage)."""
    raw_root, filt_root, sub_root = _storage(spark, sf_dir)
    rs = manifest.observed_raw(spark, raw_root)
    fs = manifest.observed_by_date(spark, filt_root, "filtered_size")
    as_ = manifest.observed_by_date(spark, sub_root + "/port=aarhus", "filtered_aarhus_size")
    df = rs.join(fs, "period").join(as_, "period", "left")
    return df.select("period", "unzipped_size", "filtered_size", "filtered_aarhus_size",
                     filtered.size_reduction(F.col("filtered_size"), F.col("unzipped_size")).alias("filtered_compression"),
                     filtered.size_reduction(F.col("filtered_aarhus_size"), F.col("filtered_size"))
                     .alias("filtered_aarhus_compression"))


def _check_sql() -> str:
    parts = []
    for tb in TABLE_ATTRS:
        src = o.PUBLISHED[tb][0]
        for name, pred in quality.table_checks(tb):
            pred_sql = pred.replace("`", '"')
            parts.append(f"SELECT '{tb}' AS \"table\", '{name}' AS \"check\", "
                         f"CAST(coalesce(sum(CASE WHEN {pred_sql} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations "
                         f"FROM {src}")
        key = ", ".join(f'"{k}"' for k in quality.PRIMARY_KEYS[tb])
        parts.append(f"SELECT '{tb}', 'primary_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM "
                     f"(SELECT count(*) AS n FROM {src} GROUP BY {key} HAVING count(*) > 1) d")
    return " UNION ALL ".join(parts)


@reg("constraint_check", _check_sql(), _count_needs)
def q_constraint_check(spark, sf_dir):
    """Declared keys and NOT NULL / range / domain rules checked on the published tables."""
    t = Tables(spark, sf_dir).materialized()
    return quality.constraint_check({tb: published(t.table(tb), tb) for tb in TABLE_ATTRS})


_base = config.SOURCE_BASE_URL


@reg("period_calendar", f"""
SELECT c.period, c.kind, {isod('c.period_start')} AS period_start, c.url, coalesce(n.pings, 0) AS pings FROM (
  SELECT strftime(d, '%Y-%m') AS period, 'monthly' AS kind, CAST(d AS DATE) AS period_start,
         '{_base}/' || strftime(d, '%Y') || '/aisdk-' || strftime(d, '%Y-%m') || '.zip' AS url
  FROM generate_series(DATE '{config.MONTHLY_START}', DATE '{config.MONTHLY_END}', INTERVAL 1 MONTH) g(d)
  UNION ALL
  SELECT strftime(d, '%Y-%m-%d'), 'daily', CAST(d AS DATE),
         CASE WHEN d >= DATE '{config.FLAT_ROOT_FROM}' THEN '{_base}/aisdk-' || strftime(d, '%Y-%m-%d') || '.zip'
              ELSE '{_base}/' || strftime(d, '%Y') || '/aisdk-' || strftime(d, '%Y-%m-%d') || '.zip' END
  FROM generate_series(DATE '{config.DAILY_START}', DATE '{config.DAILY_END}', INTERVAL 1 DAY) g(d)) c
LEFT JOIN (SELECT CASE WHEN date < DATE '{config.DAILY_START}' THEN strftime(date, '%Y-%m')
                       ELSE strftime(date, '%Y-%m-%d') END AS period, count(*) AS pings
           FROM raw GROUP BY 1) n ON n.period = c.period""", ["raw"])
def q_period_calendar(spark, sf_dir):
    """Source calendar (monthly archives, then daily ones, with their URLs) and the raw
    pings each archive period holds in the data: dates before the daily regime belong to
    their month's archive."""
    raw = Tables(spark, sf_dir).raw
    period = F.when(F.col("date") < F.lit(config.DAILY_START), F.date_format("date", "yyyy-MM")) \
              .otherwise(F.date_format("date", "yyyy-MM-dd"))
    counts = raw.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("pings"))
    cal = manifest.period_calendar(spark)
    return (cal.join(counts, "period", "left").na.fill(0, ["pings"])
            .select("period", "kind", F.date_format("period_start", "yyyy-MM-dd").alias("period_start"), "url",
                    "pings"))
