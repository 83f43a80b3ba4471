"""End-to-end runs on real archives: filter, transform, export.

    python -m quayside.pipeline filter    <csv_root> <filtered_root>
    python -m quayside.pipeline transform <filtered_root> <tables_root> [date_from date_to]
    python -m quayside.pipeline export    <filtered_root> <payload_dir> [date_from date_to]
    python -m quayside.pipeline maps      <csv_root> <filtered_root> <documents_root>
    python -m quayside.pipeline maintain  <csv_glob> <tables_root> <checkpoint_dir>

``filter`` reads every archive CSV under ``csv_root`` (daily and monthly folders), keeps
pings inside the port boxes and writes them partitioned by day (re-running a day replaces
only that day); it prints what became of the lines. ``transform`` writes the ten fact tables. ``export`` writes the two dashboard
documents (KPI result sets as one JSON each: ``ports`` and ``zones``), ``maps`` one script per day and month with the
vessels' tracks. ``maintain`` takes in new files only and rewrites the days of the tables that they change. Paths may be any Hadoop file system URI.
"""
from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quayside import config
from quayside.operators import tracks
from quayside.plans import payload
from quayside.plans.tables import Tables
from quayside.session import get_spark
from quayside.sources import ais_csv, documents, filtered, sinks
from quayside.streaming import maintain


def run_filter(spark: SparkSession, csv_root: str, filtered_root: str) -> dict[str, int]:
    return filtered.filter_archive(spark, csv_root, filtered_root)


def run_transform(spark: SparkSession, filtered_root: str, tables_root: str, date_from: str | None = None,
                  date_to: str | None = None) -> None:
    t = Tables(spark, pings=filtered.read_filtered(spark, filtered_root), date_from=date_from, date_to=date_to)
    sinks.write_outputs(t, tables_root)


def run_export(spark: SparkSession, filtered_root: str, out_dir: str, date_from: str | None = None,
               date_to: str | None = None) -> None:
    t = Tables(spark, pings=filtered.read_filtered(spark, filtered_root))
    payload.export_ports(t, f"{out_dir}/ports", date_from, date_to)
    payload.export_zones(t, f"{out_dir}/zones", date_from, date_to)


def run_maps(t: Tables, out_dir: str, day_points: int = config.DAY_MAP_MIN_POINTS) -> None:
    """Documents of all days and all months of the data, under ``days`` and ``months``."""
    day, month = tracks.day_tracks(t.raw, day_points), tracks.month_tracks(t.raw, t.pings)
    columns = lambda df, name, nulls: df.select(name.alias("document"), "mmsi", "name", "type", tracks.track_json(df, nulls).alias("track"))
    documents.write_documents(columns(day, F.date_format("date", "yyyy-MM-dd"), True), f"{out_dir}/days", "VESSEL_DATA", documents.day_fields())
    documents.write_documents(columns(month, F.col("month"), False), f"{out_dir}/months", "AARHUS_VESSEL_DATA", documents.month_fields())


def main(argv: list[str]) -> int:
    least = {"filter": 3, "transform": 3, "export": 3, "maps": 4, "maintain": 4}
    if not argv or len(argv) < least.get(argv[0], len(argv) + 1):
        print(__doc__)
        return 2
    spark = get_spark()
    cmd, src, dst, *window = argv
    if cmd == "filter":
        print(run_filter(spark, src, dst))
    elif cmd == "maps":
        run_maps(Tables(spark, raw=ais_csv.raw_pings_from_csv(spark, src), pings=filtered.read_filtered(spark, dst)), window[0])
    elif cmd == "maintain":
        maintain.run_maintenance(spark, src, dst, window[0])
    elif cmd == "transform":
        run_transform(spark, src, dst, *window)
    else:
        run_export(spark, src, dst, *window)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
