"""The pipeline as lazy DataFrames: raw pings -> filtered pings -> ten fact tables.

Nothing here executes; every property is a logical plan that Catalyst optimises together
with whatever query consumes it (column pruning reaches the Parquet scan, the box and
date predicates are pushed into it). Pings are never cached: each consumer re-reads the
columns it needs, which at 100 TB is cheaper than materialising all pings in memory.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import timeparts
from quayside.operators import facts, regions
from quayside.sources import fixture


class Tables:
    """All derived tables of one dataset, optionally restricted to a date range.

    The source is one of: ``sf_dir`` (the driver's test data, projected to pings),
    ``raw`` (raw pings, e.g. :func:`quayside.sources.ais_csv.raw_pings_from_csv`) or
    ``pings`` (already filtered and labelled, e.g. the filtered Parquet table, where the
    date window becomes partition pruning).
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, date_from: str | None = None,
                 date_to: str | None = None, raw: DataFrame | None = None, pings: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.date_from = date_from
        self.date_to = date_to
        self._raw = raw
        self._pings = pings

    def window(self, date_from: str | None, date_to: str | None) -> "Tables":
        """The same source restricted to a date range (of this object's own range)."""
        if date_from is None and date_to is None:
            return self
        pick = lambda a, b, f: f(x for x in (a, b) if x is not None) if a is not None or b is not None else None
        return Tables(self.spark, self.sf_dir, pick(self.date_from, date_from, max), pick(self.date_to, date_to, min), self._raw, self._pings)

    def _window(self, df: DataFrame) -> DataFrame:
        if self.date_from is not None:
            df = df.where(F.col("date") >= F.lit(self.date_from).cast("date"))
        if self.date_to is not None:
            df = df.where(F.col("date") <= F.lit(self.date_to).cast("date"))
        return df

    # ---- pings ---------------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        if self._raw is not None:
            return self._window(self._raw)
        if self.sf_dir is None:
            raise ValueError("no raw source: give sf_dir or raw")
        return self._window(fixture.raw_pings(self.spark, self.sf_dir))

    @cached_property
    def pings(self) -> DataFrame:
        """Filtered pings: inside a port box, labelled with ``port``."""
        if self._pings is not None:
            return self._window(self._pings)
        return regions.filter_and_label(self.raw)

    @cached_property
    def zoned(self) -> DataFrame:
        """Aarhus pings labelled with their sub-zone; unzoned pings dropped."""
        return regions.assign_zones(self.pings.where(F.col("port") == "aarhus"))

    # ---- port tables -----------------------------------------------------------
    @cached_property
    def port_hourly_stats(self) -> DataFrame:
        return facts.hourly_stats(self.pings, "port")

    @cached_property
    def vessel_visits(self) -> DataFrame:
        return facts.visits(self.pings, "port", with_hours=True)

    @cached_property
    def type_distribution(self) -> DataFrame:
        return facts.type_distribution(self.pings, "port")

    @cached_property
    def port_navstatus_stats(self) -> DataFrame:
        return facts.navstatus_stats(self.pings, "port", by_type=False)

    @cached_property
    def port_speed_stats(self) -> DataFrame:
        return facts.port_speed_stats(self.pings, "port")

    @cached_property
    def port_daily_flow(self) -> DataFrame:
        return facts.daily_flow(self.vessel_visits, "port")

    # ---- zone tables -----------------------------------------------------------
    @cached_property
    def zone_hourly_stats(self) -> DataFrame:
        return facts.hourly_stats(self.zoned, "zone")

    @cached_property
    def zone_visits(self) -> DataFrame:
        return facts.visits(self.zoned, "zone", with_hours=False)

    @cached_property
    def zone_navstatus_stats(self) -> DataFrame:
        return facts.navstatus_stats(self.zoned, "zone", by_type=True)

    @cached_property
    def zone_speed_stats(self) -> DataFrame:
        return facts.zone_speed_stats(self.zoned, "zone")

    def table(self, name: str) -> DataFrame:
        return getattr(self, TABLE_ATTRS[name])

    def materialized(self) -> "Tables":
        """The same tables computed from filtered pings written once with a reliable
        ``checkpoint()`` (under ``spark.checkpoint.dir``, shared storage on a cluster).

        For jobs that derive many tables in one go: the box filter and labels run once
        instead of once per table, and each table's lineage starts at the checkpoint, so a
        lost executor recomputes from there rather than from the raw scan."""
        from quayside.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        return Tables(self.spark, pings=self.pings.checkpoint(eager=True))


class StoredTables(Tables):
    """The ten tables as read from where they are stored by day (``streaming.maintain``): every KPI and roll-up that takes
    :class:`Tables` runs on these, from the stored rows alone. Pings are not read; a date window prunes folders."""

    def __init__(self, spark: SparkSession, root: str, date_from: str | None = None, date_to: str | None = None):
        super().__init__(spark, date_from=date_from, date_to=date_to)
        self.root = root.rstrip("/")

    def window(self, date_from: str | None, date_to: str | None) -> "StoredTables":
        w = super().window(date_from, date_to)
        return self if w is self else StoredTables(self.spark, self.root, w.date_from, w.date_to)

    @property
    def pings(self) -> DataFrame:
        raise ValueError("stored tables have no pings")

    def _read(self, table: str) -> DataFrame:
        df = self.spark.read.schema(TABLE_SCHEMAS[table]).parquet(f"{self.root}/{table}")
        for c in ("first_seen", "last_seen"):
            if c in df.columns:
                df = df.withColumn(c, F.to_timestamp_ntz(c, F.lit("yyyy-MM-dd HH:mm:ss")))
        return self._window(df)


# Published table name -> attribute, in load order.
TABLE_ATTRS = {
    "port_hourly_stats": "port_hourly_stats",
    "vessel_visits": "vessel_visits",
    "type_distribution": "type_distribution",
    "port_navstatus_stats": "port_navstatus_stats",
    "port_speed_stats": "port_speed_stats",
    "port_daily_flow": "port_daily_flow",
    "aarhus_zone_hourly_stats": "zone_hourly_stats",
    "aarhus_zone_visits": "zone_visits",
    "aarhus_navstatus_stats": "zone_navstatus_stats",
    "aarhus_zone_speed_stats": "zone_speed_stats",
}

# Column order of each published table (dates and timestamps as ISO text).
TABLE_COLUMNS = {
    "port_hourly_stats": ["port", "date", "hour", "vessel_type", "vessel_count"],
    "vessel_visits": ["mmsi", "port", "date", "first_seen", "last_seen", "vessel_type", "ping_count",
                      "dwell_minutes", "entry_hour", "exit_hour"],
    "type_distribution": ["port", "date", "vessel_type", "count"],
    "port_navstatus_stats": ["port", "date", "nav_status", "ping_count"],
    "port_speed_stats": ["port", "date", "hour", "sog_mean", "sog_median", "sog_p95", "pct_stationary"],
    "port_daily_flow": ["port", "date", "vessel_type", "unique_vessels", "entries", "exits",
                        "avg_dwell_minutes"],
    "aarhus_zone_hourly_stats": ["zone", "date", "hour", "vessel_type", "vessel_count"],
    "aarhus_zone_visits": ["mmsi", "zone", "date", "first_seen", "last_seen", "vessel_type", "ping_count",
                           "dwell_minutes"],
    "aarhus_navstatus_stats": ["zone", "date", "vessel_type", "nav_status", "ping_count"],
    "aarhus_zone_speed_stats": ["zone", "date", "hour", "vessel_type", "sog_mean", "sog_median", "sog_p025",
                                "sog_p95", "sog_p975"],
}

#: Types of the columns; those not named here are strings.
_COLUMN_TYPES = ({"date": "date"} | dict.fromkeys(("mmsi", "vessel_count", "ping_count", "count", "unique_vessels", "entries", "exits"), "bigint")
                 | dict.fromkeys(("hour", "entry_hour", "exit_hour"), "int")
                 | dict.fromkeys(("dwell_minutes", "avg_dwell_minutes", "sog_mean", "sog_median", "sog_p025", "sog_p95", "sog_p975",
                                  "pct_stationary"), "double"))
#: A stored table's schema; ``date`` is the name of its folders.
TABLE_SCHEMAS = {t: ", ".join(f"`{c}` {_COLUMN_TYPES.get(c, 'string')}" for c in cs) for t, cs in TABLE_COLUMNS.items()}

for _table, _attr in TABLE_ATTRS.items():
    setattr(StoredTables, _attr, property(lambda self, name=_table: self._read(name)))


PRIMARY_KEYS = {
    "port_hourly_stats": ["port", "date", "hour", "vessel_type"],
    "vessel_visits": ["mmsi", "port", "date"],
    "type_distribution": ["port", "date", "vessel_type"],
    "port_navstatus_stats": ["port", "date", "nav_status"],
    "port_speed_stats": ["port", "date", "hour"],
    "port_daily_flow": ["port", "date", "vessel_type"],
    "aarhus_zone_hourly_stats": ["zone", "date", "hour", "vessel_type"],
    "aarhus_zone_visits": ["mmsi", "zone", "date"],
    "aarhus_navstatus_stats": ["zone", "date", "vessel_type", "nav_status"],
    "aarhus_zone_speed_stats": ["zone", "date", "hour", "vessel_type"],
}


def published(df: DataFrame, table: str) -> DataFrame:
    """The stored form of a fact table: fixed column order, ISO text for dates/times."""
    cols = []
    for c in TABLE_COLUMNS[table]:
        if c == "date":
            cols.append(timeparts.iso_date(F.col(c)).alias(c))
        elif c in ("first_seen", "last_seen"):
            cols.append(timeparts.iso_ts(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
