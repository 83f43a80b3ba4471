"""Registered queries: the ten fact tables in their published form."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.plans import oracle
from quayside.plans.registry import register
from quayside.plans.tables import Tables, published

# query key -> published table
FACT_QUERIES = {
    "port_hourly_stats": "port_hourly_stats",
    "vessel_visits": "vessel_visits",
    "type_distribution": "type_distribution",
    "port_navstatus_stats": "port_navstatus_stats",
    "port_speed_stats": "port_speed_stats",
    "port_daily_flow": "port_daily_flow",
    "zone_hourly_stats": "aarhus_zone_hourly_stats",
    "zone_visits": "aarhus_zone_visits",
    "zone_navstatus_stats": "aarhus_navstatus_stats",
    "zone_speed_stats": "aarhus_zone_speed_stats",
}


def _make(table: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return published(Tables(spark, sf_dir).table(table), table)
    q.__name__ = f"q_{table}"
    return q


for _key, _table in FACT_QUERIES.items():
    register(_key, oracle.published_sql(_table))(_make(_table))
