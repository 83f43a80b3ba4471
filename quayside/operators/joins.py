"""Join-shaped operators: presence anti-joins, allow-list semi-join, dimension lookups."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import config
from quayside.functions import geo, vessel


def entries_anti(visit_rows: DataFrame, region: str = "port") -> DataFrame:
    """Visits whose vessel was NOT in the same region the day before: today minus yesterday.

    A left-anti join of the visits against the visits shifted one day forward, on
    (mmsi, region, date). Both sides are the (small) visit table, hash-partitioned on the
    same keys, so it is one sort-merge/shuffled-hash join; AQE may broadcast a small side.
    """
    shifted = visit_rows.select("mmsi", region, F.date_add(F.col("date"), 1).alias("date"))
    return visit_rows.join(shifted, ["mmsi", region, "date"], "left_anti")


def exits_anti(visit_rows: DataFrame, region: str = "port") -> DataFrame:
    """Visits whose vessel is NOT in the same region the day after: today minus tomorrow."""
    shifted = visit_rows.select("mmsi", region, F.date_sub(F.col("date"), 1).alias("date"))
    return visit_rows.join(shifted, ["mmsi", region, "date"], "left_anti")


def core_pings(pings: DataFrame, port: str = "aarhus") -> DataFrame:
    """Map core source: one port's filtered pings from Class A/B vessels with a timestamp."""
    return pings.where((F.col("port") == port) & vessel.is_real_vessel(F.col("mobile_type"))
                       & F.col("ts").isNotNull())


def approach_pings(raw: DataFrame) -> DataFrame:
    """Approach-corridor pings (box compared in double: that source declares no dtypes)."""
    return raw.where(geo.in_box_double(F.col("latitude"), F.col("longitude"), config.APPROACH_BOX)
                     & vessel.is_real_vessel(F.col("mobile_type")) & F.col("ts").isNotNull())


def approach_semi(raw: DataFrame, core: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Corridor pings of vessels also seen in the core box: a left-semi join on MMSI (or on the columns ``by``).

    The allow-list is the distinct MMSIs of the core pings. It is not hinted: AQE sees
    its real size after the aggregate and broadcasts it only when it is under the
    broadcast threshold, otherwise both sides are shuffled on mmsi.
    """
    by = by or ["mmsi"]
    return approach_pings(raw).join(core.select(*by).distinct(), by, "left_semi")
