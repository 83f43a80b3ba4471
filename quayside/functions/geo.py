"""Region predicates and labels as native Column expressions (no UDFs).

Boxes are compared in float32: the position columns are FloatType and every bound is cast
to float first, so a ping exactly on a published edge stays inside (widening the column to
double would drop edge rows whose float32 value lies just outside the double bound).
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside import config

Box = tuple[float, float, float, float]


def flit(x: float) -> Column:
    """A float32 literal (the bound as a float32 column would see it)."""
    return F.lit(float(x)).cast("float")


def f32_sql(x: float) -> str:
    """SQL text of a float32 literal: the double value narrowed to float (``D`` keeps the
    literal a DOUBLE; a bare ``55.4`` would be DECIMAL)."""
    return f"CAST({float(x)!r}D AS FLOAT)"


def in_box_sql(box: "Box", lat: str = "latitude", lon: str = "longitude") -> str:
    a, b, c, d = box
    return f"({lat} BETWEEN {f32_sql(a)} AND {f32_sql(b)} AND {lon} BETWEEN {f32_sql(c)} AND {f32_sql(d)})"


def in_box(lat: Column, lon: Column, box: Box) -> Column:
    """Inclusive box test in float32."""
    lat_min, lat_max, lon_min, lon_max = box
    return lat.between(flit(lat_min), flit(lat_max)) & lon.between(flit(lon_min), flit(lon_max))


def in_box_double(lat: Column, lon: Column, box: Box) -> Column:
    """Inclusive box test in double (for sources read without a declared dtype)."""
    lat_min, lat_max, lon_min, lon_max = box
    return (lat.cast("double").between(F.lit(lat_min), F.lit(lat_max))
            & lon.cast("double").between(F.lit(lon_min), F.lit(lon_max)))


def any_region_sql(regions: Mapping[str, Box] = config.PORTS, lat: str = "latitude",
                   lon: str = "longitude") -> str:
    return "(" + " OR ".join(in_box_sql(b, lat, lon) for b in regions.values()) + ")"


def any_region(lat: str = "latitude", lon: str = "longitude", regions: Mapping[str, Box] = config.PORTS) -> Column:
    """True when the position lies in at least one region (edges inclusive)."""
    return F.expr(any_region_sql(regions, lat, lon))


def region_label_sql(regions: Mapping[str, Box] = config.PORTS, outside: str | None = "",
                     lat: str = "latitude", lon: str = "longitude") -> str:
    """Name of the matching region; when boxes overlap the LAST one in order wins."""
    whens = " ".join(f"WHEN {in_box_sql(b, lat, lon)} THEN '{n}'" for n, b in reversed(list(regions.items())))
    other = "NULL" if outside is None else f"'{outside}'"
    return f"CASE {whens} ELSE {other} END"


def region_label(lat: str = "latitude", lon: str = "longitude", regions: Mapping[str, Box] = config.PORTS,
                 outside: str | None = "") -> Column:
    return F.expr(region_label_sql(regions, outside, lat, lon))


def zone_band() -> Box:
    """The band shared by anchorage and south_terminal (their inner edges are unused)."""
    z = config.AARHUS_ZONES
    return (z["anchorage"][0], z["anchorage"][1], z["anchorage"][2], z["south_terminal"][3])


def _diagonal_sql(lat: str) -> str:
    (lat_a, lon_a), (lat_b, lon_b) = config.ANCHORAGE_DIAGONAL
    step = f"CAST(({lat} - {f32_sql(lat_a)}) * {f32_sql(lon_b - lon_a)} AS FLOAT)"
    step = f"CAST({step} / {f32_sql(lat_b - lat_a)} AS FLOAT)"
    return f"CAST({f32_sql(lon_a)} + {step} AS FLOAT)"


def zone_label_sql(lat: str = "latitude", lon: str = "longitude") -> str:
    """Aarhus sub-zone of a float32 position, or null (the NW gap).

    Precedence: outer_approach, north_terminal, then the shared band split by the
    diagonal (west -> anchorage, on/east -> south_terminal). The inner edges of the two
    band zones are not used; the band spans anchorage.lon_min..south_terminal.lon_max.
    The diagonal ``lon_a + (lat - lat_a) * dlon / dlat`` is evaluated in float32 step by
    step (Spark's float/float is double, so each step is narrowed back to float).
    """
    z = config.AARHUS_ZONES
    return (f"CASE WHEN {in_box_sql(z['outer_approach'], lat, lon)} THEN 'outer_approach' "
            f"WHEN {in_box_sql(z['north_terminal'], lat, lon)} THEN 'north_terminal' "
            f"WHEN {in_box_sql(zone_band(), lat, lon)} THEN "
            f"CASE WHEN {lon} < {_diagonal_sql(lat)} THEN 'anchorage' ELSE 'south_terminal' END END")


def zone_label(lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.expr(zone_label_sql(lat, lon))


def in_any_zone(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Exactly the positions :func:`zone_label` labels (the union of the zone boxes)."""
    z = config.AARHUS_ZONES
    boxes = [z["outer_approach"], z["north_terminal"], zone_band()]
    return F.expr("(" + " OR ".join(in_box_sql(b, lat, lon) for b in boxes) + ")")


def zone_index(lat: Column, lon: Column) -> Column:
    """Map zone index 0..3 (``ZONE_ORDER``) of a double position, or null.

    Used by the month map on coordinates already rounded to 5 dp, so the whole test runs
    in double, unlike :func:`zone_label`.
    """
    z = config.AARHUS_ZONES
    idx = {name: i for i, name in enumerate(config.ZONE_ORDER)}
    (lat_a, lon_a), (lat_b, lon_b) = config.ANCHORAGE_DIAGONAL
    lat = lat.cast("double")
    lon = lon.cast("double")
    band = (z["anchorage"][0], z["anchorage"][1], z["anchorage"][2], z["south_terminal"][3])
    boundary = F.lit(lon_a) + (lat - F.lit(lat_a)) * (F.lit(lon_b) - F.lit(lon_a)) / (F.lit(lat_b) - F.lit(lat_a))
    return (
        F.when(in_box_double(lat, lon, z["outer_approach"]), F.lit(idx["outer_approach"]))
        .when(in_box_double(lat, lon, z["north_terminal"]), F.lit(idx["north_terminal"]))
        .when(in_box_double(lat, lon, band),
              F.when(lon < boundary, F.lit(idx["anchorage"])).otherwise(F.lit(idx["south_terminal"])))
    )
