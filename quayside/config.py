"""Fixed configuration: region boxes, sub-zones, type keys and pipeline constants.

Every value in the FIXED VALUES block must equal the reference's for results to match;
they are stated here once, in natural order, and everything else derives from them.
"""
from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's settings for identical results)
# ---------------------------------------------------------------------------

# Port boxes, name -> (lat_min, lat_max, lon_min, lon_max); edges inclusive.
PORTS: dict[str, tuple[float, float, float, float]] = {
    "esbjerg": (55.40, 55.55, 8.35, 8.55),
    "aarhus": (56.10, 56.22, 10.15, 10.30),
    "copenhagen": (55.60, 55.75, 12.50, 12.70),
    "aalborg": (57.00, 57.10, 9.85, 9.98),
    "fredericia": (55.53, 55.62, 9.68, 9.82),
}

# Aarhus sub-zones, name -> (lat_min, lat_max, lon_min, lon_max).
AARHUS_ZONES: dict[str, tuple[float, float, float, float]] = {
    "outer_approach": (56.10, 56.14, 10.15, 10.30),
    "anchorage": (56.14, 56.17, 10.15, 10.25),
    "south_terminal": (56.14, 56.17, 10.22, 10.30),
    "north_terminal": (56.17, 56.22, 10.18, 10.30),
}

# Diagonal between anchorage (west) and south_terminal (east): (lat, lon) south, north.
ANCHORAGE_DIAGONAL: tuple[tuple[float, float], tuple[float, float]] = ((56.14, 10.21), (56.17, 10.25))

# Corners of the zones as drawn, (lat, lon) counter-clockwise from the south-west.
ZONE_VERTICES: dict[str, list[tuple[float, float]]] = {
    "outer_approach": [(56.10, 10.15), (56.10, 10.30), (56.14, 10.30), (56.14, 10.15)],
    "anchorage": [(56.14, 10.15), (56.14, 10.21), (56.17, 10.25), (56.17, 10.15)],
    "south_terminal": [(56.14, 10.21), (56.14, 10.30), (56.17, 10.30), (56.17, 10.25)],
    "north_terminal": [(56.17, 10.18), (56.17, 10.30), (56.22, 10.30), (56.22, 10.18)],
}

# Zone display order (map index 0..3) and labels.
ZONE_ORDER = ["outer_approach", "anchorage", "south_terminal", "north_terminal"]
ZONE_LABELS = {
    "outer_approach": "Outer Approach",
    "anchorage": "Anchorage",
    "south_terminal": "South Terminal (Ferry/RoRo)",
    "north_terminal": "North Terminal (Container)",
}

# Ship-type normalisation keys: lower-case substring -> label (pipeline form: last match wins).
TYPE_KEYS: list[tuple[str, str]] = [
    ("cargo", "Cargo"),
    ("tanker", "Tanker"),
    ("passenger", "Passenger"),
    ("fishing", "Fishing"),
    ("tug", "Tug"),
    ("pleasure craft", "Pleasure Craft"),
    ("hsc", "HSC"),
    ("sar", "SAR"),
]
# Map-preparation form: labels tested in this order, first match wins.
TOP_TYPES = ["Cargo", "Tanker", "Passenger", "Fishing", "Tug", "Pleasure Craft", "HSC", "SAR"]
OTHER_TYPE = "Other"

SOG_SENTINEL = 102.3          # AIS "speed not available"
STATIONARY_SOG = 0.5          # knots; below = stationary
MOBILE_TYPES = ["Class A", "Class B"]

# Coverage box of the day map / exploration (54-62 N, 7-17 E).
COVERAGE_BOX = (54.0, 62.0, 7.0, 17.0)
# Aarhus map: core box and eastern approach corridor (lat_min, lat_max, lon_min, lon_max).
CORE_BOX = (56.10, 56.22, 10.15, 10.30)
APPROACH_BOX = (56.05, 56.25, 10.30, 10.55)

DAY_MAP_BUCKET_MINUTES = 10
DAY_MAP_MIN_POINTS = 10
MONTH_MAP_BUCKET_MINUTES = 1
MONTH_MAP_MIN_POINTS = 3

FLOW_PAD_DAYS = 3             # padding of the daily-flow export window
SAMPLE_PER_PORT = 5000        # exploration scatter sample size
SAMPLE_SEED = 42
TYPE_FREQUENCY_TOP = 12
LUMP_TOP_N = 8
SPEED_HIST_BINS = 60
SPEED_HIST_RANGE = (0.0, 30.0)
DWELL_HIST_BINS = 30
DWELL_HIST_MAX_HOURS = 24.0

# Raw daily CSV: the twelve columns used, by header name, and the timestamp format.
RAW_COLUMNS = [
    "# Timestamp", "Type of mobile", "MMSI", "Latitude", "Longitude", "Navigational status",
    "SOG", "COG", "Heading", "Ship type", "Name", "Destination",
]
RAW_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"

# Source calendar: monthly archives, then daily archives; URL layout switches on FLAT_ROOT_FROM.
MONTHLY_START = _dt.date(2006, 3, 1)
MONTHLY_END = _dt.date(2024, 2, 1)
DAILY_START = _dt.date(2024, 3, 1)
DAILY_END = _dt.date(2026, 4, 13)
FLAT_ROOT_FROM = _dt.date(2025, 2, 27)
SOURCE_BASE_URL = "http://aisdata.ais.dk"

# ---------------------------------------------------------------------------
# Derived values
# ---------------------------------------------------------------------------
PORT_NAMES = list(PORTS)
ZONE_NAMES = list(AARHUS_ZONES)
TYPE_LABELS = [label for _, label in TYPE_KEYS] + [OTHER_TYPE]
