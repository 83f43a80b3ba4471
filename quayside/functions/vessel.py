"""Vessel attributes: ship-type normalisation, speed validity, display names."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import config


def _last_wins_sql(low: str) -> str:
    whens = " ".join(f"WHEN contains({low}, '{k}') THEN '{lbl}'" for k, lbl in reversed(config.TYPE_KEYS))
    return f"CASE {whens} ELSE '{config.OTHER_TYPE}' END"


def _first_wins_sql(low: str) -> str:
    whens = " ".join(f"WHEN contains({low}, '{t.lower()}') THEN '{t}'" for t in config.TOP_TYPES)
    return f"CASE {whens} ELSE '{config.OTHER_TYPE}' END"


def with_vessel_type(df: DataFrame, src: str = "ship_type", out: str = "vessel_type",
                     first_wins: bool = False) -> DataFrame:
    """Add the normalised type; null becomes "Other".

    Pipeline form: lower-cased, trimmed substring match, the LAST matching key wins (``Tug/Cargo`` -> ``Tug``). Map form
    (``first_wins``): the FIRST matching label wins (``Tug/Cargo`` -> ``Cargo``). The lower-cased text is its own projection, referenced
    by every branch, so it is computed once per row (Catalyst keeps a non-trivial
    expression used eight times in a separate projection instead of copying it)."""
    tmp = f"_{out}_low"
    if first_wins:
        low = F.lower(F.col(src))
        case = _first_wins_sql(tmp)
    else:
        low = F.lower(F.trim(F.coalesce(F.col(src), F.lit(""))))
        case = _last_wins_sql(tmp)
    return df.withColumn(tmp, low).withColumn(out, F.expr(case)).drop(tmp)


def valid_speed(sog: Column) -> Column:
    """True for a usable speed: below the 102.3 sentinel (null is not usable)."""
    return sog < F.lit(config.SOG_SENTINEL)


def speed_or_null(sog: Column) -> Column:
    """Speed with the sentinel (and anything above it) replaced by null."""
    return F.when(valid_speed(sog), sog)


def stationary_flag(sog: Column) -> Column:
    return (sog < F.lit(config.STATIONARY_SOG)).cast("int")


def display_name(name: Column, mmsi: Column) -> Column:
    """Blank, null or the text 'nan' -> ``MMSI <id>``; otherwise the name."""
    cleaned = F.trim(name)
    usable = cleaned.isNotNull() & (cleaned != F.lit("")) & (name != F.lit("nan"))
    return F.when(usable, name).otherwise(F.concat(F.lit("MMSI "), mmsi.cast("string")))


def is_real_vessel(mobile_type: Column) -> Column:
    """Class A / Class B transponders only (drops base stations, AtoN and the rest)."""
    return mobile_type.isin(*config.MOBILE_TYPES)
