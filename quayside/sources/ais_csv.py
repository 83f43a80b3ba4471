"""Raw AIS CSV: scan (S1), period discovery (S2) and a writer for the same layout.

Files of an archive need not share one layout: columns are mapped by the HEADER NAME of
each file, never by position. Files are grouped by header line (the first line of each,
found by a scan), and every group is scanned as text lines that are parsed with its own
names. What makes a line bad is counted in the line itself -- more fields than its
header has -- so it does not depend on the columns a query selects. Short lines are padded
with nulls; every field is converted with ``try_cast`` / ``try_to_timestamp``, so an
unparsable number or time becomes null instead of failing the job. A record is one line:
fields may be quoted, but hold no line feed.
"""
from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from quayside import config

# Raw header name -> (engine column, type)
RAW_FIELDS = {
    "# Timestamp": ("ts", "timestamp"),
    "Type of mobile": ("mobile_type", "string"),
    "MMSI": ("mmsi", "bigint"),
    "Latitude": ("latitude", "float"),
    "Longitude": ("longitude", "float"),
    "Navigational status": ("nav_status", "string"),
    "SOG": ("sog", "float"),
    "COG": ("cog", "float"),
    "Heading": ("heading", "float"),
    "Ship type": ("ship_type", "string"),
    "Name": ("name", "string"),
    "Destination": ("destination", "string"),
}
ENGINE_NAMES = [name for name, _ in RAW_FIELDS.values()]
# Extra archive columns written by :func:`write_raw_csv` so readers must map by name.
EXTRA_COLUMNS = ["ROT", "IMO", "Callsign", "Cargo type", "Width", "Length"]
TOO_LONG = "too_long"       # the line has more fields than its header

PERIOD_RE = r"aisdk-(\d{4}-\d{2}(?:-\d{2})?)"


def _any(spark: SparkSession, path: str) -> bool:
    """Whether a folder, file or glob is there: one call to its file system."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(root))


def _csv(reader: DataFrameReader) -> DataFrameReader:
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")


def file_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file and header: the first line of each CSV file under some paths, found by a scan; files that begin with an empty line have none.

    The line is the first of the split that begins the file: a task numbers what it reads in order."""
    lines = _csv(spark.read).text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    begins = lines.where("file_block_start = 0").select("file_path", "value", F.monotonically_increasing_id().alias("place"))
    return (begins.groupBy(F.col("file_path").alias("file")).agg(F.min_by("value", "place").alias("header")).where("header <> ''"))


def layouts(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> the CSV files under ``path`` (a folder, file or glob) that begin with it. No file is read by the driver."""
    found: dict[str, list[str]] = {}
    if _any(spark, path):
        for r in file_headers(spark, path).collect():
            found.setdefault(r["header"], []).append(unquote(r["file"]))
    return found


def catalogue(spark: SparkSession, path: str, store: str) -> DataFrame:
    """file and header of all CSV files under ``path``, kept as a table at ``store``: only files that it doesn't know yet are read."""
    known = spark.read.schema("file string, header string").parquet(store) if _any(spark, store) else None
    if _any(spark, path):
        listed = _csv(spark.read.format("binaryFile")).load(path).select(F.col("_metadata.file_path").alias("file"))
        new = [unquote(r["file"]) for r in (listed if known is None else listed.join(known, "file", "left_anti")).collect()]
        if new:
            file_headers(spark, new).write.mode("append").parquet(store)
    return spark.read.schema("file string, header string").parquet(store) if _any(spark, store) else spark.createDataFrame([], "file string, header string")


def header_names(line: str) -> list[str]:
    return [n.strip().lstrip("﻿") for n in next(csv.reader([line]))]


def parsed(line: Column, header: str) -> Column:
    """A struct of the twelve engine columns and ``too_long``, from a text line of a file with this header."""
    names = header_names(header)
    fields = F.from_csv(line, ", ".join(f"c{i} STRING" for i in range(len(names))))
    out = []
    for raw, (name, typ) in RAW_FIELDS.items():
        to = "timestamp_ntz" if typ == "timestamp" else typ
        if raw not in names:
            out.append(F.lit(None).cast(to).alias(name))
            continue
        c = fields[f"c{names.index(raw)}"]
        if typ == "timestamp":
            c = F.try_to_timestamp(c, F.lit(config.RAW_TIMESTAMP_FORMAT)).cast(to)
        elif typ != "string":
            c = c.try_cast(typ)
        out.append(c.alias(name))
    commas = F.regexp_count(F.regexp_replace(line, '"[^"]*"', ""), F.lit(","))
    return F.struct(*out, (commas >= len(names)).alias(TOO_LONG))


def with_period(df: DataFrame, path_col: str) -> DataFrame:
    """Add ``period`` and ``period_date`` from a file path: the day, or the first of the month of a monthly archive."""
    period = F.nullif(F.regexp_extract(path_col, PERIOD_RE, 1), F.lit(""))
    first = F.when(F.length("period") == 7, F.concat("period", F.lit("-01"))).otherwise(F.col("period"))
    return df.withColumn("period", period).withColumn("period_date", F.to_date(first))


def scan_periods(spark: SparkSession, root: str) -> DataFrame:
    """All lines of the CSV files under ``root``, daily and monthly archives in one scan.

    The twelve engine columns, ``too_long``, ``period`` and ``period_date`` (null where the path names no period)."""
    out = None
    for header, files in sorted(layouts(spark, root).items()):
        lines = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"))
        rows = lines.where((F.col("value") != header) & (F.trim("value") != "")).select(parsed(F.col("value"), header).alias("r"), "file")
        rows = with_period(rows, "file").select("r.*", "period", "period_date")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        types = ", ".join(f"{n} {'timestamp_ntz' if t == 'timestamp' else t}" for n, t in RAW_FIELDS.values())
        out = spark.createDataFrame([], f"{types}, {TOO_LONG} boolean, period string, period_date date")
    return out


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The twelve engine columns of every line under ``path``, and ``too_long``."""
    return scan_periods(spark, path).drop("period", "period_date")


def clean_rows(df: DataFrame) -> DataFrame:
    """Drop the lines the reference skips (too many fields) and rows without a valid MMSI."""
    return df.where(~F.col(TOO_LONG) & F.col("mmsi").isNotNull()).drop(TOO_LONG)


def as_pings(rows: DataFrame) -> DataFrame:
    """Parsed rows with a period as engine pings, the same for batch and stream: bad lines and rows without MMSI
    dropped, ``date`` that of the period (of the time where the path names none), and ``event_id``, a hash of the
    row's fields that breaks time ties the same way on every run."""
    return (clean_rows(rows).withColumn("date", F.coalesce("period_date", F.to_date("ts")))
            .withColumn("event_id", F.xxhash64(*ENGINE_NAMES)).drop("period", "period_date"))


def raw_pings_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw archive CSV as engine pings."""
    return as_pings(scan_periods(spark, path))


def write_raw_csv(raw_pings: DataFrame, path: str, period_col: str | None = None, columns: list[str] | None = None,
                  mode: str = "overwrite", quote: str = '"') -> None:
    """Write pings in the archive layout: header names, day-first timestamps, extra columns.

    With ``period_col`` the files land in one folder per period value. ``columns`` gives raw header names and their
    order (else all, in an order that differs from the reader's list). A text column of the raw name is written as it
    is, in place of the engine column."""
    cols = []
    for raw in columns or (list(RAW_FIELDS) + EXTRA_COLUMNS)[::-1]:
        name = RAW_FIELDS[raw][0] if raw in RAW_FIELDS else None
        if raw in raw_pings.columns:
            c = F.col(f"`{raw}`")
        elif name == "ts":
            c = F.date_format(F.col("ts"), config.RAW_TIMESTAMP_FORMAT)
        elif name in raw_pings.columns:
            c = F.col(name).cast("string")
        else:
            c = F.lit(None).cast("string")
        cols.append(c.alias(raw))
    if period_col:
        cols.append(F.col(period_col))
    w = (raw_pings.select(*cols).write.mode(mode).option("header", True).option("quote", quote)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if period_col:
        w = w.partitionBy(period_col)
    w.csv(path)
