"""Map documents (N3): one script per day or month, ``window.NAME={..., "vessels":[...]};``, written by many tasks.

A document is a folder of text parts that read in the order of their names: first the head with the document's own fields,
then one line per vessel in the order of MMSI, last the foot. Lines are dealt out by range, so a part holds a stretch of
vessels and no task a whole document; joining the parts (``cat``) gives the script.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config

HEAD, VESSEL, FOOT = 0, 1, 2
SHIP_TYPES = [*config.TOP_TYPES, "Other"]


def _json(value) -> str:
    return json.dumps(value, separators=(",", ":"))


def day_fields() -> Column:
    """The own fields of a day's document, whose name is the day."""
    fixed = (f',"bbox":{_json(config.COVERAGE_BOX)},"bucket_minutes":{config.DAY_MAP_BUCKET_MINUTES},"ship_types":{_json(SHIP_TYPES)},'
             f'"ports":{_json(config.PORTS)}')
    return F.concat(F.lit('"date":"'), F.col("document"), F.lit('"' + fixed))


def month_fields() -> Column:
    """The own fields of a month's document, whose name is the month as yyyy-MM."""
    first = F.to_date(F.concat("document", F.lit("-01")))
    minutes = F.dayofmonth(F.last_day(first)) * 1440
    return F.concat(F.lit('"start_date":"'), F.date_format(first, "yyyy-MM-dd"), F.lit('","end_date":"'), F.date_format(F.last_day(first), "yyyy-MM-dd"),
                    F.lit(f'","bucket_minutes":{config.MONTH_MAP_BUCKET_MINUTES},"total_minutes":'), minutes.cast("string"),
                    F.lit(f',"zone_order":{_json(config.ZONE_ORDER)},"ship_types":{_json(SHIP_TYPES)}'))


def write_documents(vessels: DataFrame, path: str, variable: str, fields: Column) -> None:
    """One document per ``document`` of ``vessels`` (document, mmsi, name, type, and ``track`` as JSON text)."""
    own = F.to_json(F.struct("mmsi", "name", "type"))
    text = F.concat(F.expr("substr(own, 1, length(own) - 1)"), F.lit(',"track":'), F.col("track"), F.lit("}"))
    named = vessels.groupBy("document").agg(F.min("mmsi").alias("least"))
    lines = (vessels.withColumn("own", own).join(named, "document")
             .select("document", F.lit(VESSEL).alias("part"), "mmsi", F.concat(F.expr("IF(mmsi = least, '', ',')"), text).alias("value")))
    head = named.select("document", F.lit(HEAD).alias("part"), F.lit(0).cast("long").alias("mmsi"),
                        F.concat(F.lit(f"window.{variable}={{"), fields, F.lit(',"vessels":[')).alias("value"))
    foot = named.select("document", F.lit(FOOT).alias("part"), F.lit(0).cast("long").alias("mmsi"), F.lit("]};").alias("value"))
    order = ["document", "part", "mmsi"]
    (lines.unionByName(head).unionByName(foot).repartitionByRange(*order).sortWithinPartitions(*order)
     .select("document", "value").write.mode("overwrite").partitionBy("document").text(path))


def read_vessels(spark: SparkSession, path: str) -> DataFrame:
    """document, mmsi, name, type and track (JSON text) of written documents; head and foot are no vessels."""
    lines = spark.read.schema("value string, document string").text(path)
    v = lines.select("document", F.regexp_replace("value", "^,", "").alias("v")).where(F.col("v").startswith("{"))
    field = lambda name: F.get_json_object("v", f"$.{name}")
    return v.select("document", field("mmsi").cast("long").alias("mmsi"), field("name").alias("name"), field("type").alias("type"),
                    F.regexp_extract("v", r'"track":(\[.*\])\}$', 1).alias("track"))
