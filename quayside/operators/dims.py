"""Small dimensions derived from the fixed region configuration.

They are bounded by the configuration (5 ports, 4 zones), so broadcasting them is safe.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import config
from quayside.functions import numeric


def port_dimension(spark: SparkSession) -> DataFrame:
    """Ports with display name, centroid (4 dp) and box corners."""
    rows = [(i, name, *box) for i, (name, box) in enumerate(config.PORTS.items())]
    schema = "port_order int, key string, lat_min double, lat_max double, lon_min double, lon_max double"
    df = spark.createDataFrame(rows, schema)
    return df.select(
        "port_order", F.initcap("key").alias("name"), "key",
        numeric.round_even((F.col("lat_min") + F.col("lat_max")) / F.lit(2.0), 4).alias("lat"),
        numeric.round_even((F.col("lon_min") + F.col("lon_max")) / F.lit(2.0), 4).alias("lon"),
        "lat_min", "lat_max", "lon_min", "lon_max")


def zone_polygons(spark: SparkSession) -> DataFrame:
    """Zone polygons as rows (zone, vertex, lat, lon); anchorage and south_terminal share
    the diagonal edge. Vertex order is counter-clockwise from the south-west."""
    rows = [(order, zone, config.ZONE_LABELS[zone], i, lat, lon) for order, zone in enumerate(config.ZONE_ORDER)
            for i, (lat, lon) in enumerate(config.ZONE_VERTICES[zone])]
    schema = T.StructType([
        T.StructField("zone_order", T.IntegerType()), T.StructField("zone", T.StringType()),
        T.StructField("label", T.StringType()), T.StructField("vertex", T.IntegerType()),
        T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    ])
    return spark.createDataFrame(rows, schema)


def zone_label_points(polygons: DataFrame) -> DataFrame:
    """Label point of each zone: the mean of its vertices, summed in vertex order."""
    verts = F.array_sort(F.collect_list(F.struct("vertex", "lat", "lon")))
    mean = lambda f: F.aggregate(verts, F.lit(0.0), lambda acc, v: acc + v[f]) / F.size(verts)
    return polygons.groupBy("zone").agg(mean("lat").alias("label_lat"), mean("lon").alias("label_lon"))
