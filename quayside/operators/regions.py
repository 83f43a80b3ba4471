"""Region operators: box filter, port label, Aarhus zones, coverage filter, region join."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import config
from quayside.functions import geo, vessel


def bbox_filter(pings: DataFrame, regions: Mapping[str, geo.Box] = config.PORTS) -> DataFrame:
    """Keep pings inside any region box (float32, edges inclusive).

    A plain ``where`` on lat/lon: Parquet receives the range predicates as pushed filters
    and skips row groups whose statistics fall outside every box.
    """
    return pings.where(geo.any_region("latitude", "longitude", regions))


def port_label(pings: DataFrame, regions: Mapping[str, geo.Box] = config.PORTS) -> DataFrame:
    """Add ``port``: the matching region, last one wins, "" outside."""
    return pings.withColumn("port", geo.region_label("latitude", "longitude", regions))


def filter_and_label(pings: DataFrame, regions: Mapping[str, geo.Box] = config.PORTS) -> DataFrame:
    """The filter step: box filter then label (one narrow stage, no shuffle)."""
    return port_label(bbox_filter(pings, regions), regions)


def assign_zones(pings: DataFrame) -> DataFrame:
    """Add ``zone`` (Aarhus sub-zone) and drop pings in no zone."""
    return pings.where(geo.in_any_zone()).withColumn("zone", geo.zone_label())


def coverage_filter(pings: DataFrame, real_vessels_only: bool = True) -> DataFrame:
    """Coverage box (54-62 N, 7-17 E, compared in double) and optionally Class A/B only."""
    cond = geo.in_box_double(F.col("latitude"), F.col("longitude"), config.COVERAGE_BOX)
    if real_vessels_only:
        cond = cond & vessel.is_real_vessel(F.col("mobile_type"))
    return pings.where(cond)


# ---------------------------------------------------------------------------
# Points-in-regions as a join (table-driven regions, any number of them)
# ---------------------------------------------------------------------------
#: Width in degrees of a cell of level 0, and the levels: each halves it, to some 0.0005 degrees; negative ones double it. Only
#: every ``STEP``-th level is used: fewer levels are fewer probes of a ping, for cells of up to 2^STEP times a box's side.
WIDEST, DEEPEST, HIGHEST, STEP = 512.0, 20, -10, 2
#: Coordinates beyond this count as this when cells are numbered (infinite bounds of a box).
FARTHEST = 2e5
#: Rows up to which a table is broadcast, some MB. They are counted: Spark estimates a table from the compressed files that it
#: comes from, and takes the rows that ``inline`` adds for none.
SMALL = 20_000


def regions_frame(spark: SparkSession, regions: Mapping[str, geo.Box] = config.PORTS) -> DataFrame:
    """Region dimension: one row per region with float32 bounds and its order."""
    rows = [(i, name, *box) for i, (name, box) in enumerate(regions.items())]
    schema = T.StructType([
        T.StructField("region_order", T.IntegerType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("lat_min", T.DoubleType(), False),
        T.StructField("lat_max", T.DoubleType(), False),
        T.StructField("lon_min", T.DoubleType(), False),
        T.StructField("lon_max", T.DoubleType(), False),
    ])
    df = spark.createDataFrame(rows, schema)
    return df.select("region_order", "region",
                     *[F.col(c).cast("float").alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")])


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """With the hint by which a join broadcasts this table if it has few rows, and no table else."""
    return df.hint("broadcast" if rows <= SMALL else "merge")


def _level(low: str, high: str):
    """How often the widest cell is halved and still as wide as the side: the side then touches two cells at most."""
    side = (F.col(high).cast("double") - F.col(low).cast("double"))
    fitting = F.floor(F.floor(F.log2(F.lit(WIDEST) / side)) / STEP) * STEP
    return F.when(side <= WIDEST / 2 ** DEEPEST, DEEPEST).otherwise(F.greatest(F.lit(HIGHEST), fitting)).cast("int")


def _cell(c, level):
    """Number of the cell of a coordinate; the division is by a power of 2, so it is exact and keeps the order."""
    c = F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), c.cast("double")))
    return F.floor(c * F.pow(F.lit(2.0), level) / F.lit(WIDEST)).cast("long")


def _levelled(regions: DataFrame) -> DataFrame:
    """Regions with an inside, and the level of their cells along each axis."""
    real = regions.where("lat_min <= lat_max AND lon_min <= lon_max AND NOT isnan(lat_max) AND NOT isnan(lon_max)")
    return real.withColumn("level_lat", _level("lat_min", "lat_max")).withColumn("level_lon", _level("lon_min", "lon_max"))


def region_cells(regions: DataFrame) -> DataFrame:
    """The cells of each region, at most four: each axis has a level of its own, by the length of the box along it.

    Adds level_lat, level_lon, cell_lat and cell_lon. Boxes without inside (a bound missing or not a number, or crossed) have no cells.
    """
    placed = _levelled(regions)
    for axis in ("lat", "lon"):
        level = F.col(f"level_{axis}")
        first, last = _cell(F.col(f"{axis}_min"), level), _cell(F.col(f"{axis}_max"), level)
        placed = placed.withColumn(f"cell_{axis}", F.explode(F.sequence(first, last)))
    return placed


def region_join(pings: DataFrame, regions: DataFrame) -> DataFrame:
    """All (ping, region) pairs whose box contains the ping, for boxes of any sizes and any number of them.

    A theta join would be a nested loop over pings x regions. Instead a region is a few cells of a hierarchy of grids, of
    about its own size along each axis, and a ping probes its one cell on each pair of levels that some region is on: an
    equi-join on (levels, cells) plus the exact float32 box test. The pairs of levels, at most ((DEEPEST - HIGHEST) / STEP + 1)^2 and as
    a rule a handful, are read from the region table beforehand, with their counts. The cells are broadcast if they are few; else
    both sides are shuffled on the cell, with skewed cells split at run time. The pings are never broadcast.
    """
    counts = {(r.level_lat, r.level_lon): r["count"] for r in _levelled(regions).groupBy("level_lat", "level_lon").count().collect()}
    cells, levels = _sized(region_cells(regions), 4 * sum(counts.values())), sorted(counts)
    probes = F.array(*[F.struct(F.lit(a).alias("level_lat"), F.lit(b).alias("level_lon"), _cell(F.col("latitude"), F.lit(a)).alias("cell_lat"),
                                _cell(F.col("longitude"), F.lit(b)).alias("cell_lon")) for a, b in levels])
    if not levels:
        probes = F.lit(None).cast("array<struct<level_lat:int,level_lon:int,cell_lat:bigint,cell_lon:bigint>>")
    key = ["level_lat", "level_lon", "cell_lat", "cell_lon"]
    p = pings.where("latitude IS NOT NULL AND longitude IS NOT NULL").select("*", F.inline(probes))
    joined = p.join(cells, key, "inner").where(
        F.col("latitude").between(F.col("lat_min"), F.col("lat_max"))
        & F.col("longitude").between(F.col("lon_min"), F.col("lon_max")))
    return joined.drop(*key, "lat_min", "lat_max", "lon_min", "lon_max")


#: Degrees of a tile of level 0, how often a side is halved from a level to the next, and the deepest level (1/2048 degree).
COARSE, HALVINGS, LAST = 16.0, 3, 5
#: Pings up to which a tile is not split. Vessels of a tile and bucket from which a bitmap stands for them.
LEAF, DENSE = 64, 32
#: Bitmaps (4 KB each) up to which they are broadcast.
FEW_BITS = 16_000
AXES = (("lat", "latitude"), ("lon", "longitude"))
COUNTS = ["pings", "first_event", "last_event"]


def _near(c):
    """A coordinate that is not missing, not beyond ``FARTHEST``."""
    return F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), c.cast("double")))


def _points(pings: DataFrame) -> DataFrame:
    """Pings with a position, counted by position and vessel, and the deepest tile of each."""
    real = pings.where("latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)")
    points = real.groupBy("latitude", "longitude", "mmsi").agg(
        F.count(F.lit(1)).alias("pings"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))
    return points.withColumns({f"fine_{a}": F.floor(_near(F.col(c)) * (2.0 ** (HALVINGS * LAST) / COARSE)) for a, c in AXES})


def region_counts(pings: DataFrame, regions: DataFrame) -> DataFrame:
    """region, pings, vessels (mmsi; none is one of them), first_event and last_event of all regions with pings; regions can be repeated.

    What ``region_join`` followed by a count gives, without a row for each ping and region: pings are counted by tiles of
    several levels, and a box takes the tiles that lie in it (by the bounds of the pings there) as a whole. Only tiles that
    its border crosses are split, down to ``LEAF`` pings or the deepest level; the pings of those that are left are joined.
    Tiles of a level have no position in common and none is taken with one above it, so a ping is counted once. The vessels
    of a tile are bitmaps by buckets of numbers, or rows where they are few. Tables are broadcast only if their counted rows are few.
    """
    tile, box = ["level", "tile_lat", "tile_lon"], [f"box_{a}_{e}" for a, _ in AXES for e in ("min", "max")]
    summed = [F.sum("pings").alias("pings"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event")]
    spark = pings.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # given by number, they are not merged by bytes: a few of these rows make many
    points = _points(pings.repartition("event_id")).checkpoint()  # dealt out so that one large file is not one task
    placed = points.select("*", F.inline(F.array(*[F.struct(F.lit(k).alias("level"), *[
        F.shiftright(f"fine_{a}", HALVINGS * (LAST - k)).alias(f"tile_{a}") for a, _ in AXES]) for k in range(LAST + 1)])))
    nodes = placed.groupBy(*tile).agg(*summed, *[f(c).alias(f"{end}_{c}") for _, c in AXES for end, f in (("least", F.min), ("most", F.max))])
    several = " OR ".join(f"least_{c} < most_{c}" for _, c in AXES)
    nodes = nodes.withColumn("open", F.expr(f"level < {LAST} AND pings > {LEAF} AND ({several})")).checkpoint()
    levels = {r.level: r for r in nodes.groupBy("level").agg(F.count(F.lit(1)).alias("rows"), F.max("open").alias("open")).collect()}

    def meeting(pairs: DataFrame) -> DataFrame:
        """The pairs of a box and a tile that have a place in common, as far as the bounds of the tile's pings tell."""
        inside = " AND ".join(f"least_{c} >= box_{a}_min AND most_{c} <= box_{a}_max" for a, c in AXES)
        return pairs.where(" AND ".join(f"most_{c} >= box_{a}_min AND least_{c} <= box_{a}_max" for a, c in AXES)).select(
            "region", *box, *tile, *COUNTS, "open", F.expr(inside).alias("inside"))

    # a tile of level 0 that meets a box has its least corner in the box or less than a side below it
    real = regions.where("lat_min <= lat_max AND lon_min <= lon_max AND NOT isnan(lat_max) AND NOT isnan(lon_max)")
    wider = real.select("region", *[F.col(f"{a}_{e}").alias(f"box_{a}_{e}") for a, _ in AXES for e in ("min", "max")], *[
        (_near(F.col(f"{a}_{e}")) - wide).cast("float").alias(f"{a}_{e}") for a, _ in AXES for e, wide in (("min", 2 * COARSE), ("max", 0.0))])
    corners = nodes.where("level = 0").withColumns({c: _near(F.col(f"least_{c}")).cast("float") for _, c in AXES})
    met = meeting(region_join(corners, wider)).repartition(min(parts, spark.sparkContext.defaultParallelism), "region").checkpoint()
    ends = met.where("inside OR NOT open")
    for k in range(1, LAST + 1):
        if k not in levels or not levels[k - 1].open:
            break
        above = [F.shiftright(f"tile_{a}", HALVINGS).alias(f"above_{a}") for a, _ in AXES]
        split = met.where("open AND NOT inside").select("region", *box, *[F.col(f"tile_{a}").alias(f"above_{a}") for a, _ in AXES])
        below = _sized(nodes.where(F.col("level") == k).select("*", *above), levels[k].rows)
        met = meeting(split.join(below, ["above_lat", "above_lon"])).checkpoint()
        ends = ends.unionByName(met.where("inside OR NOT open"))
    whole, crossing = ends.where("inside").select("region", *tile, *COUNTS), ends.where("NOT inside").select("region", *box, *tile)

    wanted = ends.groupBy(*tile).agg(F.max("inside").alias("whole"), F.max(~F.col("inside")).alias("crossed")).checkpoint()
    placed = placed.join(_sized(wanted, wanted.count()), tile)
    crossed = placed.where("crossed").join(crossing.hint("merge"), tile).where(" AND ".join(f"{c} BETWEEN box_{a}_min AND box_{a}_max" for a, c in AXES))
    crossed = crossed.groupBy("region", "mmsi").agg(*summed).checkpoint()

    vessels = placed.where("whole").select(*tile, "mmsi", F.expr("bitmap_bucket_number(mmsi) AS bucket")).distinct()
    buckets = (vessels.groupBy(*tile, "bucket").agg(F.count(F.lit(1)).alias("n"), F.expr("bitmap_construct_agg(bitmap_bit_position(mmsi)) AS bits"))
               .where(F.col("n") >= DENSE).checkpoint())
    many, keys = buckets.count(), buckets.drop("bits", "n")
    # dealt out and sorted while rows are short, so that no bitmap is: a hash join keeps the order; Spark drops a sort before a join, but not this id
    deal, hint = (["region", "bucket"], "broadcast") if many <= FEW_BITS else ([*tile, "bucket"], "shuffle_hash")
    asked = whole.select("region", *tile).join(_sized(keys, many), tile).repartition(parts, *deal).sortWithinPartitions("region", "bucket")
    asked = asked.withColumn("at", F.monotonically_increasing_id()).where("at >= 0")
    dense = asked.join(buckets.hint(hint), [*tile, "bucket"]).groupBy("region", "bucket").agg(F.expr("bitmap_or_agg(bits) AS bits"))
    few = vessels.join(_sized(keys, many), [*tile, "bucket"], "left_anti")
    few = whole.select("region", *tile).repartition(parts, *tile).join(few.hint("merge"), tile).select("region", "mmsi")
    rest = few.unionByName(crossed.select("region", "mmsi")).distinct().withColumn("bucket", F.expr("bitmap_bucket_number(mmsi)"))
    rest = rest.groupBy("region", "bucket").agg(F.expr("bitmap_construct_agg(bitmap_bit_position(mmsi)) AS bits"))
    found = dense.unionByName(rest).groupBy("region", "bucket").agg(F.expr("bitmap_count(bitmap_or_agg(bits))").alias("n"))
    found = found.select("region", F.when(F.col("bucket").isNull(), F.lit(1)).otherwise(F.col("n")).cast("long").alias("vessels"))
    totals = whole.select("region", *COUNTS).unionByName(crossed.select("region", *COUNTS)).withColumn("vessels", F.lit(0).cast("long"))
    return (totals.unionByName(found, allowMissingColumns=True).groupBy("region").agg(*summed, F.sum("vessels").alias("vessels"))
            .select("region", "pings", "vessels", "first_event", "last_event"))
