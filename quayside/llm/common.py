"""Small helpers shared by the operators: table access and lineage cuts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import ensure_checkpoint_dir, scratch_path

#: A word, as every contract of this subpackage defines it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings of these operators: Arrow batches of a size that a Python worker holds several times."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read with Spark's own reader so that any store it knows will do."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: a reliable checkpoint in the shared folder.

    The folder is ``spark.checkpoint.dir`` of the session. A lost executor only costs the tasks that were
    running on it, since the files are on shared storage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spool(df: DataFrame, name: str) -> DataFrame:
    """``cut`` for larger tables that are read several times: written as Parquet, so columns are packed and pruned.

    The files are under ``spark.checkpoint.dir`` and stay there, as the result may be read at any later time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered(df: DataFrame, by: list[str], order: list[Column], out_col: str, keep: list[Column]) -> DataFrame:
    """``by``, columns ``keep``, and the place (from 0) of each row among those of equal ``by``, in some order.

    One global range sort by ``by`` and ``order`` numbers the rows of each partition; a group that spans partitions gets
    the sizes of its earlier pieces added, so no group has to fit in one task. Rows equal in all of this count by their place
    in the input. ``by`` has no nulls.
    """
    placed = df.withColumn("_in", F.monotonically_increasing_id())
    keys = [*map(F.col, by), *order, F.col("_in")]
    s = cut(placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .select(*by, *keep, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    pieces = s.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn("_shift", F.coalesce(earlier, F.lit(0)) - F.col("_first")).drop("_first", "_n")
    return s.join(pieces, [*by, "_part"]).withColumn(out_col, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
