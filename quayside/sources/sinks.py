"""Output sinks: the ten tables as Parquet (S7), loading them as views (S8), the JSON
payload export (S9) and the table catalogue (S10)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.tables import TABLE_ATTRS, Tables, published


def write_outputs(t: Tables, root: str) -> dict[str, str]:
    """Write every fact table in its published form, one Parquet folder per table."""
    paths = {}
    for table in TABLE_ATTRS:
        path = f"{root.rstrip('/')}/{table}"
        published(t.table(table), table).write.mode("overwrite").parquet(path)
        paths[table] = path
    return paths


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def load_tables(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Register each written table as a temp view, replacing an existing one; a table
    that was never written is skipped (S8). Returns the loaded view names."""
    loaded = []
    for table in TABLE_ATTRS:
        path = f"{root.rstrip('/')}/{table}"
        if not _exists(spark, path):
            continue
        spark.read.parquet(path).createOrReplaceTempView(prefix + table)
        loaded.append(prefix + table)
    return loaded


def table_overview(spark: SparkSession, views: list[str]) -> DataFrame:
    """Row count and column list of every table (S10): one small count job per table,
    unioned into one frame."""
    frames = []
    for v in views:
        df = spark.table(v)
        frames.append(df.agg(F.count(F.lit(1)).alias("rows"))
                      .select(F.lit(v).alias("table"), "rows", F.lit(", ".join(df.columns)).alias("columns")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _comparator(order: list[tuple[str, bool]]):
    """array_sort comparator for an ORDER BY list of (column, ascending)."""
    def cmp(left, right):
        out = F.lit(0)
        for col, asc in reversed(order):
            lo, hi = (-1, 1) if asc else (1, -1)
            a, b = left[col], right[col]
            out = (F.when(a.isNull() & b.isNotNull(), F.lit(lo)).when(a.isNotNull() & b.isNull(), F.lit(hi))
                   .when(a < b, F.lit(lo)).when(a > b, F.lit(hi)).otherwise(out))
        return out
    return cmp


def export_payload(sets: dict[str, DataFrame], meta: dict[str, str], path: str,
                   order: dict[str, list[tuple[str, bool]]] | None = None, extra: list[DataFrame] | None = None) -> None:
    """Write one compact JSON document holding every result set.

    The sets are KPI aggregates (bounded by ports x days x hours), so each is gathered
    with ``collect_list`` inside Spark and, when an ORDER BY is given for it, sorted in
    the array with a comparator (no global sort job); the document is assembled as one
    row and written as text by a single task. Nothing passes through the driver. Ties of an
    order go by the remaining columns; ``extra`` frames are one row each, whose columns
    become fields of the document."""
    order = order or {}
    spark = next(iter(sets.values())).sparkSession
    parts = [spark.range(1).select(F.lit(1).alias("_k"), *[F.lit(v).alias(k) for k, v in meta.items()])]
    parts += [df.withColumn("_k", F.lit(1)) for df in extra or []]
    for name, df in sets.items():
        arr = F.collect_list(F.struct(*df.columns))
        if name in order:
            by = [c for c, _ in order[name]]
            arr = F.array_sort(arr, _comparator(order[name] + [(c, True) for c in df.columns if c not in by]))
        parts.append(df.agg(arr.alias(name)).withColumn("_k", F.lit(1)))
    doc = parts[0]
    for p in parts[1:]:
        doc = doc.join(p, "_k", "left")        # every side is exactly one row (a global aggregate)
    doc = doc.drop("_k")
    doc.select(F.to_json(F.struct(*doc.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_payload_counts(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Read the document back and report each set's row count (round-trip check)."""
    doc = spark.read.json(path)
    frames = [doc.select(F.lit(n).alias("dataset"), F.size(F.col(n)).cast("long").alias("rows")) for n in names]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


__all__ = ["write_outputs", "load_tables", "table_overview", "export_payload", "read_payload_counts"]
