"""What every operator shares: lineage cuts, size-checked broadcasts, hot keys, distributed prefix sums."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A side is broadcast only when it was counted and has no more rows than this.
BROADCAST_ROWS = 200_000
#: A key is hot when it holds more than one in HOT_SHARE rows, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 1_000
HOT_LEAST = 50_000


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """A table of a data directory; a table is one Parquet file or a folder of them."""
    return spark.read.parquet(f"{directory}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; where that is unset and Spark runs in one process
    (tests), a temporary one. A cluster without the setting is an error, as its executors share no temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="scholarmesh-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


#: Files of this process's intermediate tables.
_kept: set[str] = set()


def _keep(df: DataFrame, path: str) -> DataFrame:
    df._kept_as = path
    _kept.add(path)
    return df


def cut(df: DataFrame) -> DataFrame:
    """Computes df now and keeps it in the shared folder, so that later steps neither recompute it nor lose it."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    file = out._jdf.logicalPlan().rdd().getCheckpointFile()
    return _keep(out, file.get()) if file.isDefined() else out


def stored(df: DataFrame) -> DataFrame:
    """As cut(), but as a compressed Parquet table, for rows that are wide or many."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/scholarmesh/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return _keep(spark.read.schema(df.schema).parquet(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def remove(*tables: DataFrame) -> None:
    """Deletes the files of tables made by cut() or stored(), once nothing reads them any more; others are left alone."""
    for df in tables:
        if path := getattr(df, "_kept_as", None):
            _delete(df.sparkSession, path)
            _kept.discard(path)


def clear(spark: SparkSession) -> int:
    """Deletes all intermediate tables of this process that are left, once its results are written; says how many."""
    n = len(_kept)
    for path in sorted(_kept):
        _delete(spark, path)
    _kept.clear()
    return n


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted size allows one, else as it is: the join then shuffles."""
    return F.broadcast(df) if is_small(df, rows) else df


def hot_limit(rows: int, least: int = HOT_LEAST, share: int = HOT_SHARE) -> int:
    """Rows above which a key is hot; at most `share` keys can be."""
    return max(least, rows // share)


def join_hot(left: DataFrame, right: DataFrame, key: str, sizes: DataFrame, limit: int) -> DataFrame:
    """Inner join to a right side with one row per key, where few keys may hold most of the left rows.

    sizes: (key, n), the left rows of each key. Keys with more than `limit` rows, of which there are at most
    rows/limit, are joined by broadcast where their rows lie; the others are shuffled.
    """
    hot = sizes.filter(F.col("n") > limit).select(key)
    hot_right = F.broadcast(right.join(F.broadcast(hot), key, "left_semi"))
    cold_left = left.join(F.broadcast(hot), key, "left_anti")
    return left.join(hot_right, key).unionByName(cold_left.join(right, key))


def running(df: DataFrame, group: list[str], order: list[Column], value: Column, name: str = "before", partitions: int | None = None) -> DataFrame:
    """Adds the sum of `value` over the rows of the group that come earlier in `order` (which must be total).

    No group is gathered in one task: rows are range-partitioned by (group, order), each partition sums its own
    part of a group, and only one total per (partition, group) is carried over. df is stored once in between.
    """
    spark = df.sparkSession
    n = partitions or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df = df.withColumn("_value", value)
    parts = stored(df.repartitionByRange(n, *[F.col(c) for c in group], *order).withColumn("_pid", F.spark_partition_id()))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_pid", *group).agg(F.sum("_value").alias("_sum"))
    offsets = totals.select("_pid", *group, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = parts.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    on = local["_pid"].eqNullSafe(offsets["_pid"])
    for c in group:
        on = on & local[c].eqNullSafe(offsets[c])
    columns = [local[c] for c in df.columns if c != "_value"]
    return local.join(offsets, on).select(*columns, (local["_local"] + offsets["_offset"]).alias(name))
