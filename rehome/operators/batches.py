"""WN1 assign_batches: ``[size*m : size*(m+1)]`` slices of an ordered list.

A window ``row_number() OVER (PARTITION BY k ORDER BY o)`` would put each
whole key into one task, and one key may hold a third of all rows.  Instead
the rows are range-partitioned on ``(k, o)`` (a hot key spans many tasks),
numbered inside each task, and each task's rows are offset by the counts of
the tasks before it for the same key.  The numbered rows (with their task
id and position) are written once as a table in the shared checkpoint
folder, so the counts and the numbering read the same materialized rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rehome.session import DEFAULT_BROADCAST_ROWS, bounded_broadcast, materialize


def row_index(df: DataFrame, partition_by: list[str], order_by: list[str],
              col: str = "row_index", num_partitions: int | None = None,
              broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """0-based position of each row inside its ``partition_by`` group,
    following ``order_by`` (which should be a total order within a group)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition_by) + list(order_by)
    numbered = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    numbered = materialize(numbered, "row-index")
    stats = (numbered.groupBy("_pid", *partition_by)
             .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(*partition_by).orderBy("_pid")
    stats = stats.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    stats = bounded_broadcast(stats.select(
        F.col("_pid").alias("_spid"), *[F.col(k).alias(f"_s_{k}") for k in partition_by],
        "_first", "_off"), broadcast_rows)
    cond = reduce(lambda a, b: a & b,
                  [numbered["_pid"] == stats["_spid"]]
                  + [numbered[k].eqNullSafe(stats[f"_s_{k}"]) for k in partition_by])
    out = numbered.join(stats, cond, "inner")
    idx = F.col("_off") + (F.col("_mid") - F.col("_first"))
    return out.withColumn(col, idx).drop(
        "_pid", "_mid", "_spid", "_first", "_off", *[f"_s_{k}" for k in partition_by])


def assign_batches(df: DataFrame, partition_by: list[str], order_by: list[str],
                   size: int = 100, col: str = "batch", **kw) -> DataFrame:
    """Batch number ``floor(position / size)`` inside each group."""
    if size <= 0:
        raise ValueError("size must be positive")
    out = row_index(df, partition_by, order_by, col="_row", **kw)
    return out.withColumn(col, F.floor(F.col("_row") / F.lit(size)).cast("long")).drop("_row")
