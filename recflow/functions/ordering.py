"""Global ordering helpers that never put all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_row_number(df: DataFrame, order_cols: list, name: str = "pos",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the total order ``order_cols``.

    Range-partition on the order (balanced by sampling), sort inside each
    partition, number rows inside the partition, and add the row count of
    all earlier partitions. Only the per-partition counts (one row per
    partition, a proven bound) meet in one place; ``order_cols`` must be
    a total order.

    Range bounds come from a sample, and the counts and the positions are
    two branches of the plan. The tagged rows are therefore written once to
    the shared folder, so both branches see the same partition ids however
    often a stage is recomputed.
    """
    ranged = tag_range_partitions(df, order_cols, num_partitions)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + local + F.lit(1)).cast("bigint"))
            .drop("_pid", "_mid", "_off"))


def tag_range_partitions(df: DataFrame, order_cols: list,
                         num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted on ``order_cols`` with their
    partition id (_pid) and a per-partition increasing id (_mid), written
    once to the shared folder."""
    from recflow.session import materialize
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    return materialize(ranged, "ranged")


def keyed_row_number(df: DataFrame, keys: list, order_cols: list,
                     name: str = "pos") -> DataFrame:
    """Position within each combination of ``keys`` (few groups, e.g. rounds),
    computed from one global numbering plus the first position per key."""
    if not keys:
        return global_row_number(df, order_cols, name)
    numbered = global_row_number(df, [*keys, *order_cols], "_gpos")
    starts = numbered.groupBy(*keys).agg(F.min("_gpos").alias("_start"))
    return (numbered.join(starts, list(keys))
            .withColumn(name, (F.col("_gpos") - F.col("_start") + F.lit(1)).cast("bigint"))
            .drop("_gpos", "_start"))
