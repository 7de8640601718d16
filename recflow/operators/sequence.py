"""Per-key ordered sequences that stay balanced when one key holds a large
share of all rows. One plan at every size.

Numbering: rows are range-partitioned on (key, order), so a large key is cut
across partitions; the partition id is written with the rows. A row's number
is its position inside its (key, partition) plus the rows of the key in
earlier partitions. No window holds more than one range partition.

Frames: once rows are numbered, a sliding frame of the last K rows runs in
blocks of ``block_rows`` consecutive numbers; a block also receives the K rows
before it. A key with fewer rows is simply one block."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.columns import EVENT_ORDER
from recflow.session import materialize

BLOCK_ROWS = 65_536


def numbered(df: DataFrame, keys: list, order=EVENT_ORDER,
             num_partitions: int | None = None) -> DataFrame:
    """Adds rn (1-based position in ``order`` within the key) and n (rows
    of the key)."""
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(parts, *keys, *order)
                         .withColumn("_pid", F.spark_partition_id()), "sequence")
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per key and partition: at most keys + partitions rows
    offsets = ranged.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_c")).select(
        *keys, "_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
        F.sum("_c").over(per_key).alias("n"))
    local = F.row_number().over(Window.partitionBy(*keys, "_pid").orderBy(*order))
    return (ranged.withColumn("_pos", local).join(offsets, [*keys, "_pid"])
            .select(*df.columns, (F.col("_off") + F.col("_pos")).cast("bigint").alias("rn"),
                    F.col("n").cast("bigint").alias("n")))


def blocked_frame(rows: DataFrame, keys: list, value, size: int, name: str,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds the array ``name`` of ``value`` over the last ``size`` rows by rn
    (the current one included)."""
    halo = size - 1
    block = max(block_rows, size)
    own = F.floor((F.col("rn") - 1) / F.lit(block)).cast("bigint")
    last = F.pmod(F.col("rn") - 1, F.lit(block)) >= F.lit(block - halo)
    copies = F.when(last, F.array(F.struct(own.alias("_b"), F.lit(False).alias("_h")),
                                  F.struct((own + 1).alias("_b"), F.lit(True).alias("_h")))) \
        .otherwise(F.array(F.struct(own.alias("_b"), F.lit(False).alias("_h"))))
    w = Window.partitionBy(*keys, "_b").orderBy("rn").rowsBetween(-halo, 0)
    return (rows.select("*", F.inline(copies)).withColumn(name, F.collect_list(value).over(w))
            .filter(~F.col("_h")).drop("_b", "_h"))
