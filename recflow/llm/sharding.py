"""Uniform shuffle into shards of exact sizes by a communication matrix.

Rows lie in logical partitions (a hash of their key). Given the partition counts and
the exact sizes of all blocks (every shard is cut into equally many blocks), the
number of rows that a partition sends to each block follows the multivariate
hypergeometric law. The matrix of these numbers is drawn exactly, partition by
partition. Rows are permuted inside their partition, cut into runs by the matrix,
exchanged, and permuted again inside their block. Block offsets are known
beforehand, so slots are gapless without a second count, and no task ever holds a
whole shard.

All of this is done on narrow rows (row number, two hashes of the key columns, copy
number). The whole rows are written once with their number and their hashes, and
are shuffled once, to their slots. Partitions and permutations follow seeded
hashes, so rows equal in all key columns (all columns by default) would go together:
they get a copy number first. Copies are numbered from 0 by the tasks that wrote
them (counts by task, summed up, and a row number inside the task); they are
interchangeable, so reruns agree.

Partitions and blocks follow the number of rows: about ``TASK_ROWS`` narrow rows
each, at least ``PARTITIONS`` and ``BLOCKS_PER_SHARD``, and at most ``MOST``
partitions and blocks, beyond which tasks grow and sort on disk. The driver holds
the counts and the matrix only, at most MOST x MOST numbers (32 MB, broadcast),
whatever the size of the data.

Defined results: nulls are hashed like values; an empty table gives no rows;
fewer rows than shards leave some shards empty; repeated rows are rows of
their own and part like any others; a very long text only moves with its row;
equal keys of different rows (``key_cols``) are told apart by their copy number, in
the order in which they were written; extra columns are kept, and an input column
named ``shard`` or ``slot`` is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.llm.common import fresh, stored, table

SHARDS = 40
PARTITIONS = 256
BLOCKS_PER_SHARD = 8
TASK_ROWS = 1 << 20
MOST = 2048


def exact_sizes(n: int, parts: int) -> list[int]:
    """Sizes at most one apart that sum to n."""
    return [n // parts + (i < n % parts) for i in range(parts)]


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """One row per partition: how many of its rows go to each block, uniformly
    among all assignments with these row and column sums."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(sizes, dtype=np.int64)
    out = np.zeros((len(counts), len(sizes)), dtype=np.int64)
    for i, c in enumerate(counts):
        out[i] = rng.multivariate_hypergeometric(left, c, method="marginals") if c else 0
        left -= out[i]
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """(rid, h1, h2, copy) from (rid, h1, h2): a number from 0 for rows of equal hashes."""
    same = ["h1", "h2", "task"]
    rows = rows.withColumn("task", F.shiftright("rid", 33))
    upto = Window.partitionBy("h1", "h2").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).select(
        *same, F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")).where("before > 0"),
        "shard-copies")
    inside = Window.partitionBy(*same).orderBy("rid")
    return rows.join(before, same, "left").select(
        "rid", "h1", "h2", (F.coalesce("before", F.lit(0)) + F.row_number().over(inside) - 1).alias("copy"))


def places(rows: DataFrame, n: int, shards: int, partitions: int, blocks_per_shard: int,
           seed: int) -> DataFrame:
    """(rid, shard, slot) of the ``n`` narrow rows (rid, h1, h2)."""
    spark = rows.sparkSession
    key = ["h1", "h2", "copy"]

    def hashed(k: int):
        return F.xxhash64(F.lit(seed + k), *key)

    tagged = stored(_numbered(rows).select(
        "rid", F.pmod(hashed(0), F.lit(partitions)).cast("int").alias("part"),
        hashed(1).alias("order1"), hashed(2).alias("order2"), hashed(3).alias("tie")), "shard-tagged")
    counts = dict(tagged.groupBy("part").count().collect())  # at most ``partitions`` rows
    per_part = [counts.get(i, 0) for i in range(partitions)]
    shard_sizes = exact_sizes(n, shards)
    block_sizes = [b for s in shard_sizes for b in exact_sizes(s, blocks_per_shard)]
    starts = [sum(exact_sizes(s, blocks_per_shard)[:i])
              for s in shard_sizes for i in range(blocks_per_shard)]
    matrix = communication_matrix(per_part, block_sizes, seed)
    ends = spark.createDataFrame(pa.table({"part": pa.array(range(partitions), pa.int32()),
                                           "cuts": pa.array(list(matrix.cumsum(axis=1)),
                                                            pa.list_(pa.int64()))}))
    offsets = spark.createDataFrame(list(enumerate(starts)), "block int, begin bigint")
    # permute inside the partition, cut into runs
    local = Window.partitionBy("part").orderBy("order1", "tie")
    sent = (tagged.withColumn("run", F.row_number().over(local)).join(F.broadcast(ends), "part")
            .withColumn("block", F.size(F.filter("cuts", lambda c: c < F.col("run"))))
            .select("rid", "block", "order2", "tie"))
    # exchange, permute inside the block
    inside = Window.partitionBy("block").orderBy("order2", "tie")
    return (sent.withColumn("run", F.row_number().over(inside)).join(F.broadcast(offsets), "block")
            .select("rid", F.floor(F.col("block") / F.lit(blocks_per_shard)).cast("int").alias("shard"),
                    (F.col("begin") + F.col("run") - 1).cast("bigint").alias("slot")))


def shard_rows(df: DataFrame, shards: int = SHARDS, key_cols: list[str] | None = None,
               partitions: int | None = None, blocks_per_shard: int | None = None,
               seed: int = 7) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0)."""
    df = df.drop("shard", "slot")
    keys = [F.col(f"`{c}`") for c in (key_cols or df.columns)]
    rid, h1, h2 = fresh(df, "rid", "h1", "h2")
    rows = stored(df.withColumns({h1: F.xxhash64(*keys), h2: F.xxhash64(F.lit(seed), *keys),
                                  rid: F.monotonically_increasing_id()}), "shard-rows")
    n = rows.count()  # from the files' footers
    partitions = partitions or min(MOST, max(PARTITIONS, -(-n // TASK_ROWS)))
    blocks_per_shard = blocks_per_shard or min(max(MOST // shards, 1),
                                               max(BLOCKS_PER_SHARD, -(-n // (shards * TASK_ROWS))))
    placed = places(rows.select(F.col(rid).alias("rid"), F.col(h1).alias("h1"), F.col(h2).alias("h2")),
                    n, shards, partitions, blocks_per_shard, seed).withColumnRenamed("rid", rid)
    return rows.drop(h1, h2).join(placed, rid).drop(rid)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + F.lit(16)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
