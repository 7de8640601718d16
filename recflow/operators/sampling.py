"""Samples of an exact size in a reproducible random order, without ordering all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.columns import md5_key

# hexadecimal digits that one histogram looks at: at most 65,536 buckets
DIGITS = 4
MD5_DIGITS = 32
# rows of the cut bucket that are ordered by their whole hash
ORDERED_ROWS = 10_000


def hash_sample(df: DataFrame, n: int, keys, seed: int, ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """The first ``n`` rows in md5(keys:seed) order, ties by ``keys``; all rows if fewer.

    Hashes are counted by their first digits and the bucket that holds the n-th row is
    found; while it has more than ``ordered_rows`` rows, it is counted by its next
    digits. Rows in front of the cut are taken by a filter, and only the cut bucket is
    ordered. A count returns one row to the driver. Rows that agree in all keys share
    one hash: any of them may be the last one taken. A null key counts as absent."""
    if n <= 0:
        return df.limit(0)
    keys = list(keys)
    rows = df.withColumn("_h", md5_key(*keys, F.lit(seed)))
    prefix, need, size = "", n, None
    while len(prefix) < MD5_DIGITS and (size is None or size > ordered_rows):
        cut = _cut(rows.where(F.col("_h").startswith(prefix)), len(prefix), need)
        if cut is None:
            return df
        prefix, need, size = prefix + cut["digits"], need - cut["before"], cut["size"]
    front = rows.where(F.substring("_h", 1, len(prefix)) < prefix)
    edge = rows.where(F.col("_h").startswith(prefix))
    if size <= ordered_rows:
        edge = edge.orderBy("_h", *keys)
    return front.unionByName(edge.limit(need)).drop("_h")


def _cut(rows: DataFrame, start: int, need: int):
    """The bucket of the next digits that holds row ``need``, its size, and the rows
    before it; None where there are fewer rows."""
    counts = rows.groupBy(F.substring("_h", start + 1, DIGITS).alias("digits")).agg(
        F.count(F.lit(1)).alias("size"))
    # at most 16^DIGITS rows
    upto = F.sum("size").over(Window.orderBy("digits"))
    return (counts.withColumn("before", upto - F.col("size"))
            .where((F.col("before") < need) & (F.col("before") + F.col("size") >= need)).first())
