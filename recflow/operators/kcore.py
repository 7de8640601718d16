"""k-core of the rating graph: the cold-start filter repeated until no row falls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.session import release, scratch_path


def k_core(ratings: DataFrame, min_item: int = 5, min_user: int = 10) -> DataFrame:
    """The largest set of rows in which every item has >= ``min_item`` rows and every
    user >= ``min_user``. It does not depend on the order of removal.

    Rows are first counted by (user, item). After that a round reads only the rows of
    keys that fell in the round before, and subtracts them from the counts of the other
    side, so rows that stay are never counted again. The counts carry the round in which
    their key fell (``gone``) and are written once a round, which cuts the lineage; the
    driver reads the number of newly fallen keys, nothing else. Empty input gives an
    empty result; rows with a null user or item are dropped, repeated rows count each."""
    spark = ratings.sparkSession
    least = {"item_id": min_item, "user_id": min_user}

    def save(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    known = ratings.where("user_id IS NOT NULL AND item_id IS NOT NULL")
    edges, edges_path = save(known.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n")),
                             "kcore-edges")
    state, paths = {}, {}
    for key, low in least.items():
        counts = edges.groupBy(key).agg(F.sum("n").alias("n"))
        state[key], paths[key] = save(counts.withColumn("gone", F.when(F.col("n") < low, 0)), "kcore-keys")

    round_no = 0
    while _fell(state, round_no):
        fresh = {k: s.where(F.col("gone") == round_no).select(k) for k, s in state.items()}
        before = {k: s.where(F.col("gone") < round_no).select(k) for k, s in state.items()}
        by_item = edges.join(fresh["item_id"], "item_id", "left_semi")
        by_user = (edges.join(fresh["user_id"], "user_id", "left_semi")
                   .join(fresh["item_id"], "item_id", "left_anti"))
        lost = by_item.unionByName(by_user)
        for key in least:
            lost = lost.join(before[key], key, "left_anti")
        lost, lost_path = save(lost, "kcore-lost")
        old = [lost_path]
        for key, low in least.items():
            less = lost.groupBy(key).agg(F.sum("n").alias("_lost"))
            left = F.col("n") - F.coalesce("_lost", F.lit(0))
            fallen = F.when(left < low, F.lit(round_no + 1))
            old.append(paths[key])
            state[key], paths[key] = save(
                state[key].join(less, key, "left").select(key, left.alias("n"), F.coalesce("gone", fallen)
                                                          .alias("gone")), "kcore-keys")
        release(spark, old)
        round_no += 1
    release(spark, [edges_path])
    for key in least:
        known = known.join(state[key].where("gone IS NULL").select(key), key, "left_semi")
    return known.select(*ratings.columns)


def _fell(state: dict[str, DataFrame], round_no: int) -> bool:
    return any(not s.where(F.col("gone") == round_no).isEmpty() for s in state.values())
