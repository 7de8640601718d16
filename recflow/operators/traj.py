"""(state, action, reward, next state) trajectories from per-user rating
sequences, and the reports and transforms built on them."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.columns import EVENT_ORDER, normalized_reward
from recflow.operators import sequence
from recflow.operators.sampling import hash_sample
from recflow.session import materialize

# packs are made in Python workers that need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def build_trajectories(ratings: DataFrame, state_size: int = 10, keys=(), carry=(),
                       block_rows: int = sequence.BLOCK_ROWS) -> DataFrame:
    """One row per rating that has K earlier ratings of the same user.

    state = the K previous (item, rating) pairs, action = current item,
    reward = current rating, next_state = the last K pairs including the
    current one: both are slices of one frame of K + 1 rows. Rows that
    already carry their number (rn, n) are not numbered again. A user of any
    size is cut into blocks, so no task holds a whole user. ``carry`` names
    extra per-rating columns kept inside the state structs (returned as
    ``state_<col>`` / ``next_state_<col>`` arrays).
    """
    K = state_size
    part = [*(keys or ()), "user_id"]
    if not {"rn", "n"} <= set(ratings.columns):
        ratings = sequence.numbered(ratings, part)
    step = F.struct("item_id", "rating", *carry)
    framed = sequence.blocked_frame(ratings, part, step, K + 1, "_steps", block_rows)
    state, following = F.slice("_steps", 1, K), F.slice("_steps", 2, K)
    columns = {
        "rn": F.col("rn"), "total_ratings": F.col("n"), "ts": F.col("ts"),
        "state_item_ids": state["item_id"], "state_ratings": state["rating"],
        "action_item_id": F.col("item_id"), "reward": F.col("rating"),
        "next_state_item_ids": following["item_id"], "next_state_ratings": following["rating"]}
    for c in carry:
        columns |= {f"state_{c}": state[c], f"action_{c}": F.col(c), f"next_state_{c}": following[c]}
    return framed.filter(F.col("rn") > K).select(*part, *[c.alias(n) for n, c in columns.items()])


def cap_history(ratings: DataFrame, max_len: int, keys=()) -> DataFrame:
    """Keep each user's last ``max_len`` ratings (the advice printed for very
    active users), before trajectories are built. A row_number <= L filter
    in reverse order: Spark keeps a partial top-L per task before the
    shuffle (window group limit), so a hot user is cut map-side."""
    k = list(keys or ())
    w = Window.partitionBy(*k, "user_id").orderBy(*[F.col(c).desc() for c in EVENT_ORDER])
    return (ratings.drop("rn", "n").withColumn("_rev", F.row_number().over(w))
            .filter(F.col("_rev") <= max_len).drop("_rev"))


def per_user_histogram(traj: DataFrame) -> DataFrame:
    """(user_id, reward, state_len, n): the one pass over trajectories that
    all quality figures are derived from, written once (partial aggregation
    map-side)."""
    return materialize(traj.groupBy("user_id", "reward", F.size("state_item_ids").alias("state_len"))
                       .agg(F.count(F.lit(1)).alias("n")), "traj-histogram")


def trajectory_quality(traj: DataFrame) -> DataFrame:
    """Long table (metric, bucket, value): reward describe and histogram,
    state length distribution, trajectories-per-user describe."""
    h = per_user_histogram(traj)
    by_reward = h.groupBy("reward").agg(F.sum("n").alias("n"))
    by_len = h.groupBy("state_len").agg(F.sum("n").alias("n"))
    per_user = h.groupBy("user_id").agg(F.sum("n").alias("n"))
    n = F.col("n").cast("double")
    r = F.col("reward")
    reward_desc = by_reward.agg(
        F.sum("n").cast("double").alias("count"),
        (F.sum(r * n) / F.sum(n)).alias("mean"),
        F.sqrt((F.sum(r * r * n) - F.sum(r * n) * F.sum(r * n) / F.sum(n))
               / (F.sum(n) - F.lit(1.0))).alias("std"),
        F.min(r).alias("min"), F.max(r).alias("max"))
    user_desc = per_user.agg(
        F.count(F.lit(1)).cast("double").alias("count"),
        F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"),
        F.min("n").cast("double").alias("min"), F.max("n").cast("double").alias("max"))

    def describe(df, prefix):
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(f"{prefix}_{s}").alias("metric"), F.lit("").alias("bucket"),
                     F.col(s).cast("double").alias("value"))
            for s in ("count", "mean", "std", "min", "max")])).alias("m")).select("m.*")

    hist = by_reward.select(F.lit("reward_hist").alias("metric"),
                            F.col("reward").cast("string").alias("bucket"),
                            F.col("n").cast("double").alias("value"))
    lens = by_len.select(F.lit("state_len").alias("metric"),
                         F.col("state_len").cast("string").alias("bucket"),
                         F.col("n").cast("double").alias("value"))
    return (describe(reward_desc, "reward").unionByName(hist).unionByName(lens)
            .unionByName(describe(user_desc, "rows_per_user")))


def trajectory_skew(traj: DataFrame, ratio: float = 5.0) -> DataFrame:
    """p99 and max of trajectories per user, their ratio and a skew flag
    (max > ratio x p99). The percentile runs on a value -> frequency map,
    so its memory is bounded by the number of distinct counts."""
    per_user = traj.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    agg = per_user.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY n)").cast("double").alias("p99"),
        F.max("n").alias("max_rows"))
    return agg.select(
        F.col("n_users").cast("bigint"), "p99", F.col("max_rows").cast("bigint"),
        (F.col("max_rows") / F.col("p99")).alias("max_over_p99"),
        (F.col("max_rows") > F.lit(ratio) * F.col("p99")).cast("int").alias("skewed"))


def prepare_trajectories(traj: DataFrame) -> DataFrame:
    """Normalised reward and state ratings, and a stable id user-rn. Output
    order and file count are the writer's job (``repartitionByRange`` +
    ``sortWithinPartitions`` at write time), not a global sort here."""
    norm = lambda x: (x - F.lit(0.5)) / F.lit(4.5)
    return traj.select(
        "*",
        normalized_reward(F.col("reward")).alias("reward_normalized"),
        F.transform("state_ratings", norm).alias("state_ratings_normalized"),
        F.transform("next_state_ratings", norm).alias("next_state_ratings_normalized"),
        F.concat_ws("-", F.col("user_id").cast("string"),
                    F.col("rn").cast("string")).alias("trajectory_id"))


# rows of one range that is sorted as rows, and rows of one pack of it
RANGE_ROWS, PACK_ROWS = 262_144, 1_024


def _pack(rows: int):
    def work(batches):
        for batch in batches:
            packs = []
            for at in range(0, batch.num_rows, rows):
                sink = pa.BufferOutputStream()
                with pa.CompressedOutputStream(sink, "zstd") as out, pa.ipc.new_stream(out, batch.schema) as to:
                    to.write_batch(batch.slice(at, rows))
                packs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(packs, pa.binary())], ["pack"])
    return work


def _unpack(batches):
    for batch in batches:
        for pack in batch.column("pack"):
            with pa.CompressedInputStream(pa.BufferReader(pack.as_buffer()), "zstd") as source:
                yield from pa.ipc.open_stream(source)


def ordered(traj: DataFrame, n_files: int, range_rows: int = RANGE_ROWS,
            pack_rows: int = PACK_ROWS) -> DataFrame:
    """``n_files`` range partitions on (user_id, rn), each in that order.

    A file's task must not sort its share of all rows, which grows with the input and holds
    every rating in about 2 K states. So rows are sorted in small ranges (about
    ``range_rows`` each, however many there are) and leave them in packs of consecutive
    rows, compressed whole: neighbouring states repeat each other. The packs are numbered in
    order and written once; what a file's task sorts by number is its packs, and it unpacks
    them one at a time."""
    n = max(4 * n_files, -(-traj.count() // range_rows))
    packs = (traj.repartitionByRange(n, "user_id", "rn").sortWithinPartitions("user_id", "rn")
             .mapInArrow(_pack(pack_rows), "pack binary")
             .withColumn("_at", F.monotonically_increasing_id()))
    return (materialize(packs, "packs").repartitionByRange(n_files, "_at").sortWithinPartitions("_at")
            .mapInArrow(_unpack, traj.schema))


def write_trajectories(traj: DataFrame, path: str, n_files: int) -> None:
    """Ordered output: range partitions on (user_id, rn), sorted inside."""
    ordered(traj, n_files).write.mode("overwrite").parquet(path)


def sample_trajectories(traj: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` transitions drawn by md5(user_id:rn:seed) order (a
    bounded replay-buffer draw); ``traj.sample`` when exact size is not
    needed."""
    return hash_sample(traj, n, ("user_id", "rn"), seed)


def indexed_trajectories(ratings: DataFrame, index: DataFrame, state_size: int = 10,
                         keys=()) -> DataFrame:
    """Trajectories with item ids replaced by dense indexes (unknown -> -1)
    in state, action and next state. The index is attached to each rating
    before the window (one join of the rating rows with the item index),
    and the frames carry it, so no array is exploded and regrouped."""
    rated = (ratings.join(index.select("item_id", "idx"), "item_id", "left")
             .withColumn("idx", F.coalesce(F.col("idx"), F.lit(-1).cast("bigint"))))
    t = build_trajectories(rated, state_size, keys, carry=("idx",))
    return t.select(*list(keys or ()), "user_id", "rn", "state_idx",
                    F.col("action_idx"), "next_state_idx")
