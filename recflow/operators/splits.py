"""Cold-start filter, per-user temporal holdout, global time windows and
expanding-window backtest rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.sampling import hash_sample
from recflow.operators.sequence import numbered


def _keys(keys) -> list:
    return list(keys or ())


def cold_start(ratings: DataFrame, min_item: int = 5, min_user: int = 10,
               iterations: int = 1, keys=()) -> DataFrame:
    """Keep items with >= ``min_item`` rows, then users with >= ``min_user``
    rows among what is left. One pass by default (an item may fall below
    its threshold again); ``iterations`` > 1 repeats the pass (k-core).

    Counts are partial aggregates (map-side combine), and the filters are
    semi joins: AQE broadcasts the key set when it is small and otherwise
    sort-merges, splitting a hot key across tasks.
    """
    k = _keys(keys)
    df = ratings
    for _ in range(max(1, iterations)):
        ok_items = (df.groupBy(*k, "item_id").agg(F.count(F.lit(1)).alias("_n"))
                    .filter(F.col("_n") >= min_item).select(*k, "item_id"))
        df = df.join(ok_items, [*k, "item_id"], "left_semi")
        ok_users = (df.groupBy(*k, "user_id").agg(F.count(F.lit(1)).alias("_n"))
                    .filter(F.col("_n") >= min_user).select(*k, "user_id"))
        df = df.join(ok_users, [*k, "user_id"], "left_semi")
    return df


def sequence_numbered(ratings: DataFrame, keys=()) -> DataFrame:
    """rn = 1.. per user in (ts, item_id, rating) order."""
    return numbered(ratings, [*_keys(keys), "user_id"]).drop("n")


def temporal_split(ratings: DataFrame, ratio: float = 0.8, keys=(),
                   keep_order: bool = False) -> DataFrame:
    """Adds ``part``: 'train' for the first rn <= n * ratio rows of each user
    (n = the user's row count), 'test' for the rest. ``keep_order`` also
    returns the row's number inside the user's part (rn) and the part's rows
    (n), so later sequences need not number again."""
    df = numbered(ratings, [*_keys(keys), "user_id"])
    share = F.col("n") * F.lit(float(ratio))
    is_train = F.col("rn") <= share
    df = df.withColumn("part", F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
    if not keep_order:
        return df.drop("rn", "n")
    first = F.floor(share).cast("bigint")
    return df.select(*ratings.columns, "part",
                     F.when(is_train, F.col("rn")).otherwise(F.col("rn") - first).alias("rn"),
                     F.when(is_train, first).otherwise(F.col("n") - first).alias("n"))


def train_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("part") == "train").drop("part")


def test_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("part") == "test").drop("part")


def time_bounds(ratings: DataFrame, n_windows: int):
    """(t_min, t_max, width) as scalar-subquery columns: one global
    aggregate, never collected to the driver."""
    agg = ratings.agg(F.min("ts").alias("t_min"), F.max("ts").alias("t_max"))
    t_min = agg.select("t_min").scalar()
    t_max = agg.select("t_max").scalar()
    width = (t_max - t_min).cast("double") / F.lit(float(n_windows))
    return t_min, t_max, width


def assign_windows(ratings: DataFrame, n_windows: int) -> DataFrame:
    """window_id = least(n-1, floor((ts - t_min) / width)): N equal-length
    windows over the global time range; the last one is closed so the row
    at t_max belongs to it."""
    t_min, _, width = time_bounds(ratings, n_windows)
    wid = F.when(width > 0, F.least(F.lit(n_windows - 1),
                                    F.floor((F.col("ts") - t_min) / width)))
    return ratings.withColumn("window_id", F.coalesce(wid, F.lit(0)).cast("bigint"))


def window_stats(ratings: DataFrame, n_windows: int) -> DataFrame:
    """One row per window: bounds, rows and distinct users; windows without
    rows are listed with zeros."""
    spark = ratings.sparkSession
    t_min, t_max, width = time_bounds(ratings, n_windows)
    assigned = assign_windows(ratings, n_windows)
    stats = assigned.groupBy("window_id").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct("user_id").alias("n_users"))
    ids = spark.range(n_windows).select(F.col("id").alias("window_id"))
    w = F.col("window_id").cast("double")
    return (ids.join(stats, "window_id", "left")
            .select("window_id",
                    (t_min + width * w).alias("t_start"),
                    (t_min + width * (w + F.lit(1.0))).alias("t_end"),
                    F.coalesce("n_ratings", F.lit(0)).cast("bigint").alias("n_ratings"),
                    F.coalesce("n_users", F.lit(0)).cast("bigint").alias("n_users")))


def round_table(spark, n_windows: int) -> DataFrame:
    """(round, window_id, part): round r trains on windows 0..r-1 and tests
    on window r, r = 1..n-1. n(n+1)/2 - 1 rows: a fixed, tiny table."""
    r = spark.range(1, n_windows).select(F.col("id").alias("round"))
    return r.select(
        "round",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("round"))).alias("window_id"),
    ).withColumn("part", F.when(F.col("window_id") == F.col("round"), F.lit("test"))
                 .otherwise(F.lit("train")))


def backtest_rounds(ratings: DataFrame, n_windows: int) -> DataFrame:
    """All rounds in one table (round, part, user_id, item_id, rating, ts);
    write it with ``partitionBy('round', 'part')`` so a round's train or
    test set is a partition-pruned scan."""
    rounds = round_table(ratings.sparkSession, n_windows)
    assigned = assign_windows(ratings, n_windows)
    # the round table has a fixed size bound (n^2 rows), so broadcasting it
    # is safe at any data size
    return (assigned.join(F.broadcast(rounds), "window_id")
            .select("round", "part", "user_id", "item_id", "rating", "ts"))


def round_eligibility(rounds: DataFrame, state_size: int) -> DataFrame:
    """A round can feed trajectories when its train rows >= (K+1) x users."""
    tr = rounds.filter(F.col("part") == "train")
    agg = tr.groupBy("round").agg(F.count(F.lit(1)).alias("train_rows"),
                                  F.countDistinct("user_id").alias("train_users"))
    ok = F.col("train_rows") >= F.lit(state_size + 1) * F.col("train_users")
    return agg.withColumn("eligible", ok.cast("int"))


def user_sample(ratings: DataFrame, n_users: int, seed: int) -> DataFrame:
    """Rows of ``n_users`` users drawn by md5(user_id:seed) order: the same
    draw in any engine with md5."""
    users = hash_sample(ratings.select("user_id").distinct(), n_users, ("user_id",), seed)
    return ratings.join(users, "user_id", "left_semi")
