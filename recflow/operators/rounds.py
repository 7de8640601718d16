"""Expanding-window backtests from counts per window. A round trains on all windows
before its own, so what it needs is a prefix sum over windows; no rating row is copied
into the rounds it belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.ordering import keyed_row_number
from recflow.operators.recommend import recommend_from_ranking
from recflow.operators.splits import round_table


def round_progress(assigned: DataFrame, n_windows: int, state_size: int) -> DataFrame:
    """One row per round 1..n-1: train_rows, train_users, test_rows, test_users,
    eligible (train rows >= (K + 1) x train users) and train_trajectories (rows with K
    earlier train rows of their user).

    Ratings are reduced to one row per (user, window). A user's running count over the
    windows tells whether the user is new in a window and how many trajectories the
    window adds; both add up over windows. ``assigned`` holds window_id."""
    per = assigned.groupBy("user_id", "window_id").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("user_id").orderBy("window_id"))
    steps = lambda c: F.greatest(c - F.lit(state_size), F.lit(0))
    added = per.withColumn("_upto", upto).groupBy("window_id").agg(
        F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_users"),
        F.count(F.when(F.col("_upto") == F.col("n"), 1)).alias("_new"),
        F.sum(steps(F.col("_upto")) - steps(F.col("_upto") - F.col("n"))).alias("_steps"))
    windows = assigned.sparkSession.range(n_windows).select(F.col("id").alias("window_id"))
    # one row per window
    before = Window.orderBy("window_id").rowsBetween(Window.unboundedPreceding, -1)
    full = windows.join(added, "window_id", "left").fillna(0)
    out = full.select(
        F.col("window_id").alias("round"),
        F.sum("_rows").over(before).alias("train_rows"), F.sum("_new").over(before).alias("train_users"),
        F.col("_rows").alias("test_rows"), F.col("_users").alias("test_users"),
        F.sum("_steps").over(before).alias("train_trajectories")).where("round > 0")
    ok = F.col("train_rows") >= F.lit(state_size + 1) * F.col("train_users")
    return out.withColumn("eligible", ok.cast("int"))


def round_test(assigned: DataFrame) -> DataFrame:
    """Test rows of every round: each row of window r > 0 is tested in round r alone."""
    return assigned.where("window_id > 0").withColumnRenamed("window_id", "round")


def popularity_by_round(assigned: DataFrame, n_windows: int) -> DataFrame:
    """(round, item_id, n, list_rank): items by train rows, from counts per (window,
    item); only these counts are copied into rounds, never ratings."""
    rounds = round_table(assigned.sparkSession, n_windows).where("part = 'train'").drop("part")
    counts = (assigned.groupBy("window_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
              .join(F.broadcast(rounds), "window_id").groupBy("round", "item_id").agg(F.sum("n").alias("n")))
    return keyed_row_number(counts, ["round"], [F.col("n").desc(), F.col("item_id").asc()], "list_rank")


def popularity_backtest(assigned: DataFrame, n_windows: int, k: int) -> DataFrame:
    """(round, user_id, item_id, rank): the k items most rated before the round for every
    user of its test window, without those the user rated before. What a user has seen is
    one row per (user, item) with its first window, met by the user's test rounds."""
    users = round_test(assigned).select("round", "user_id").distinct()
    first = assigned.groupBy("user_id", "item_id").agg(F.min("window_id").alias("_first"))
    seen = users.join(first, "user_id").where("_first < round").select("round", "user_id", "item_id")
    return recommend_from_ranking(popularity_by_round(assigned, n_windows), users, seen, k, ("round",))
