"""Ranked-list recommenders (popularity, seeded random), candidate sets,
dense item index and item content vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow import params as P
from recflow.functions.columns import decade_bucket, genre_flag, md5_key, n_decade_buckets
from recflow.functions.ordering import global_row_number, keyed_row_number


def dense_index(item_ids: DataFrame) -> DataFrame:
    """(item_id, idx): 0-based position of each distinct item in item_id
    order, computed with a range-partitioned two-pass numbering."""
    distinct = item_ids.select("item_id").distinct()
    return (global_row_number(distinct, ["item_id"], "idx")
            .select("item_id", (F.col("idx") - F.lit(1)).cast("bigint").alias("idx")))


def from_index(indexed: DataFrame, index: DataFrame) -> DataFrame:
    """Inverse of the dense index: rows with ``idx`` get their item_id back
    (null for -1 and other unknown indexes)."""
    return indexed.join(index.select("idx", "item_id"), "idx", "left")


def popularity_ranking(train: DataFrame, keys=()) -> DataFrame:
    """(keys, item_id, n, list_rank): items by row count desc, item asc."""
    k = list(keys or ())
    counts = train.groupBy(*k, "item_id").agg(F.count(F.lit(1)).alias("n"))
    return keyed_row_number(counts, k, [F.col("n").desc(), F.col("item_id").asc()], "list_rank")


def random_ranking(train: DataFrame, seed: int, keys=()) -> DataFrame:
    """(keys, item_id, list_rank): one seeded shuffle of the item universe,
    md5(item_id:seed) order; the same list for every user."""
    k = list(keys or ())
    universe = train.select(*k, "item_id").distinct().withColumn(
        "_h", md5_key("item_id", F.lit(seed)))
    return keyed_row_number(universe, k, ["_h", "item_id"], "list_rank").drop("_h")


def top_candidates(train: DataFrame, n: int) -> DataFrame:
    """The n most rated items. A top-n keeps n rows per task; only those n
    rows are numbered."""
    counts = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("rating_count"))
    order = [F.col("rating_count").desc(), F.col("item_id").asc()]
    return counts.orderBy(*order).limit(n).select(
        "item_id", "rating_count",
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"))


#: Copies of a ranked list: users are spread over them, so the first ranks,
#: which every user asks for, are not one join key for all users.
LIST_COPIES = 32


def recommend_from_ranking(ranking: DataFrame, users: DataFrame, seen: DataFrame | None,
                           k: int, keys=()) -> DataFrame:
    """Top-k of one global ranked list per user, skipping the user's seen
    items, without a users x items product.

    A user with s seen items needs at most the first k + s list entries,
    so each user emits exactly k + s rank probes (linear in the data),
    equi-joined to the ranking on (keys, list_rank, copy): the list (one row
    per item) is copied ``LIST_COPIES`` times and a user reads one copy, so
    the first ranks are spread; AQE splits what is still uneven. The copies are
    merge joined: their size is estimated without the copying, so a list that is
    small as a file would be broadcast 32 times as large. Seen items
    are removed with an anti join and a window group limit keeps k.
    """
    kk = list(keys or ())
    users = users.select(*kk, "user_id").distinct()
    if seen is not None:
        s = seen.select(*kk, "user_id", "item_id").distinct()
        n_seen = s.groupBy(*kk, "user_id").agg(F.count(F.lit(1)).alias("_s"))
        users = users.join(n_seen, [*kk, "user_id"], "left")
        depth = F.lit(k) + F.coalesce(F.col("_s"), F.lit(0))
    else:
        depth = F.lit(k)
    probes = users.select(*kk, "user_id",
                          F.pmod(F.xxhash64("user_id"), F.lit(LIST_COPIES)).cast("int").alias("_copy"),
                          F.explode(F.sequence(F.lit(1).cast("bigint"),
                                               depth.cast("bigint"))).alias("list_rank"))
    copies = ranking.select(*kk, "item_id", "list_rank", F.explode(
        F.sequence(F.lit(0), F.lit(LIST_COPIES - 1))).alias("_copy"))
    cand = probes.join(copies.hint("merge"), [*kk, "list_rank", "_copy"]).drop("_copy")
    if seen is not None:
        cand = cand.join(s, [*kk, "user_id", "item_id"], "left_anti")
    w = Window.partitionBy(*kk, "user_id").orderBy("list_rank")
    return (cand.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select(*kk, "user_id", "item_id", F.col("rank").cast("bigint").alias("rank")))


def popularity_recommend(train: DataFrame, users: DataFrame, k: int,
                         exclude_seen: bool = True, keys=()) -> DataFrame:
    return recommend_from_ranking(popularity_ranking(train, keys), users,
                                  train if exclude_seen else None, k, keys)


def random_recommend(train: DataFrame, users: DataFrame, k: int, seed: int,
                     exclude_seen: bool = True, keys=()) -> DataFrame:
    return recommend_from_ranking(random_ranking(train, seed, keys), users,
                                  train if exclude_seen else None, k, keys)


def content_vectors(items: DataFrame, years: DataFrame, stats: DataFrame, genres) -> DataFrame:
    """(item_id, vector array<double>): genre flags, one-hot decade bucket,
    avg rating, rating std, popularity percentile. Items without a year or
    statistics get the documented defaults."""
    s = stats.select("item_id", "avg_rating", "rating_std", "popularity_percentile")
    base = (items.select("item_id", "genres")
            .join(years.select("item_id", "release_year"), "item_id", "left")
            .join(s, "item_id", "left")
            .na.fill({"release_year": P.DEFAULT_YEAR, "avg_rating": P.DEFAULT_AVG_RATING,
                      "rating_std": P.DEFAULT_RATING_STD,
                      "popularity_percentile": P.DEFAULT_POPULARITY}))
    bucket = decade_bucket(F.col("release_year"))
    parts = [genre_flag(F.col("genres"), g).cast("double") for g in genres]
    parts += [(bucket == F.lit(b)).cast("double") for b in range(n_decade_buckets())]
    parts += [F.col("avg_rating").cast("double"), F.col("rating_std").cast("double"),
              F.col("popularity_percentile").cast("double")]
    return base.select("item_id", F.array(*parts).alias("vector"))
