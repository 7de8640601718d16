"""Ranking metrics (DCG, NDCG, recall, precision, MRR) for top-k lists
against held-out ratings, summaries over users, method comparison and
learning curves over backtest rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.columns import discount, gain, normalized_reward


def _k(keys) -> list:
    return list(keys or ())


def relevance(heldout: DataFrame, keys=()) -> DataFrame:
    """(keys, user_id, item_id, rel): normalised held-out rating; a user's
    repeated item counts once with its highest rating."""
    kk = _k(keys)
    return (heldout.groupBy(*kk, "user_id", "item_id").agg(F.max("rating").alias("_r"))
            .select(*kk, "user_id", "item_id", normalized_reward(F.col("_r")).alias("rel")))


def user_metrics(recs: DataFrame, heldout: DataFrame, k_values=(5, 10, 20),
                 threshold: float = 0.6, mode: str = "user", keys=()) -> DataFrame:
    """One row per held-out user: ndcg_k, recall_k, precision_k, mrr.

    rel = (rating - 0.5) / 4.5, gain 2^rel - 1, discount log2(rank + 1).
    mode "user": a missed item has rel 0; the ideal ranking and the recall
    denominator come from all of the user's held-out items.
    mode "list": a missed item has the rating 0 (rel -0.111); ideal and
    recall denominator come from the recommended top-k only.
    Precision divides by k; MRR uses the whole list.
    """
    kk = _k(keys)
    ks = sorted(k_values)
    rel = relevance(heldout, keys)
    miss = F.lit(0.0) if mode == "user" else normalized_reward(F.lit(0.0))
    hits = (recs.select(*kk, "user_id", "item_id", "rank")
            .join(rel, [*kk, "user_id", "item_id"], "left")
            .withColumn("g", F.coalesce(F.col("rel"), miss)))
    is_rel = F.col("g") >= F.lit(threshold)
    rank = F.col("rank")
    aggs = []
    for k in ks:
        aggs.append(F.sum(F.when(rank <= k, gain(F.col("g")) / discount(rank))
                          .otherwise(F.lit(0.0))).alias(f"dcg_{k}"))
        aggs.append(F.count(F.when((rank <= k) & is_rel, 1)).alias(f"hits_{k}"))
    aggs.append(F.min(F.when(is_rel, rank)).alias("first_rel"))
    if mode == "list":
        # the list is bounded by the recommender's k, so collecting it per
        # user is bounded too
        aggs.append(F.collect_list(F.struct(rank.alias("rank"), F.col("g").alias("g")))
                    .alias("_lst"))
    per_user = hits.groupBy(*kk, "user_id").agg(*aggs)

    if mode == "list":
        def within(k):
            return lambda x: x["rank"] <= F.lit(k)
        for k in ks:
            top = F.filter("_lst", within(k))
            gs = F.sort_array(F.transform(top, lambda x: x["g"]), asc=False)
            per_user = per_user.withColumn(f"idcg_{k}", F.aggregate(
                F.transform(gs, lambda g, i: gain(g) / discount(i + 1)),
                F.lit(0.0), lambda a, b: a + b))
        per_user = per_user.drop("_lst")
        base = rel.select(*kk, "user_id").distinct().join(per_user, [*kk, "user_id"], "left")
    else:
        mk = max(ks)
        w = Window.partitionBy(*kk, "user_id").orderBy(F.col("rel").desc(), F.col("item_id"))
        # row_number <= max k: Spark keeps a partial top-k per task before
        # the shuffle (window group limit), so a hot user is cut early
        top = rel.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= mk)
        ideal = top.groupBy(*kk, "user_id").agg(*[
            F.sum(F.when(F.col("pos") <= k, gain(F.col("rel")) / discount(F.col("pos")))
                  .otherwise(F.lit(0.0))).alias(f"idcg_{k}") for k in ks])
        nrel = rel.groupBy(*kk, "user_id").agg(
            F.count(F.when(F.col("rel") >= F.lit(threshold), 1)).alias("n_rel"))
        # every held-out user has a row in nrel and in ideal
        base = (nrel.join(ideal, [*kk, "user_id"])
                .join(per_user, [*kk, "user_id"], "left"))

    cols = []
    for k in ks:
        dcg = F.coalesce(F.col(f"dcg_{k}"), F.lit(0.0))
        idcg = F.coalesce(F.col(f"idcg_{k}"), F.lit(0.0))
        h = F.coalesce(F.col(f"hits_{k}"), F.lit(0)).cast("double")
        cols.append(F.when(idcg > 0, dcg / idcg).otherwise(F.lit(0.0)).alias(f"ndcg_{k}"))
        if mode == "list":
            cols.append(F.when(h > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"recall_{k}"))
        else:
            n_rel = F.coalesce(F.col("n_rel"), F.lit(0)).cast("double")
            cols.append(F.when(n_rel > 0, h / n_rel).otherwise(F.lit(0.0)).alias(f"recall_{k}"))
        cols.append((h / F.lit(float(k))).alias(f"precision_{k}"))
    cols.append(F.coalesce(F.lit(1.0) / F.col("first_rel"), F.lit(0.0)).alias("mrr"))
    return base.select(*kk, "user_id", *cols)


def summarize(per_user: DataFrame, k_values=(5, 10, 20), keys=()) -> DataFrame:
    """Long table (keys, metric, k, mean, std, n_users); std is the
    population std over users. MRR is reported with k = the longest cut."""
    kk = _k(keys)
    ks = sorted(k_values)
    entries = []
    for k in ks:
        for m in ("ndcg", "recall", "precision"):
            entries.append(F.struct(F.lit(m).alias("metric"), F.lit(k).cast("bigint").alias("k"),
                                    F.col(f"{m}_{k}").alias("v")))
    entries.append(F.struct(F.lit("mrr").alias("metric"), F.lit(max(ks)).cast("bigint").alias("k"),
                            F.col("mrr").alias("v")))
    long = per_user.select(*kk, F.inline(F.array(*entries)))
    return long.groupBy(*kk, "metric", "k").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"),
        F.count(F.lit(1)).alias("n_users"))


def evaluate(recs: DataFrame, heldout: DataFrame, k_values=(5, 10, 20),
             threshold: float = 0.6, mode: str = "user", keys=()) -> DataFrame:
    return summarize(user_metrics(recs, heldout, k_values, threshold, mode, keys),
                     k_values, keys)


def compare_table(summaries: DataFrame, k_values=(5, 10, 20), keys=("method",)) -> DataFrame:
    """Pivot of a summary with a method key into fixed metric columns."""
    kk = _k(keys)
    ks = sorted(k_values)
    aggs = []
    for m in ("ndcg", "recall", "precision"):
        for k in ks:
            aggs.append(F.max(F.when((F.col("metric") == m) & (F.col("k") == k), F.col("mean")))
                        .alias(f"{m}_{k}"))
    aggs.append(F.max(F.when(F.col("metric") == "mrr", F.col("mean"))).alias("mrr"))
    aggs.append(F.max("n_users").alias("n_users"))
    return summaries.groupBy(*kk).agg(*aggs)


def curve_compare(curve: DataFrame, a: str, b: str, metric: str = "ndcg_10",
                  margin: float = 0.003) -> DataFrame:
    """Two methods' metric per round: delta = b - a, verdict at +-margin,
    and each method's first-to-last change in percent. ``curve`` has
    (method, round, <metric>)."""
    ca = curve.filter(F.col("method") == a).select("round", F.col(metric).alias("value_a"))
    cb = curve.filter(F.col("method") == b).select("round", F.col(metric).alias("value_b"))
    j = ca.join(cb, "round")
    # one row per round (n_windows - 1 rows): a window without partition
    # over this table is bounded by the number of rounds
    w = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fa, la = F.first("value_a").over(w), F.last("value_a").over(w)
    fb, lb = F.first("value_b").over(w), F.last("value_b").over(w)
    delta = F.col("value_b") - F.col("value_a")
    verdict = (F.when(delta > margin, F.lit(f"{b} wins"))
               .when(delta < -margin, F.lit(f"{a} wins")).otherwise(F.lit("tie")))
    pct = lambda f, l: F.when(f != 0, (l / f - F.lit(1.0)) * F.lit(100.0))
    return j.select("round", F.col("value_a").alias(f"{metric}_{a}"),
                    F.col("value_b").alias(f"{metric}_{b}"), delta.alias("delta"),
                    verdict.alias("verdict"), pct(fa, la).alias(f"change_{a}_pct"),
                    pct(fb, lb).alias(f"change_{b}_pct"))
