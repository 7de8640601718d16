"""Off-policy estimators (IPS, clipped IPS, self-normalised IPS, direct
method, doubly robust) on logged ratings.

Every estimator is a sum over logged rows of a function of (rating,
per-item model values). The rows are first reduced to a histogram
(item, rating, n) with a map-side combined aggregate; per-item models
and all estimator sums then run on that histogram, so no row-level join
is needed and a hot item is only a large count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rating_histogram(logged: DataFrame) -> DataFrame:
    return logged.groupBy("item_id", "rating").agg(F.count(F.lit(1)).alias("cnt"))


def item_models(logged: DataFrame) -> DataFrame:
    """(item_id, n, propensity = n / N, mean_reward): the behaviour
    policy as the item's share of logged rows and the reward model as
    the item's mean rating."""
    h = rating_histogram(logged)
    per = h.groupBy("item_id").agg(F.sum("cnt").alias("n"),
                                   F.sum(F.col("rating") * F.col("cnt")).alias("_s"))
    total = per.select(F.sum("n")).scalar()
    return per.select("item_id", "n", (F.col("n") / total).alias("propensity"),
                      (F.col("_s") / F.col("n")).alias("mean_reward"))


def _stack(row: DataFrame, names: list[str]) -> DataFrame:
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("estimator"), F.col(n).cast("double").alias("value"))
        for n in names])))


def estimates(logged: DataFrame, clip: float = 10.0) -> DataFrame:
    """(estimator, value) with models fitted on the scored rows.

    ips_raw = mean(r/p), ips_std = sample std(r/p), ips_clipped =
    mean(min(r/p, C)), ips_sn = sum(r/p) / sum(1/p), dm_value = mean(rhat),
    dm_bias = mean(r - rhat), v_dr = dm + mean((1/p)(r - rhat)),
    v_dr_clipped = dm + mean(min(1/p, C)(r - rhat)), actual_avg = mean(r)."""
    h = rating_histogram(logged)
    w_item = Window.partitionBy("item_id")
    n_i = F.sum("cnt").over(w_item)
    s_i = F.sum(F.col("rating") * F.col("cnt")).over(w_item)
    hm = h.select("item_id", "rating", "cnt", n_i.alias("n_i"), s_i.alias("s_i"))
    total = h.select(F.sum("cnt")).scalar()
    p = F.col("n_i") / total
    rhat = F.col("s_i") / F.col("n_i")
    r, c = F.col("rating"), F.col("cnt")
    x = r / p
    row = hm.select(c.alias("c"), (x * c).alias("x"), (x * x * c).alias("xx"),
                    (F.least(x, F.lit(clip)) * c).alias("xc"), (c / p).alias("inv"),
                    (rhat * c).alias("rh"), ((r - rhat) * c).alias("res"),
                    ((F.lit(1.0) / p) * (r - rhat) * c).alias("cor"),
                    (F.least(F.lit(1.0) / p, F.lit(clip)) * (r - rhat) * c).alias("corc"),
                    (r * c).alias("rr"))
    s = row.agg(*[F.sum(k).alias(k) for k in
                  ("c", "x", "xx", "xc", "inv", "rh", "res", "cor", "corc", "rr")])
    n = F.col("c").cast("double")
    dm = F.col("rh") / n
    out = s.select(
        (F.col("x") / n).alias("ips_raw"),
        F.sqrt((F.col("xx") - F.col("x") * F.col("x") / n) / (n - F.lit(1.0))).alias("ips_std"),
        (F.col("xc") / n).alias("ips_clipped"),
        (F.col("x") / F.col("inv")).alias("ips_sn"),
        dm.alias("dm_value"),
        (F.col("res") / n).alias("dm_bias"),
        (F.col("cor") / n).alias("correction_term"),
        (dm + F.col("cor") / n).alias("v_dr"),
        (dm + F.col("corc") / n).alias("v_dr_clipped"),
        (F.col("rr") / n).alias("actual_avg"))
    return _stack(out, out.columns)


def top_k_uniform_policy(train: DataFrame, k: int) -> DataFrame:
    """(item_id, pi_e): uniform over the k most rated train items."""
    from recflow.operators.recommend import top_candidates
    return top_candidates(train, k).select("item_id", F.lit(1.0 / k).alias("pi_e"))


def policy_estimates(train: DataFrame, logged: DataFrame, target: DataFrame,
                     clip: float = 10.0) -> DataFrame:
    """Estimators for a given target policy (item_id, pi_e) on logged rows,
    with pi_b and the reward model fitted on ``train``.

    w = pi_e(a) / pi_b(a) (0 for items outside the target or unseen in
    train); DM = sum_i pi_e(i) rhat(i); DR = DM + mean(w (r - rhat(a)));
    items without a train mean use the global train mean."""
    m = item_models(train)
    gmean = train.select(F.avg("rating")).scalar()
    model = (m.join(target, "item_id", "full")
             .select("item_id", F.col("propensity").alias("pi_b"),
                     F.coalesce("mean_reward", gmean).alias("rhat"),
                     F.coalesce("pi_e", F.lit(0.0)).alias("pi_e")))
    dm = model.select(F.sum(F.col("pi_e") * F.col("rhat"))).scalar()
    h = rating_histogram(logged).join(model, "item_id", "left")
    w = F.when(F.col("pi_b") > 0, F.col("pi_e") / F.col("pi_b")).otherwise(F.lit(0.0))
    rhat = F.coalesce(F.col("rhat"), gmean)
    r, c = F.col("rating"), F.col("cnt")
    s = h.select(c.alias("c"), (w * r * c).alias("wr"), (w * c).alias("w"),
                 (F.least(w, F.lit(clip)) * r * c).alias("wrc"),
                 (w * (r - rhat) * c).alias("cor"),
                 (F.least(w, F.lit(clip)) * (r - rhat) * c).alias("corc"),
                 (r * c).alias("rr")).agg(
        *[F.sum(k).alias(k) for k in ("c", "wr", "w", "wrc", "cor", "corc", "rr")])
    n = F.col("c").cast("double")
    out = s.select(
        (F.col("wr") / n).alias("ips"),
        (F.col("wrc") / n).alias("ips_clipped"),
        F.when(F.col("w") > 0, F.col("wr") / F.col("w")).alias("ips_sn"),
        dm.alias("dm_value"),
        (dm + F.col("cor") / n).alias("v_dr"),
        (dm + F.col("corc") / n).alias("v_dr_clipped"),
        (F.col("rr") / n).alias("actual_avg"))
    return _stack(out, out.columns)
