"""Tabular batch-constrained Q-learning on category-level transitions.

State = the category with the highest mean rating among the K state
items (ties: alphabetical); action = the category of the action item;
reward = normalised rating. One distributed aggregate over all
trajectories gives n(s, a, s') and the reward sums; policy iteration then
works on that table, whose size is bounded by |S|^2 |A|, to its fixed point."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.columns import normalized_reward, rank_key


def top_category(ratings: Column, cats: Column) -> Column:
    """Category with the highest mean rating in the zipped arrays; ties go
    to the alphabetically first category. Pure array functions on a K-long
    array: no shuffle. The pairs are zipped once (as the lambda's argument) and summed
    in place; no filtered copy is made per category."""
    def best(pairs):
        def score(c):
            total = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + F.when(x["c"] == c, x["r"]).otherwise(0.0))
            count = F.aggregate(pairs, F.lit(0), lambda a, x: a + F.when(x["c"] == c, 1).otherwise(0))
            return F.struct((-(total / count)).alias("neg_mean"), c.alias("cat"))
        return F.array_min(F.transform(F.array_distinct(pairs["c"]), score))["cat"]
    return F.get(F.transform(F.array(F.arrays_zip(ratings.alias("r"), cats.alias("c"))), best), 0)


def transitions(traj: DataFrame) -> DataFrame:
    """(state, action, reward, next_state) from trajectories built with
    ``carry=('category',)``."""
    return traj.select(
        top_category(F.col("state_ratings"), F.col("state_category")).alias("state"),
        F.col("action_category").alias("action"),
        normalized_reward(F.col("reward")).alias("reward"),
        top_category(F.col("next_state_ratings"), F.col("next_state_category")).alias("next_state"))


def transition_model(trans: DataFrame) -> DataFrame:
    """(state, action, next_state, n, reward_sum): the one distributed
    aggregate over all transitions; everything after it works on this
    table of at most |S|^2 |A| rows."""
    return trans.groupBy("state", "action", "next_state").agg(
        F.count(F.lit(1)).alias("n"), F.sum("reward").alias("reward_sum"))


def behaviour_policy(model: DataFrame) -> DataFrame:
    """(state, action, n, pi_b) with pi_b = n(s, a) / n(s)."""
    sa = model.groupBy("state", "action").agg(F.sum("n").alias("n"))
    return sa.withColumn("pi_b", F.col("n") / F.sum("n").over(Window.partitionBy("state")))


def allowed_actions(behaviour: DataFrame, tau: float) -> DataFrame:
    """Actions with pi_b(a|s) >= tau x max_a pi_b(a|s); tau = 0 keeps every
    observed action (unconstrained)."""
    mx = F.max("pi_b").over(Window.partitionBy("state"))
    return (behaviour.withColumn("_mx", mx)
            .filter(F.col("pi_b") >= F.lit(tau) * F.col("_mx")).select("state", "action"))


def _squared(step: DataFrame, times: int) -> DataFrame:
    """An affine map v -> M v + c applied 2^times times. ``step`` has a row
    (state, target, x) per cell of M and one with target null per cell of c."""
    for _ in range(times):
        onward = step.select(F.col("state").alias("target"), F.col("target").alias("far"), F.col("x").alias("y"))
        twice = (step.where("target is not null").join(onward, "target")
                 .select("state", F.col("far").alias("target"), (F.col("x") * F.col("y")).alias("x")))
        step = (step.where("target is null").unionByName(twice)
                .groupBy("state", "target").agg(F.sum("x").alias("x")))
    return step


def evaluate_policy(rewards: DataFrame, transitions: DataFrame, policy: DataFrame, gamma: float,
                    tolerance: float) -> DataFrame:
    """(state, v): discounted value of a deterministic policy (state, action), never
    terminal. One step of it is an affine map of the values; squaring the map doubles
    the horizon, so about log2 of the horizon at which gamma^t / (1 - gamma) falls
    below ``tolerance`` suffices. Two squarings are one job, written to the shared
    folder; tables hold |S|^2 + |S| rows."""
    from recflow.session import materialize
    horizon = math.log(max(tolerance * (1 - gamma), 1e-300)) / math.log(gamma) if gamma > 0 else 1
    step = (transitions.join(policy, ["state", "action"])
            .select("state", F.col("next_state").alias("target"), (F.col("p") * F.lit(gamma)).alias("x"))
            .unionByName(rewards.join(policy, ["state", "action"])
                         .select("state", F.lit(None).cast("string").alias("target"), F.col("rbar").alias("x"))))
    left = max(math.ceil(math.log2(max(horizon, 1))), 0)
    while left > 0:
        step = materialize(_squared(step, min(left, 2)), "q-horizon")
        left -= 2
    return step.where("target is null").select("state", F.col("x").alias("v"))


def q_values(model: DataFrame, gamma: float = 0.99, tau: float = 0.0, tolerance: float = 1e-9,
             max_rounds: int = 1000) -> DataFrame:
    """The fixed point of the batch-constrained backup on the transition model, never
    terminal: Q(s, a) = rbar(s, a) + gamma sum_s' P(s'|s, a) max_{a' allowed in s'} Q(s', a');
    a state without a logged action is worth 0.

    Policy iteration: the greedy allowed policy is evaluated to the end, then improved,
    until no state's best action beats the policy's value by more than ``tolerance``.
    The driver reads that one residual per round; every table has at most
    |S|^2 |A| rows."""
    from recflow.session import materialize
    if not 0 <= gamma < 1:
        raise ValueError("gamma must lie in [0, 1)")
    sa = model.groupBy("state", "action").agg(F.sum("n").alias("n_sa"),
                                              F.sum("reward_sum").alias("_rs"))
    sa = materialize(sa.select("state", "action", "n_sa", (F.col("_rs") / F.col("n_sa")).alias("rbar")),
                     "q-rewards")
    sas = materialize(model.join(sa.select("state", "action", "n_sa"), ["state", "action"])
                      .select("state", "action", "next_state", (F.col("n") / F.col("n_sa")).alias("p")),
                      "q-transitions")
    allowed = materialize(allowed_actions(behaviour_policy(model), tau), "q-allowed")
    q = sa.select("state", "action", F.col("rbar").alias("q"))
    for _ in range(max_rounds):
        policy = materialize(greedy_policy(q, allowed).select("state", "action"), "q-policy")
        v = evaluate_policy(sa, sas, policy, gamma, tolerance)
        ev = (sas.join(v.withColumnRenamed("state", "next_state"), "next_state", "left")
              .groupBy("state", "action")
              .agg(F.sum(F.col("p") * F.coalesce(F.col("v"), F.lit(0.0))).alias("ev")))
        q = materialize(sa.join(ev, ["state", "action"], "left").select(
            "state", "action", (F.col("rbar") + F.lit(gamma) * F.coalesce("ev", F.lit(0.0))).alias("q")),
            "q-values")
        best = q.join(allowed, ["state", "action"]).groupBy("state").agg(F.max("q").alias("best"))
        residual = best.join(v, "state").agg(F.max(F.abs(F.col("best") - F.col("v")))).first()[0]
        if residual is None or residual <= 10 * tolerance:
            return q
    raise RuntimeError(f"no stable policy after {max_rounds} rounds; the last residual was {residual}")


def greedy_policy(q: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Per state the action with the highest Q (ties: action name), among
    ``allowed`` actions when given."""
    if allowed is not None:
        q = q.join(allowed, ["state", "action"])
    w = Window.partitionBy("state").orderBy(rank_key(F.col("q")).desc(), F.col("action"))
    return (q.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select("state", "action", "q"))


def compare_policies(model: DataFrame, gamma: float, tau: float) -> DataFrame:
    """Greedy action and value per state, unconstrained against constrained."""
    beh = behaviour_policy(model)
    qu = greedy_policy(q_values(model, gamma))
    qc = greedy_policy(q_values(model, gamma, tau), allowed_actions(beh, tau))
    return (qu.select("state", F.col("action").alias("action_unconstrained"),
                      F.col("q").alias("q_unconstrained"))
            .join(qc.select("state", F.col("action").alias("action_constrained"),
                            F.col("q").alias("q_constrained")), "state", "full")
            .withColumn("same_action",
                        (F.col("action_unconstrained") == F.col("action_constrained")).cast("int")))


def policy_value(model: DataFrame, greedy: DataFrame, clip: float = 10.0) -> DataFrame:
    """(ips, ips_clipped, ips_sn, coverage) of a deterministic policy
    (state, action) on the logged transitions: w = 1 / pi_b on the rows whose
    action the policy takes, 0 on all others. coverage is the share of logged
    rows in states for which the policy has an action."""
    logged = (model.groupBy("state", "action").agg(F.sum("n").alias("n"),
                                                   F.sum("reward_sum").alias("rs"))
              .withColumn("n_s", F.sum("n").over(Window.partitionBy("state"))))
    total = logged.select(F.sum("n")).scalar()
    taken = logged.join(greedy.select("state", "action"), ["state", "action"])
    w = F.col("n_s") / F.col("n")
    s = taken.agg(F.sum(w * F.col("rs")).alias("wr"), F.sum(w * F.col("n")).alias("w"),
                  F.sum(F.least(w, F.lit(clip)) * F.col("rs")).alias("wrc"))
    return s.select((F.col("wr") / total).alias("ips"), (F.col("wrc") / total).alias("ips_clipped"),
                    (F.col("wr") / F.col("w")).alias("ips_sn"), (F.col("w") / total).alias("coverage"))
