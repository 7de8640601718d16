"""Approximate quantiles from mergeable KLL sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.splits import round_table

# size parameter of a sketch; ranks are off by about 0.7 % of the rows
SKETCH_K = 400


def sketches(rows: DataFrame, value: str, keys=(), k: int = SKETCH_K) -> DataFrame:
    """(keys, n, sketch): a sketch of the values per key, built map-side and merged; nulls
    and values that are not numbers are left out. No rows give no sketch."""
    v = F.col(value).cast("double")
    return (rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*(keys or ()))
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch"))
            .where("n > 0"))


def merged(parts: DataFrame, keys=()) -> DataFrame:
    """Sketches of finer keys merged into coarser ones."""
    return (parts.groupBy(*(keys or ())).agg(F.sum("n").alias("n"),
                                             F.kll_merge_agg_double("sketch").alias("sketch"))
            .where("n > 0"))


def quantiles(parts: DataFrame, probs, keys=()) -> DataFrame:
    """(keys, p, n, value): the quantiles at ``probs`` of every sketch."""
    found = F.array(*[F.struct(F.lit(float(p)).alias("p"), "n", F.kll_sketch_get_quantile_double(
        "sketch", F.lit(float(p))).alias("value")) for p in probs])
    return parts.select(*(keys or ()), F.inline(found))


def round_sketches(assigned: DataFrame, value: str, n_windows: int, k: int = SKETCH_K) -> DataFrame:
    """(round, n, sketch) over the train rows of every round, merged from one sketch per
    window: a rating enters one sketch however many rounds train on it."""
    rounds = round_table(assigned.sparkSession, n_windows).where("part = 'train'").drop("part")
    return merged(sketches(assigned, value, ("window_id",), k).join(F.broadcast(rounds), "window_id"),
                  ("round",))


def rank_within(rows: DataFrame, value: str, found: DataFrame, tolerance: float, keys=()) -> DataFrame:
    """Holds quantiles against all rows: adds ok = 1 where the share of smaller values is
    at most p + tolerance and the share of values up to it at least p - tolerance.
    ``found`` has (keys, p, n, value), a few rows per key, and is broadcast; without keys
    its few rows are read by the driver and asked of every row."""
    k = list(keys or ())
    v = F.col(value).cast("double")
    if k:
        pairs = rows.join(F.broadcast(found.withColumnRenamed("value", "_q")), k)
    else:
        asked = [F.struct(F.lit(r["p"]).alias("p"), F.lit(r["n"]).cast("bigint").alias("n"),
                          F.lit(r["value"]).alias("_q")) for r in found.collect()]
        if not asked:
            return found.select("p", "n", F.lit(1).alias("ok"))
        pairs = rows.drop("p", "n").select("*", F.inline(F.array(*asked)))
    return pairs.groupBy(*k, "p", "n").agg(
        F.count(F.when(v < F.col("_q"), 1)).alias("_below"),
        F.count(F.when(v <= F.col("_q"), 1)).alias("_upto")).select(
        *k, "p", "n", ((F.col("_below") <= (F.col("p") + tolerance) * F.col("n"))
                       & (F.col("_upto") >= (F.col("p") - tolerance) * F.col("n"))).cast("int").alias("ok"))
