"""Mixing sources to target weights by hash-threshold histograms.

Every source gets a target number of words. A document is taken as a whole as
often as the target holds its source's full size, and once more if its hash is
below the source's threshold. The threshold comes from a histogram of word
sums by (source, hash bucket): the bucket in which the remaining budget runs
out is the boundary bucket, and only its documents are counted again on the
next hash digits. Thresholds of growing budgets are nested (a document taken
at a budget is taken at every larger one). Nothing is sorted by document.

Scale: a histogram has at most ``BUCKETS`` rows per source and is summed
map-side, so a source with a third of all rows costs no more than another.
Source totals (one row per source) are the only rows that meet in one place.

Defined results: null or blank texts have size 0 and are taken 0 words; null
sources form one source, last in order; an empty table gives no rows; a source
of size 0 has target 0; rows equal in id and text share one hash, so they are
taken together; extra columns are kept, and input columns named like an
output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.llm.common import WORD, fresh, stored, table

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3.0
BITS = 10
BUCKETS = 1 << BITS
LEVELS = 4
OUTPUTS = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): targets are
    proportional to weight, at most ``max_epochs`` times the source, the
    excess of capped sources reshared. With sources ordered by cap / weight
    the level at which the rest share is a ratio of running sums."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(everything) - 1) % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    rest_w = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / rest_w
    return (sizes.withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
            .withColumn("level", level)
            # the level of the first source that stays under its cap holds for all after it
            .withColumn("free", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                                             F.struct(F.col("cap") / F.col("weight"), "level")))
                        .over(whole))
            .select("source", "source_size", F.coalesce(
                F.least("cap", F.col("free.level") * F.col("weight")), F.col("cap")).alias("target")))


def hash_thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold, closed) for ``rows`` (source, size, digits) and
    ``budgets`` (source, budget): the rows whose digits are below the threshold
    sum to at most the budget; ``closed`` tells that the rows at the threshold
    come along because the sum is then nearer to the budget. Level by level
    only rows that share the boundary digits so far are summed."""
    found = budgets.select("source", F.col("budget").alias("left"),
                           F.lit("").alias("prefix"))
    for level in range(LEVELS):
        width = level * BITS
        inside = (rows.join(found.withColumnRenamed("source", "s"),
                            F.col("source").eqNullSafe(F.col("s"))).drop("s", "closed")
                  .where(F.expr(f"left(digits, {width}) = prefix")))
        hist = (inside.withColumn("bucket", F.substring("digits", width + 1, BITS))
                .groupBy("source", "prefix", "left", "bucket").agg(F.sum("size").alias("words")))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        # boundary: the first bucket that the budget does not hold in full
        over = (hist.withColumn("upto", F.sum("words").over(run))
                .where(F.col("upto") > F.col("left"))
                .groupBy("source").agg(F.min(F.struct(
                    "bucket", (F.col("left") - F.col("upto") + F.col("words")).alias("left"),
                    "prefix", "words")).alias("b")))
        found = stored(over.select("source", F.col("b.left").alias("left"),
                                   F.concat("b.prefix", "b.bucket").alias("prefix"),
                                   (F.col("b.words") < 2 * F.col("b.left")).alias("closed")),
                       f"mix-level{level}")
    return found.select("source", F.col("prefix").alias("threshold"), "closed")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0,
        max_epochs: float = MAX_EPOCHS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: int = 11) -> DataFrame:
    """``docs`` with size, source_size, target and taken."""
    docs = docs.drop(*OUTPUTS)
    digits, key, whole, limit, closed = fresh(docs, "digits", "key", "whole", "limit", "closed")
    # 40 hash digits in base 2 as text: a prefix is a bucket, string order is hash order
    keyed = docs.withColumn("size", word_count(F.col(text_col))).withColumn(digits, F.lpad(
        F.bin(F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)),
                                   64 - LEVELS * BITS)), LEVELS * BITS, "0"))
    narrow = stored(keyed.select(F.col(source_col).alias("source"), "size",
                                 F.col(digits).alias("digits")), "mix-rows")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, max_epochs), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                    ).otherwise(F.lit(0)).cast("bigint")
    budgets = targets.select("source", (F.col("target") - epochs * F.col("source_size")).alias("budget"))
    plan = (targets.withColumn("whole", epochs)
            .join(hash_thresholds(narrow, budgets).withColumnRenamed("source", "s"),
                  F.col("source").eqNullSafe(F.col("s")), "left")
            .select(F.col("source").alias(key), "source_size", "target", F.col("whole").alias(whole),
                    F.col("threshold").alias(limit), F.col("closed").alias(closed)))
    once = F.when(F.col(limit).isNull() | (F.col(digits) < F.col(limit))
                  | (F.col(closed) & (F.col(digits) == F.col(limit))), F.lit(1)).otherwise(F.lit(0))
    # no boundary (the budget holds all): one more epoch only if the budget is not empty
    more = F.when(F.col("target") > F.col(whole) * F.col("source_size"), once).otherwise(F.lit(0))
    return (keyed.join(plan, F.col(source_col).eqNullSafe(F.col(key)), "left")
            .withColumn("taken", (F.col("size") * (F.col(whole) + more)).cast("bigint"))
            .drop(digits, key, whole, limit, closed))


def repeat_taken(docs: DataFrame, **kw) -> DataFrame:
    """Every document as many times as the mix takes it, columns as given."""
    clash = [c for c in docs.columns if c in OUTPUTS]
    renamed = dict(zip(clash, fresh(docs, *[f"in_{c}" for c in clash])))
    mixed = mix(docs.withColumnsRenamed(renamed), **kw)
    times = F.expr("cast(if(size > 0, taken div size, 0) as int)")
    return (mixed.withColumn("taken", times).where("taken > 0")
            .withColumn("taken", F.explode(F.sequence(F.lit(1), F.col("taken"))))
            .select(*[F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns]))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
