"""Readers for the driver's Parquet tables and the binding of those tables
to the interaction / item model (user_id, item_id, rating, ts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: genre vocabulary of the test binding (part names split on
# a space, plus the marker for items without genres), alphabetical ---
DATA_GENRES = (
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new",
    "old", "plate", "red", "ring", "rod", "small", "widget",
    "(no genres listed)",
)
NO_GENRES = "(no genres listed)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """interactions(user_id bigint, item_id bigint, rating double, ts bigint).

    One row per line item: the order's customer rates the part. Quantity
    1..50 maps to the ten half-star ratings; ``unix_timestamp`` of a
    TIMESTAMP_NTZ does not depend on the session time zone.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return joined.select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        (F.ceil(F.col("l_quantity") / F.lit(5.0)) * F.lit(0.5)).cast("double").alias("rating"),
        F.unix_timestamp(F.col("l_shipdate")).cast("bigint").alias("ts"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """items(item_id, title, genres, category) from ``part``.

    Every 20th part has no year in its title and every 10th has no genre,
    so the year imputation and the "no genres" flag are exercised.
    """
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type")
    key = F.col("p_partkey")
    return p.select(
        key.cast("bigint").alias("item_id"),
        F.when(key % 20 == 0, F.col("p_name"))
        .otherwise(F.concat(F.col("p_name"), F.lit(" ("),
                            (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")))
        .alias("title"),
        F.when(key % 10 == 0, F.lit(NO_GENRES))
        .otherwise(F.regexp_replace(F.col("p_name"), " ", "|")).alias("genres"),
        F.col("p_type").alias("category"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
