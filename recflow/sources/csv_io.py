"""CSV exchange format of the ratings and item tables: header row,
explicit schema (no inference pass), quoted fields with '"' as escape so
titles with commas survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RATINGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

ITEMS_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("category", T.StringType()),
])


def write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RATINGS_SCHEMA)


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ITEMS_SCHEMA)


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Small metadata tables (window bounds, round summaries) as JSON lines,
    written by the executors like any other table."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)
