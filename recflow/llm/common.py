"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.session import scratch_path

# --- fixed values: letters folded by every operator (ASCII only) and the
# whitespace class of the word definition ---
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character kept. ``lower`` does that faster
    on pure ASCII text; ``translate`` serves the rest."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def words(c: Column) -> Column:
    """Whitespace-separated words, null and blank texts giving an empty array."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACES), lambda w: w != "")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write once to the shared checkpoint folder and read back: cuts the
    lineage, and lost executors cost a re-read only."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Working column names that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
