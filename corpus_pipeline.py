"""Training-data pipeline over ``documents``.

Quality rules drop rejected documents, the n-gram Jaccard join keeps one
document of each near-duplicate group, documents with a benchmark passage go,
sources are mixed to their target weights (a document comes as often as the mix
takes it), and the rest is dealt into shards of exact sizes. Every stage reads
what its predecessor wrote, and working tables and earlier results are deleted as
soon as nothing reads them.

Rows: null and empty texts are rejected by the quality rules; an empty table
passes through; extra columns are kept by every stage, and one named ``shard`` or
``slot`` is replaced by the last. Of equal or repeated rows the join keeps one; the
mix may take it up to three times, and the shards part its copies. Ties (equal ids
or hashes) follow the operators. A very long text must fit a task, like any row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recflow.llm import decontaminate, mixing, ngram_join, quality_rules, sharding
from recflow.llm.common import table
from recflow.session import release, released, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_quality(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_component(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_taken(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Components of the join and sketch-based limits are beyond plain SQL; the
#: pipeline is tested against a brute-force version in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with released(spark):  # working tables go once the stage's result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            release(spark, [before])
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
