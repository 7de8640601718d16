"""The pipeline against a brute-force version of its stages."""

from collections import Counter, defaultdict

import corpus_pipeline
from recflow.llm import quality_rules
from test_operators import decontaminate_brute, join_brute, quality_brute, words


def test_stages_follow_brute_force(spark, docs, rows, tmp_path):
    bench = [(1, rows[15][1]), (2, "one two")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    src = spark.read.parquet(str(tmp_path / "documents.parquet"))
    good = stages["quality_rules"](spark, src, str(tmp_path))
    kept = [tuple(r) for r in good.collect()]
    # the base rules hold, and no clean document of this small table is an outlier
    assert Counter(kept) == Counter(r for r in rows if not quality_brute(r[1])[-1])
    one = [tuple(r) for r in stages["ngram_jaccard_join"](spark, good, str(tmp_path)).collect()]
    want = {c for *_, c in join_brute(kept)}
    assert sorted(map(str, (r[0] for r in one))) == sorted(map(str, want))
    clean = stages["benchmark_decontamination"](
        spark, spark.createDataFrame(one, docs.schema), str(tmp_path))
    hits = [h for _, h, _ in decontaminate_brute([r[1] for r in one], bench)]
    left = [tuple(r) for r in clean.collect()]
    assert Counter(left) == Counter(r for r, h in zip(one, hits) if not h) and any(hits)
    mixed = [tuple(r) for r in stages["mixing"](spark, clean, str(tmp_path)).collect()]
    assert set(mixed) <= set(left) and max(Counter(mixed).values()) <= 3
    final = stages["sharding"](spark, spark.createDataFrame(mixed, docs.schema), str(tmp_path)).collect()
    by = defaultdict(list)
    for r in final:
        by[r.shard].append(r.slot)
    assert Counter(tuple(r)[:6] for r in final) == Counter(mixed)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.columns == [*docs.columns, "shard", "slot"] and whole.count() == len(mixed)


def test_empty_table_passes(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names_and_words():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    assert words(" a  b ") == ["a", "b"] and quality_rules.MIN_WORDS == 50
