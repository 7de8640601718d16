
from pyspark.sql import functions as F

from recflow.operators import features, traj
from recflow.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbered_trajectories_use_one_exchange_and_one_frame(spark, tmp_path):
    rows = [(u, i, 3.0, i, i + 1, 30) for u in range(5) for i in range(30)]
    path = str(tmp_path / "r")
    spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long, rn long, n long") \
        .write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(traj.build_trajectories(spark.read.parquet(path), 10))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 1 and p.count("Window [") == 1


def test_item_features_scan_items_once_for_rows(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.createDataFrame([(1, "A (1990)", "x|y"), (2, "B", "y")],
                          "item_id long, title string, genres string").write.parquet(path)
    r = spark.createDataFrame([(1, 1, 3.0, 5), (1, 2, 4.0, 6)],
                              "user_id long, item_id long, rating double, ts long")
    df = features.item_features(spark.read.parquet(path), r, ("x", "y"))
    p = plan(df)
    # one scan for the rows, one for the median year (a scalar subquery)
    assert p.count("FileScan") <= 2 and df.count() == 2


def test_split_parts_are_pruned(spark, sf_small):
    from recflow.plans import common as C
    C.reset_stages()
    p = plan(C.train(spark, sf_small))
    pf = p[p.index("PartitionFilters: ["):]
    assert "part" in pf[:pf.index("]")]


def test_sequences_are_numbered_once_from_staged_ratings(spark, sf_small):
    from recflow import session
    from recflow.plans import common as C
    for name in ("traj_indexed_unknown", "traj_index_inverse", "traj_build"):
        start = len(session._written())
        QUERIES[name](spark, sf_small)
        wrote = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._written()[start:]]
        # the range sample and the rows both read the filtered ratings as written
        assert wrote.count("sequence") == 1 and wrote.count("cold_start") == 1, (name, wrote)
    C.reset_stages()


def test_top_category_zips_its_pairs_once(spark):
    import random
    from recflow.operators import policy
    rnd = random.Random(3)
    rows = [([rnd.randrange(1, 11) / 2 for _ in range(n)], [rnd.choice("abcde") for _ in range(n)])
            for n in (1, 2, 10, 10, 10, 10, 10, 10)]
    df = spark.createDataFrame(rows, "r array<double>, c array<string>").select(
        "r", "c", policy.top_category(F.col("r"), F.col("c")).alias("top"))
    p = df._jdf.queryExecution().analyzed().toString()
    assert p.count("arrays_zip") == 1 and p.index("arrays_zip") < p.index("array_distinct")
    for r, c, top in df.collect():
        mean = {x: sum(a for a, b in zip(r, c) if b == x) / c.count(x) for x in c}
        assert top == min(mean, key=lambda x: (-mean[x], x))


def test_percent_rank_has_no_row_level_single_partition(spark):
    stats = spark.createDataFrame([(i, i % 7) for i in range(200)], "item_id long, rating_count long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(features.item_popularity(stats))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # single-partition exchanges only ever carry aggregated rows (the
    # histogram of counts and the one-row total), never item rows
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1], lines[i:i + 2]
    assert "percent_rank" not in p


def test_no_python_udf_outside_vector_search(spark, sf_small):
    for name, fn in QUERIES.items():
        if name in ("vec_topk", "rec_content_knn", "src_csv_roundtrip"):
            continue
        p = plan(fn(spark, sf_small))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
