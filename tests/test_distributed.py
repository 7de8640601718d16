"""Distributed building blocks against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recflow import session
from recflow.functions.ordering import global_row_number, keyed_row_number
from recflow.operators import knn, recommend, splits
from recflow.plans import common as C
from recflow.sources import csv_io


def test_global_row_number_matches_single_window(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"), F.col("id").alias("b"))
    got = {(r.a, r.b): r.pos for r in global_row_number(df, ["a", "b"], "pos", 7).collect()}
    want = {(r.a, r.b): r.pos for r in df.withColumn(
        "pos", F.row_number().over(Window.orderBy("a", "b"))).collect()}
    assert got == want


def test_keyed_row_number_matches_partitioned_window(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 1000).alias("v"),
                                     F.col("id"))
    got = {r.id: r.pos for r in keyed_row_number(df, ["k"], ["v", "id"], "pos").collect()}
    want = {r.id: r.pos for r in df.withColumn(
        "pos", F.row_number().over(Window.partitionBy("k").orderBy("v", "id"))).collect()}
    assert got == want


def test_blocked_topk_matches_numpy(spark):
    rng = np.random.default_rng(7)
    items = rng.normal(size=(300, 8))
    queries = rng.normal(size=(40, 8))
    idf = spark.createDataFrame([(i, items[i].tolist()) for i in range(300)], "item_id long, vec array<double>")
    qdf = spark.createDataFrame([(1000 + q, queries[q].tolist()) for q in range(40)],
                                "query_id long, vec array<double>")
    cand = knn.blocked_topk(qdf, idf, 5, query_block_rows=7, item_block_rows=50)
    got = {}
    for r in knn.rank_candidates(cand, 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.item_id))
    un = items / np.linalg.norm(items, axis=1, keepdims=True)
    for q in range(40):
        s = un @ (queries[q] / np.linalg.norm(queries[q]))
        order = np.lexsort((np.arange(300), -np.floor(s * 1e9 + 0.5)))[:5]
        assert [i for _, i in sorted(got[1000 + q])] == order.tolist()


def test_clustered_search_prunes_and_stays_exact(spark):
    """Clusters, copies, zero vectors and depths that differ; few pairs are scored."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 10))
    items = np.vstack([centres[i % 12] + 0.15 * rng.normal(size=10) for i in range(1500)]
                      + [centres[3]] * 100 + [np.zeros(10)] * 2)
    queries = np.vstack([centres[i % 5] + 0.15 * rng.normal(size=10) for i in range(60)] + [np.zeros(10)])
    depth = [5 + 3 * (i % 4) for i in range(61)]
    idf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "item_id long, vec array<double>")
    qdf = spark.createDataFrame([(i, v.tolist(), depth[i]) for i, v in enumerate(queries)],
                                "query_id long, vec array<double>, depth long").where("query_id < 60")
    index = knn.ClusteredItems(idf, page_rows=40)
    got = {}
    for r in knn.rank_candidates(index.search(qdf, pack_rows=7), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.item_id))
    un = items / np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-300)
    for q in range(60):
        s = un @ (queries[q] / np.linalg.norm(queries[q]))
        order = np.lexsort((np.arange(len(items)), -np.floor(s * 1e9 + 0.5)))[:depth[q]]
        assert [i for _, i in sorted(got[q])][:depth[q]] == order.tolist()
    assert index.scored_pairs() < 0.3 * 60 * len(items)
    zero = spark.createDataFrame([(60, queries[60].tolist(), 3)], "query_id long, vec array<double>, depth long")
    assert sorted(r.item_id for r in knn.rank_candidates(index.search(zero), 3).collect()) == [0, 1, 2]
    none = knn.ClusteredItems(idf.where("item_id < 0"))
    assert none.search(qdf).count() == 0


def test_rank_probe_recommender_matches_brute_force(spark, sf_small):
    tr, te = C.train(spark, sf_small, staged=False), C.test(spark, sf_small, staged=False)
    users = te.select("user_id").distinct()
    got = {(r.user_id, r.rank): r.item_id
           for r in recommend.popularity_recommend(tr, users, 10).collect()}
    counts = {r.item_id: r.n for r in tr.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(counts, key=lambda i: (-counts[i], i))
    seen = {}
    for r in tr.select("user_id", "item_id").collect():
        seen.setdefault(r.user_id, set()).add(r.item_id)
    for u in [r.user_id for r in users.collect()]:
        want = [i for i in order if i not in seen.get(u, set())][:10]
        assert [got[(u, k)] for k in range(1, len(want) + 1)] == want


def test_packs_grow_and_their_groups_prune_apart(spark, monkeypatch):
    """Pages reach a few large packs; what a group scores is what it needs alone."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 8))
    items = np.vstack([centres[i % 10] + 0.1 * rng.normal(size=8) for i in range(1200)])
    queries = np.vstack([centres[i % 10] + 0.1 * rng.normal(size=8) for i in range(200)])
    idf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "item_id long, vec array<double>")
    qdf = spark.createDataFrame([(i, v.tolist(), 4 + i % 3) for i, v in enumerate(queries)],
                                "query_id long, vec array<double>, depth long")
    monkeypatch.setattr(knn, "PACKS", 2)
    monkeypatch.setattr(knn, "GROUP", 10)
    index = knn.ClusteredItems(idf, page_rows=30)
    got = {}
    for r in knn.rank_candidates(index.search(qdf), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.item_id))
    un = items / np.linalg.norm(items, axis=1, keepdims=True)
    for q in range(200):
        s = un @ (queries[q] / np.linalg.norm(queries[q]))
        order = np.lexsort((np.arange(1200), -np.floor(s * 1e9 + 0.5)))[:4 + q % 3]
        assert [i for _, i in sorted(got[q])][:4 + q % 3] == order.tolist()
    assert index.visits[0].count() <= 3
    assert index.scored_pairs() < 0.4 * 200 * 1200


def test_copies_of_a_ranked_list_are_never_broadcast(spark):
    ranking = spark.range(50).selectExpr("id AS item_id", "id + 1 AS list_rank")
    users = spark.range(7).selectExpr("id AS user_id")
    seen = users.selectExpr("user_id", "user_id AS item_id")
    recs = recommend.recommend_from_ranking(ranking, users, seen, 3)
    p = recs._jdf.queryExecution().executedPlan().toString()
    probe = next(line for line in p.splitlines() if "Join [list_rank" in line)
    assert "SortMergeJoin" in probe, probe
    got = {(r.user_id, r.rank): r.item_id for r in recs.collect()}
    assert got == {(u, k + 1): i for u in range(7) for k, i in enumerate([i for i in range(4) if i != u][:3])}


def test_window_metadata_json_roundtrip(spark, sf_small, tmp_path):
    stats = splits.window_stats(C.ratings(spark, sf_small, staged=False), 4)
    path = str(tmp_path / "windows")
    csv_io.write_json(stats, path)
    back = csv_io.read_json(spark, path, stats.schema)
    assert sorted(back.collect()) == sorted(stats.collect())


def test_knn_scoring_ships_without_the_package(tmp_path):
    """Python workers need not have recflow on their path: the cogroup
    function must unpickle in a bare interpreter."""
    import subprocess
    import sys as _sys

    from pyspark import cloudpickle
    blob = cloudpickle.dumps(knn._score(2))
    code = ("import pickle, sys; import numpy as np, pandas as pd; f = pickle.loads(sys.stdin.buffer.read()); "
            "b = lambda x, t: np.array(x, t).tobytes(); "
            "q = pd.DataFrame({'ids': [b([1], 'int64')], 'vecs': [b([1.0, 0.0], float)], "
            "'depth': [b([1], 'int64')], 'low': [b([-1.5], float)], 'exclude_self': [False]}); "
            "i = pd.DataFrame({'page_ids': [b([5, 6], 'int64')], 'page_vecs': [b([0.0, 1.0, 1.0, 0.1], float)]}); "
            "print(int(f(q, i).item_id.iloc[0]))")
    out = subprocess.run([_sys.executable, "-c", code], input=blob, capture_output=True,
                         cwd=str(tmp_path), env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert out.returncode == 0, out.stderr.decode()[-500:]
    assert out.stdout.decode().strip() == "6"


def test_ordered_trajectory_files(spark, sf_small, tmp_path):
    from recflow.operators import traj
    t = traj.build_trajectories(C.train(spark, sf_small, staged=False), 10)
    path = str(tmp_path / "traj")
    traj.write_trajectories(t, path, 3)
    back = spark.read.parquet(path)
    assert back.count() == 3250
    # inside every file the rows come in (user_id, rn) order
    rows = back.withColumn("_f", F.input_file_name()).select("_f", "user_id", "rn").collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r._f, []).append((r.user_id, r.rn))
    for keys in by_file.values():
        assert keys == sorted(keys)


def test_ordered_files_sort_packs_not_rows(spark, tmp_path):
    """Files hold all rows in order with any sizes of ranges and packs; the last sort, whose
    input is a whole file, has compressed packs and no row."""
    from recflow.operators import traj
    rows = [(u, i, i % 10 / 2.0, i) for u in range(40) for i in range(900 if u == 3 else 30)]
    t = traj.build_trajectories(spark.createDataFrame(
        rows, "user_id long, item_id long, rating double, ts long"), 10)
    t = t.withColumn("note", F.when(F.col("rn") % 2 == 0, F.lit("x"))).persist()
    want = sorted(t.collect())
    for sizes in ((262_144, 1_024), (100, 7)):
        done = traj.ordered(t, 4, *sizes)
        assert done.schema == t.schema
        path = str(tmp_path / f"files{sizes[1]}")
        done.write.parquet(path)
        back = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("f"),
                                               F.col("_metadata.row_index").alias("i")).collect()
        files = sorted(([r[:-2] for r in sorted(back, key=lambda r: r.i) if r.f == f] for f in {r.f for r in back}),
                       key=lambda x: x[0][:2])
        assert len(files) == 4 and [r for f in files for r in f] == [tuple(r) for r in want]
        assert max(map(len, files)) < len(want) / 2
        last = done._jdf.queryExecution().optimizedPlan().toString()
        assert last.index("MapInArrow") < last.index("Sort [_at") and "state_item_ids" not in last.split("Sort [_at")[1]
    packs = spark.read.parquet([f for f in session._written() if "/packs-" in f][-2])
    raw = t.select(F.sum(F.lit(8 * (4 * 10 + 6)))).first()[0]
    assert packs.select(F.sum(F.length("pack"))).first()[0] < raw / 4
    t.unpersist()


def test_round_tables_written_partitioned_and_pruned(spark, sf_small, tmp_path):
    rounds = splits.backtest_rounds(C.ratings(spark, sf_small, staged=False), 4)
    path = str(tmp_path / "rounds")
    csv_io.write_parquet(rounds, path, partition_by=("round", "part"))
    back = spark.read.parquet(path)
    r1 = back.filter((F.col("round") == 1) & (F.col("part") == "test"))
    plan = r1._jdf.queryExecution().executedPlan().toString()
    pf = plan[plan.index("PartitionFilters: ["):]
    pf = pf[:pf.index("]")]
    assert "round" in pf and "part" in pf
    assert r1.count() == rounds.filter("round = 1 AND part = 'test'").count()
    assert back.count() == rounds.count()
