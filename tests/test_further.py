"""k-core, exact-size samples, rounds from window counts, sketches, target-user CF and the
window stream against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from frames import frame
from recflow.operators import cf, kcore, quantiles, rounds, sampling, splits
from recflow.session import scratch_path
from recflow.streaming import windows


def ratings_of(seed, n, users, items, span=1000):
    rnd = random.Random(seed)
    # one user holds a third of the rows
    return [(0 if rnd.random() < 0.33 else rnd.randrange(users), rnd.randrange(items),
             rnd.randrange(1, 11) / 2, rnd.randrange(span)) for _ in range(n)]


def core_brute(rows, min_item, min_user):
    while True:
        items, users = {}, {}
        for u, i, *_ in rows:
            items[i], users[u] = items.get(i, 0) + 1, users.get(u, 0) + 1
        left = [r for r in rows if items[r[1]] >= min_item and users[r[0]] >= min_user]
        if len(left) == len(rows):
            return sorted(left)
        rows = left


@pytest.mark.parametrize("seed,min_item,min_user", [(1, 4, 5), (2, 5, 6), (3, 50, 50)])
def test_k_core_peels_until_nothing_falls(spark, seed, min_item, min_user):
    rows = ratings_of(seed, 240, 40, 40)
    out = kcore.k_core(frame(spark, rows), min_item, min_user).collect()
    assert sorted(tuple(r) for r in out) == core_brute(rows, min_item, min_user)


def test_k_core_follows_a_long_chain(spark):
    # user u rates items u and u + 1; item 0 has one rating, so the whole chain unravels
    rows = [(u, i, 3.0, u) for u in range(6) for i in (u, u + 1)]
    assert kcore.k_core(frame(spark, rows), 2, 2).count() == 0
    ring = [(u, i % 6, 3.0, u) for u in range(6) for i in (u, u + 1)]
    assert kcore.k_core(frame(spark, ring), 2, 2).count() == 12


def test_k_core_nulls_repeats_empty_and_extra_columns(spark):
    schema = "user_id long, item_id long, rating double, ts long, n long, gone string"
    rows = [(1, 1, 3.0, 1, 7, "a")] * 3 + [(None, 1, 3.0, 1, 7, "a"), (1, None, 3.0, 1, 7, "a")]
    out = kcore.k_core(frame(spark, rows, schema), 3, 3)
    assert out.columns == ["user_id", "item_id", "rating", "ts", "n", "gone"] and out.count() == 3
    assert kcore.k_core(frame(spark, [], schema), 3, 3).count() == 0


def sample_brute(rows, n, seed):
    return sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}:{r[1]}:{seed}".encode()).hexdigest(), r))[:n]


@pytest.mark.parametrize("n", [0, 1, 17, 500, 501])
@pytest.mark.parametrize("ordered", [1, 10_000])
def test_hash_sample_is_the_top_n_by_hash(spark, n, ordered):
    rows = [(i % 37, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = sampling.hash_sample(df, n, ("a", "b"), 42, ordered).collect()
    assert sorted(tuple(r) for r in got) == sorted(sample_brute(rows, n, 42))


def test_hash_sample_of_repeated_rows_has_its_size(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(2,)] * 50, "a long")
    assert sampling.hash_sample(df, 70, ("a",), 1, 5).count() == 70
    assert sampling.hash_sample(df.limit(0), 70, ("a",), 1).count() == 0


def test_round_progress_equals_counts_over_copied_rounds(spark):
    rows = ratings_of(5, 900, 60, 30)
    df = frame(spark, rows)
    n, k = 5, 4
    copied = splits.backtest_rounds(df, n)
    want = {r["round"]: r.asDict() for r in splits.round_eligibility(copied, k).collect()}
    test = {r["round"]: (r["n"], r["u"]) for r in copied.where("part = 'test'").groupBy("round").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("u")).collect()}
    steps = {r["round"]: r["t"] for r in copied.where("part = 'train'").groupBy("round", "user_id").count()
             .groupBy("round").agg(F.sum(F.greatest(F.col("count") - k, F.lit(0))).alias("t")).collect()}
    for r in rounds.round_progress(splits.assign_windows(df, n), n, k).collect():
        w = want[r["round"]]
        assert (r.train_rows, r.train_users, r.eligible) == (w["train_rows"], w["train_users"], w["eligible"])
        assert (r.test_rows, r.test_users) == test[r["round"]] and r.train_trajectories == steps[r["round"]]


def test_round_progress_lists_empty_windows(spark):
    df = frame(spark, [(1, 1, 3.0, 0), (2, 1, 3.0, 0), (1, 2, 3.0, 100)])
    out = {r["round"]: r for r in rounds.round_progress(splits.assign_windows(df, 4), 4, 1).collect()}
    assert sorted(out) == [1, 2, 3]
    assert (out[1].test_rows, out[2].test_users, out[3].test_rows) == (0, 0, 1)
    assert (out[3].train_rows, out[3].train_users, out[3].train_trajectories) == (2, 2, 0)


def test_rounds_copy_no_rating_row(spark, tmp_path):
    path = str(tmp_path / "r")
    splits.assign_windows(frame(spark, ratings_of(6, 300, 20, 20)), 4).write.parquet(path)
    plan = rounds.round_progress(spark.read.parquet(path), 4, 10)._jdf.queryExecution().executedPlan().toString()
    # counts per (user, window) and then per user are exchanged, after a partial aggregate
    assert "Generate" not in plan and plan.count("hashpartitioning(user_id") == 2
    assert plan.count("partial_count(1)") >= 1


def test_merged_sketches_keep_ranks(spark):
    rows = [(i % 7, float((i * 7919) % 20011)) for i in range(20011)]
    df = spark.createDataFrame(rows + [(0, None), (1, float("nan"))], "part long, v double")
    parts = quantiles.sketches(df, "v", ("part",))
    whole = quantiles.merged(parts)
    assert whole.first().n == 20011
    for r in quantiles.quantiles(whole, (0.01, 0.5, 0.99)).collect():
        assert abs(r.value / 20011 - r.p) < 0.02
    assert quantiles.quantiles(quantiles.merged(quantiles.sketches(df.limit(0), "v")), (0.5,)).count() == 0


def test_round_sketches_cover_the_train_windows(spark):
    df = splits.assign_windows(frame(spark, ratings_of(7, 4000, 50, 30)), 4)
    sk = {r["round"]: r["n"] for r in quantiles.round_sketches(df, "ts", 4).collect()}
    per = {r["window_id"]: r["count"] for r in df.groupBy("window_id").count().collect()}
    assert sk == {1: per[0], 2: per[0] + per[1], 3: per[0] + per[1] + per[2]}


def test_rank_check_refuses_a_wrong_quantile(spark):
    rows = spark.range(1000).select(F.lit(0).alias("g"), F.col("id").alias("v"))
    found = spark.createDataFrame([(0, 0.5, 1000, 500.0), (0, 0.9, 1000, 500.0)],
                                  "g int, p double, n long, value double")
    ok = {r.p: r.ok for r in quantiles.rank_within(rows, "v", found, 0.02, ("g",)).collect()}
    assert ok == {0.5: 1, 0.9: 0}


def test_target_recommendations_equal_those_over_all_pairs(spark):
    cen = cf.centered(frame(spark, ratings_of(8, 400, 25, 30)))
    users = spark.createDataFrame([(0,), (3,), (3,), (11,), (999,), (None,)], "user_id long")
    want = cf.recommend(cen, cf.similarities(cen, 1), 5).where("user_id IN (0, 3, 11)").collect()
    got = cf.recommend_for(cen, users, 5).collect()
    key = lambda r: (r.user_id, r["rank"])
    assert [(key(r), r.item_id) for r in sorted(got, key=key)] == [(key(r), r.item_id)
                                                                   for r in sorted(want, key=key)]
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a.score == pytest.approx(b.score, rel=1e-6) and a.evidence == pytest.approx(b.evidence)


def arrive(spark, rows, source):
    spark.createDataFrame(rows, "user_id long, ts long").coalesce(1).write.mode("append").parquet(source)


def test_stream_goes_on_where_it_stopped_and_leaves_out_late_rows(spark):
    source, out, state = (scratch_path(spark, x) for x in ("arrivals", "closed", "state"))
    run = lambda: windows.stream_window_counts(spark, source, out, 0, 400, 4, 1, state)
    arrive(spark, [(1, 5), (1, 6), (2, 99), (None, 7), (3, None)], source)
    arrive(spark, [(1, 100), (70_000, 150)], source)
    run()
    arrive(spark, [(5, 210)], source)
    arrive(spark, [(5, 400), (6, 400)], source)
    run()
    arrive(spark, [(9, 10)], source)      # window 0 is closed: late
    windows.closing_file(spark, source, 0, 400, 4)
    run()
    got = windows.streamed_window_stats(spark, out, 0, 400, 4).orderBy("window_id").collect()
    assert [(r.n_ratings, r.n_users) for r in got] == [(3, 2), (2, 2), (1, 1), (2, 2)]
    assert (got[3].t_start, got[3].t_end) == (300.0, 400.0)
