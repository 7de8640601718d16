
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recflow import session
from recflow.functions.ordering import tag_range_partitions
from recflow.operators import cf, ope, ranking, recommend, sequence, splits, traj
from recflow.plans import common as C
from recflow.plans.queries import QUERIES


def test_split_partitions_input_and_respects_time(spark, sf_small):
    r = C.ratings(spark, sf_small)
    s = splits.temporal_split(r, 0.8)
    assert s.count() == r.count() == 5986
    assert s.filter("part = 'train'").count() == 4730
    seq = splits.sequence_numbered(r)
    j = s.join(seq, ["user_id", "item_id", "rating", "ts"])
    agg = j.groupBy("user_id").agg(
        F.max(F.when(F.col("part") == "train", F.col("rn"))).alias("last_train"),
        F.min(F.when(F.col("part") == "test", F.col("rn"))).alias("first_test"))
    assert agg.filter("first_test IS NOT NULL AND last_train >= first_test").count() == 0


def test_window_counts_add_up(spark, sf_small):
    r = C.ratings(spark, sf_small)
    total = splits.window_stats(r, 4).agg(F.sum("n_ratings")).first()[0]
    assert total == r.count()


def test_state_shift_property(spark, sf_small):
    t = traj.build_trajectories(C.train(spark, sf_small), 10)
    assert t.count() == 3250
    bad = t.filter(
        (F.size("state_item_ids") != 10)
        | (F.slice("next_state_item_ids", 1, 9) != F.slice("state_item_ids", 2, 9))
        | (F.element_at("next_state_item_ids", -1) != F.col("action_item_id")))
    assert bad.count() == 0


def test_similarity_symmetric_and_bounded(spark, sf_small):
    sims = cf.similarities(cf.centered(C.ratings(spark, sf_small)), 1)
    row = sims.agg(F.min("sim"), F.max("sim"), F.count(F.lit(1))).first()
    assert row[0] >= -1 - 1e-9 and row[1] <= 1 + 1e-9 and row[2] == 19823
    assert sims.filter("item_a >= item_b").count() == 0


def test_chunked_pairs_equal_plain_pairs(spark, sf_small):
    cen = cf.centered(C.ratings(spark, sf_small))
    plain = cf.pair_aggregates(cen, chunk_size=1_000_000)
    chunked = cf.pair_aggregates(cen, chunk_size=7)
    a = {(r.item_a, r.item_b): (round(r.dot, 9), r.co) for r in plain.collect()}
    b = {(r.item_a, r.item_b): (round(r.dot, 9), r.co) for r in chunked.collect()}
    assert a == b
    parts = cf.pair_aggregates(cen, chunk_size=7, item_raters=2, min_co=2)
    c = {(r.item_a, r.item_b): (round(r.dot, 9), r.co) for r in parts.collect()}
    assert c == {p: v for p, v in a.items() if v[1] >= 2} and c
    users = {}
    for r in cen.collect():
        users.setdefault(r.user_id, []).append((r.item_id, r.centered))
    brute = {}
    for u in users.values():
        for i, x in u:
            for j, y in u:
                if i < j:
                    dot, co = brute.get((i, j), (0.0, 0))
                    brute[i, j] = (dot + x * y, co + 1)
    assert a == {p: (round(d, 9), n) for p, (d, n) in brute.items()}


def test_pairs_are_shuffled_packed(spark, sf_small):
    """One shuffled row per user and item, and no row of a pair before the last exchange."""
    cen = cf.centered(C.ratings(spark, sf_small))
    rows = cf.co_rated(cen, 3)
    assert rows.count() <= cen.count()
    assert rows.select(F.sum(F.size("rest"))).first()[0] > rows.count()
    plan = cf.pair_aggregates(cen, min_co=3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline(rest") < plan.index("REPARTITION_BY_NUM")


def test_shuffled_packs_are_plain_arrays(spark, sf_small):
    """No array of structs crosses the exchange: two arrays of numbers take half its bytes."""
    cen = cf.centered(C.ratings(spark, sf_small))
    plan = cf.pair_aggregates(cen, min_co=3)._jdf.queryExecution().executedPlan().toString()
    sent = plan[plan.index("REPARTITION_BY_NUM"):].splitlines()[1]
    assert "item_b AS _ids" in sent and "c_b AS _values" in sent and sent.count(",") == 4, sent


def test_ndcg_bounded_in_user_mode(spark, sf_small):
    tr, te = C.train(spark, sf_small), C.test(spark, sf_small)
    recs = recommend.popularity_recommend(tr, te.select("user_id").distinct(), 20)
    m = ranking.user_metrics(recs, te, (5, 10, 20))
    row = m.agg(F.min("ndcg_20"), F.max("ndcg_20")).first()
    assert 0 <= row[0] and row[1] <= 1 + 1e-12


def test_popularity_excludes_seen_and_fills_k(spark, sf_small):
    tr, te = C.train(spark, sf_small), C.test(spark, sf_small)
    users = te.select("user_id").distinct()
    recs = recommend.popularity_recommend(tr, users, 20)
    assert recs.join(tr, ["user_id", "item_id"], "left_semi").count() == 0
    assert recs.groupBy("user_id").count().filter("count <> 20").count() == 0


def test_ope_identities_on_test_part(spark, sf_small):
    te = C.test(spark, sf_small)
    est = {r.estimator: r.value for r in ope.estimates(te).collect()}
    m = ope.item_models(te)
    sum_means = m.agg(F.sum("mean_reward")).first()[0]
    assert est["ips_raw"] == pytest.approx(sum_means)
    assert est["v_dr"] == pytest.approx(est["actual_avg"])


def test_csv_roundtrip_of_items_with_commas(spark, tmp_path):
    from recflow.sources import csv_io
    items = spark.createDataFrame([(1, 'Heat, The (1995)', "Action|Crime", "x"),
                                   (2, 'Say "Hi" (2001)', "Comedy", "y")],
                                  "item_id long, title string, genres string, category string")
    path = str(tmp_path / "items")
    csv_io.write_csv(items, path)
    back = csv_io.read_items_csv(spark, path)
    assert sorted(back.collect()) == sorted(items.collect())


def test_every_query_has_an_oracle():
    from recflow.plans.oracle import ORACLE
    assert set(QUERIES) <= set(ORACLE)


def _sorted_rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def _hot_user_rows(spark):
    """One user holds a third of all rows, with many equal times."""
    rows = [(7, i * 7919 % 1009, float(i % 10) / 2 + 0.5, 1000 + i // 3) for i in range(1500)]
    rows += [(100 + i % 150, i, float(i % 10) / 2 + 0.5, 5000 - i) for i in range(3000)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")


def test_numbering_of_a_hot_user_is_balanced_and_right(spark):
    df = _hot_user_rows(spark).repartition(5)
    w = Window.partitionBy("user_id").orderBy("ts", "item_id", "rating")
    want = df.withColumn("rn", F.row_number().over(w).cast("bigint")) \
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user_id")))
    got = sequence.numbered(df, ["user_id"], num_partitions=9)
    assert _sorted_rows(got) == _sorted_rows(want.select(*got.columns))
    # the rows of a (user, range partition), the unit a window holds, are a
    # ninth of the table give or take the sampling of range bounds
    tagged = tag_range_partitions(df, ["user_id", "ts", "item_id", "rating"], 9)
    largest = tagged.groupBy("user_id", "_pid").count().agg(F.max("count")).first()[0]
    assert largest <= 4500 // 9 * 2


def test_blocked_frames_equal_one_block(spark):
    df = _hot_user_rows(spark)
    one = traj.build_trajectories(df, 10)
    for rows in (11, 64, 1000):
        assert _sorted_rows(traj.build_trajectories(df, 10, block_rows=rows)) == _sorted_rows(one)
    keyed = df.withColumn("round", F.lit(1))
    assert _sorted_rows(traj.build_trajectories(keyed, 4, keys=("round",), block_rows=12)) == \
        _sorted_rows(traj.build_trajectories(keyed, 4, keys=("round",)))


def test_split_keeps_the_order_of_each_part(spark):
    df = _hot_user_rows(spark)
    kept = splits.temporal_split(df, 0.8, keep_order=True)
    train = splits.train_part(kept)
    again = sequence.numbered(train.drop("rn", "n"), ["user_id"])
    assert _sorted_rows(train.select(*again.columns)) == _sorted_rows(again)


def test_tiled_prediction_join_equals_plain_join(spark, sf_small):
    cen = cf.centered(C.ratings(spark, sf_small, staged=False)).cache()
    sims = cf.similarities(cen, 1).cache()

    def rounded(df):
        return sorted((r.user_id, r.item_id, round(r.score, 6), round(r.evidence, 6), r.rank)
                      for r in df.collect())
    assert rounded(cf.recommend(cen, sims, 20)) == rounded(cf.recommend(cen, sims, 20, tile=3))
    cen.unpersist()
    sims.unpersist()


def test_scratch_is_released_after_the_block(spark, sf_small):
    import glob
    base = session.checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{base}/*"))
    with session.released(spark):
        C.reset_stages()
        assert C.train(spark, sf_small).count() == 4730
        assert set(glob.glob(f"{base}/*")) - before
    assert not set(glob.glob(f"{base}/*")) - before
    C.reset_stages()


def test_missing_titles_get_a_name(spark):
    items = spark.createDataFrame([(1, "A"), (2, None)], "item_id long, title string")
    got = cf.with_titles(spark.createDataFrame([(1,), (2,), (3,)], "item_id long"), items, "item_id")
    assert sorted(r.item_id_title for r in got.collect()) == ["A", "Item 2", "Item 3"]


def test_prediction_blocks_equal_brute_force_and_ship_no_terms(spark):
    """Users x items cells are summed where the two tables meet: exact for any block size,
    with duplicate ratings, negative and missing similarities, keys and a dense user."""
    rnd = random.Random(3)
    rows = [(g, u, i, rnd.randrange(1, 11) / 2.0, u + i) for g in (1, 2) for u in range(80)
            for i in (range(30) if u == 7 else rnd.sample(range(40), 8)) for _ in range(rnd.choice((1, 1, 2)))]
    rows += [(1, 500, 900, 3.0, 1), (1, 501, 3, None, 1), (1, None, 3, 2.0, 1), (1, 3, None, 2.0, 1)]
    df = spark.createDataFrame(rows, "g int, user_id long, item_id long, rating double, ts long")
    cen = cf.centered(df, ("g",)).cache()
    sims = cf.similarities(cen, 1, keys=("g",)).cache()
    near = {}
    for r in sims.collect():
        if r.sim is not None:
            near.setdefault((r.g, r.item_a), []).append((r.item_b, r.sim))
            near.setdefault((r.g, r.item_b), []).append((r.item_a, r.sim))
    want, all_cen = [], cen.collect()
    for g, u in {(r.g, r.user_id) for r in all_cen}:
        mine = [r for r in all_cen if (r.g, r.user_id) == (g, u)]
        e, s = {}, {}
        for r in mine:
            if r.rating is not None and r.rating >= r.user_mean:
                for j, x in near.get((g, r.item_id), ()):
                    e[j], s[j] = e.get(j, 0.0) + x, s.get(j, 0.0) + x * r.rating
        seen = {r.item_id for r in mine}
        found = sorted((-math.floor(s[j] / e[j] * 1e9 + 0.5), j) for j in e
                       if j not in seen and math.floor(e[j] * 1e9 + 0.5) > 0)[:5]
        want += [(g, u, j, n + 1) for n, (_, j) in enumerate(found)]
    for tile in (4096, 1):
        got = cf.recommend(cen, sims, 5, ("g",), tile)
        assert sorted((r.g, r.user_id, r.item_id, r["rank"]) for r in got.collect()) == sorted(want), tile
    plan = got._jdf.queryExecution().executedPlan().toString()
    # no join of ratings with similarities, so no row per term, and no aggregate per cell
    assert "FlatMapCoGroupsInPandas" in plan and "Join" not in plan.split("FlatMapCoGroupsInPandas")[0]
    cen.unpersist()
    sims.unpersist()
