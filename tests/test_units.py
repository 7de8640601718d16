"""Hand-made frames with results computed by hand (FIXTURES.md section 6)."""

import math

import pytest
from pyspark.sql import functions as F

from frames import frame
from recflow.operators import cf, features, ope, policy, ranking, splits, traj


def test_k_edges_trajectory_cutoff(spark):
    K = 3
    rows = []
    for user, n in ((1, K), (2, K + 1), (3, K + 2)):
        rows += [(user, 100 + i, 1.0 + 0.5 * i, 1000 + i) for i in range(n)]
    out = traj.build_trajectories(frame(spark, rows), K).collect()
    per_user = {}
    for r in out:
        per_user.setdefault(r.user_id, []).append(r)
    assert 1 not in per_user
    assert len(per_user[2]) == 1 and len(per_user[3]) == 2
    r = per_user[3][1]
    assert r.rn == K + 2 and r.total_ratings == K + 2
    assert r.state_item_ids == [101, 102, 103]
    assert r.next_state_item_ids == [102, 103, 104]
    assert r.action_item_id == 104 and r.reward == 3.0


def test_ties_are_split_by_item_then_rating(spark):
    rows = [(1, 9, 2.0, 50), (1, 3, 4.0, 50), (1, 3, 1.0, 50), (1, 7, 5.0, 50)]
    out = splits.sequence_numbered(frame(spark, rows)).orderBy("rn").collect()
    assert [(r.item_id, r.rating) for r in out] == [(3, 1.0), (3, 4.0), (7, 5.0), (9, 2.0)]


def test_single_rating_item_has_zero_std(spark):
    rows = [(1, 5, 3.0, 1), (2, 6, 4.0, 2), (3, 6, 5.0, 3)]
    st = {r.item_id: r for r in features.item_stats(frame(spark, rows)).collect()}
    assert st[5].rating_std == 0.0 and st[5].rating_count == 1
    assert st[6].rating_std == pytest.approx(math.sqrt(0.5))


def test_t_max_falls_in_the_last_window(spark):
    rows = [(1, 1, 1.0, 0), (1, 2, 1.0, 25), (1, 3, 1.0, 50), (1, 4, 1.0, 100)]
    w = {r.item_id: r.window_id for r in splits.assign_windows(frame(spark, rows), 4).collect()}
    assert w == {1: 0, 2: 1, 3: 2, 4: 3}
    stats = splits.window_stats(frame(spark, rows), 4).orderBy("window_id").collect()
    assert [r.n_ratings for r in stats] == [1, 1, 1, 1]
    assert stats[3].t_end == 100.0


def test_titles_year_extraction_and_imputation(spark):
    items = spark.createDataFrame(
        [(1, "A (1999)", "x"), (2, "B", "x"), (3, "C (2000) (2001)", "x"), (4, "D (12)", "x")],
        "item_id long, title string, genres string")
    y = {r.item_id: r.release_year for r in features.release_years(items).collect()}
    # known years 1999, 2000 -> lower median 1999 for the two without a year
    assert y == {1: 1999, 2: 1999, 3: 2000, 4: 1999}


def test_flat_user_has_zero_centred_values(spark):
    rows = [(1, 10, 3.0, 1), (1, 11, 3.0, 2), (2, 10, 5.0, 3), (2, 11, 1.0, 4)]
    cen = cf.centered(frame(spark, rows))
    assert {r.centered for r in cen.filter("user_id = 1").collect()} == {0.0}
    sims = cf.similarities(cen, min_co=1).collect()
    assert len(sims) == 1 and sims[0].sim == pytest.approx(-1.0)


def test_zero_norm_item_gives_zero_similarity(spark):
    rows = [(1, 10, 3.0, 1), (1, 11, 3.0, 2), (2, 10, 3.0, 3), (2, 11, 3.0, 4)]
    sims = cf.similarities(cf.centered(frame(spark, rows)), min_co=1).collect()
    assert sims[0].sim == 0.0 and sims[0].co_raters == 2


def _rank5(spark):
    recs = spark.createDataFrame([(1, i, i) for i in range(1, 6)],
                                 "user_id long, item_id long, rank long")
    # held out: item 2 (5.0, rel 1), item 4 (3.5, rel 2/3), item 9 (5.0, never recommended)
    held = frame(spark, [(1, 2, 5.0, 1), (1, 4, 3.5, 2), (1, 9, 5.0, 3)])
    return recs, held


def test_rank5_user_mode_by_hand(spark):
    recs, held = _rank5(spark)
    m = ranking.user_metrics(recs, held, (5,), 0.6, "user").collect()[0]
    g = lambda rel: 2 ** rel - 1
    dcg = g(1.0) / math.log2(3) + g(2 / 3) / math.log2(5)
    idcg = g(1.0) / math.log2(2) + g(1.0) / math.log2(3) + g(2 / 3) / math.log2(4)
    assert m.ndcg_5 == pytest.approx(dcg / idcg)
    assert m.recall_5 == pytest.approx(2 / 3)
    assert m.precision_5 == pytest.approx(2 / 5)
    assert m.mrr == pytest.approx(1 / 2)


def test_rank5_list_mode_by_hand(spark):
    recs, held = _rank5(spark)
    m = ranking.user_metrics(recs, held, (5,), 0.6, "list").collect()[0]
    g = lambda rel: 2 ** rel - 1
    miss = -1 / 9
    rels = [miss, 1.0, miss, 2 / 3, miss]
    dcg = sum(g(r) / math.log2(i + 2) for i, r in enumerate(rels))
    ideal = sorted(rels, reverse=True)
    idcg = sum(g(r) / math.log2(i + 2) for i, r in enumerate(ideal))
    assert m.ndcg_5 == pytest.approx(dcg / idcg)
    assert m.recall_5 == 1.0


def test_norel_user_scores_zero(spark):
    recs = spark.createDataFrame([(1, 1, 1)], "user_id long, item_id long, rank long")
    held = frame(spark, [(1, 7, 1.0, 1)])
    m = ranking.user_metrics(recs, held, (5,), 0.6, "user").collect()[0]
    assert m.recall_5 == 0.0 and m.mrr == 0.0 and m.ndcg_5 == 0.0


def test_ope6_identities(spark):
    rows = [(1, 1, 4.0, 1), (2, 1, 2.0, 2), (3, 2, 5.0, 3), (4, 2, 3.0, 4), (5, 2, 1.0, 5),
            (6, 3, 2.5, 6)]
    est = {r.estimator: r.value for r in ope.estimates(frame(spark, rows), clip=10.0).collect()}
    item_means = {1: 3.0, 2: 3.0, 3: 2.5}
    assert est["ips_raw"] == pytest.approx(sum(item_means.values()))
    assert est["ips_sn"] == pytest.approx(sum(item_means.values()) / 3)
    actual = sum(r[2] for r in rows) / 6
    assert est["dm_value"] == pytest.approx(actual)
    assert est["v_dr"] == pytest.approx(actual)
    assert est["dm_bias"] == pytest.approx(0.0, abs=1e-12)
    assert est["correction_term"] == pytest.approx(0.0, abs=1e-12)


def test_cold_start_is_one_pass_not_k_core(spark):
    # item 1 has 5 rows; user 9 holds one of them and is dropped (< 10 rows),
    # after which item 1 has 4 rows but is kept in the one-pass filter
    rows = [(u, 1, 3.0, u) for u in (1, 2, 3, 4, 9)]
    rows += [(u, 100 + j, 3.0, 10 + j) for u in (1, 2, 3, 4) for j in range(9)]
    rows += [(u, 100 + j, 3.0, 10 + j) for u in (5,) for j in range(9)]
    df = frame(spark, rows)
    one = splits.cold_start(df, 5, 10, 1)
    assert one.filter("item_id = 1").count() == 4
    core = splits.cold_start(df, 5, 10, 3)
    assert core.filter("item_id = 1").count() == 0


def test_q_values_reach_the_fixed_point(spark):
    """Against dense value iteration; a state without actions is worth 0, and the
    threshold removes the best but rare action."""
    import random
    rng = random.Random(3)
    rows = [("a", "x", "a", 90, 9.0), ("a", "y", "b", 10, 9.0), ("b", "x", "a", 50, 20.0),
            ("b", "y", "end", 60, 30.0), ("c", "z", "end", 5, 5.0)]
    states = [f"s{i}" for i in range(7)]
    rows += [(s, a, t, rng.randint(1, 30), None) for s in states for a in "uvw"
             for t in rng.sample([*states, "a", "end"], 3)]
    rows = [(s, a, t, n, r if r is not None else n * rng.random()) for s, a, t, n, r in rows]
    model = spark.createDataFrame(rows, "state string, action string, next_state string, n long, reward_sum double")
    for gamma in (0.99, 0.5, 0.0):
        found = {}
        for tau in (0.0, 0.3):
            n_sa, r_sa, n_s = {}, {}, {}
            for s, a, _, n, r in rows:
                n_sa[s, a] = n_sa.get((s, a), 0) + n
                r_sa[s, a] = r_sa.get((s, a), 0) + r
            ok = {s: [a for z, a in n_sa if z == s and n_sa[s, a] >= tau * max(
                n for (y, _), n in n_sa.items() if y == s)] for s, _ in n_sa}
            q = dict.fromkeys(n_sa, 0.0)
            for _ in range(4000 if gamma > 0.9 else 200):
                v = {s: max(q[s, a] for a in acts) for s, acts in ok.items()}
                q = {(s, a): r_sa[s, a] / n_sa[s, a] + gamma * sum(
                    n / n_sa[s, a] * v.get(t, 0.0) for z, b, t, n, _ in rows if (z, b) == (s, a)) for s, a in n_sa}
            got = {(r.state, r.action): r.q for r in policy.q_values(model, gamma, tau).collect()}
            assert got.keys() == q.keys()
            assert max(abs(got[k] - q[k]) for k in q) < 1e-6
            found[tau] = got
        assert gamma == 0.0 or found[0.0] != found[0.3]
    with pytest.raises(ValueError):
        policy.q_values(model, 1.0)
