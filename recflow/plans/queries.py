"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables at ``sf_dir`` in full, runs one
operator chain from ``recflow.operators`` and normalises the output with
``finish`` (doubles rounded, arrays as strings)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.functions.columns import fixed
from recflow.operators import kcore, splits, traj
from recflow.plans import common as C
from recflow.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark, sf_dir):
            C.reset_stages()
            return C.finish(fn(spark, sf_dir))
        QUERIES[name] = run
        QUERIES[name].__doc__ = fn.__doc__
        QUERIES[name].raw = fn
        return fn
    return deco


P = C.PARAMS


# ---------------------------------------------------------------- profile
def _profile(df: DataFrame, stage: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
    ).select(F.lit(stage).alias("stage"), "*",
             (F.col("n_rows") / (F.col("n_users") * F.col("n_items"))).alias("density"))


@query("profile")
def q_profile(spark, sf_dir):
    """A1: rows, distinct users, distinct items, density; raw and filtered."""
    raw = tables.interactions(spark, sf_dir)
    return _profile(raw, "raw").unionByName(_profile(C.ratings(spark, sf_dir), "cold_start"))


@query("rating_describe")
def q_rating_describe(spark, sf_dir):
    """A2: count, mean, sample std, min, max of the rating."""
    r = F.col("rating")
    return C.ratings(spark, sf_dir, staged=False).agg(
        F.count(r).alias("count"), F.avg(r).alias("mean"), F.stddev_samp(r).alias("std"),
        F.min(r).alias("min"), F.max(r).alias("max"))


@query("rating_histogram")
def q_rating_histogram(spark, sf_dir):
    """A3: rows per rating value."""
    return C.ratings(spark, sf_dir, staged=False).groupBy("rating").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- splits
@query("cold_start")
def q_cold_start(spark, sf_dir):
    """Items >= 5 rows, then users >= 10 rows."""
    return C.cold_start_ratings(spark, sf_dir)


@query("seq_numbered")
def q_seq_numbered(spark, sf_dir):
    """Per-user sequence number in (ts, item_id, rating) order."""
    return splits.sequence_numbered(C.ratings(spark, sf_dir, staged=False))


@query("split_temporal")
def q_split_temporal(spark, sf_dir):
    """First 80 % of each user's rows train, the rest test."""
    return C.split(spark, sf_dir, staged=False)


# ---------------------------------------------------------------- trajectories
def _traj(spark, sf_dir):
    return traj.build_trajectories(C.train_sequences(spark, sf_dir), P.state_size)


@query("traj_build")
def q_traj_build(spark, sf_dir):
    """K = 10 trajectories on the train part."""
    return _traj(spark, sf_dir)


@query("traj_quality")
def q_traj_quality(spark, sf_dir):
    """Reward, state length and per-user reports."""
    return traj.trajectory_quality(_traj(spark, sf_dir))


@query("traj_skew")
def q_traj_skew(spark, sf_dir):
    """p99 and max trajectories per user, skew flag."""
    return traj.trajectory_skew(_traj(spark, sf_dir))


@query("traj_prepare")
def q_traj_prepare(spark, sf_dir):
    """Normalised rewards and state ratings, stable id."""
    return traj.prepare_trajectories(_traj(spark, sf_dir))


@query("traj_capped")
def q_traj_capped(spark, sf_dir):
    """Trajectories from each user's last 50 train ratings."""
    capped = traj.cap_history(C.train(spark, sf_dir, staged=False), P.history_cap)
    return traj.build_trajectories(capped, P.state_size)


@query("traj_sample")
def q_traj_sample(spark, sf_dir):
    """Exactly 1,000 transitions in md5(user_id:rn:seed) order."""
    return traj.sample_trajectories(_traj(spark, sf_dir), P.sample_size, P.seed)


# ---------------------------------------------------------------- features
from recflow.operators import features, recommend  # noqa: E402
from recflow.sources import csv_io  # noqa: E402
from recflow.session import scratch_path  # noqa: E402

G = P.genres


@query("item_genre_flags")
def q_item_genre_flags(spark, sf_dir):
    """One 0/1 column per genre."""
    return features.genre_flags(tables.items(spark, sf_dir), G)


@query("item_release_year")
def q_item_release_year(spark, sf_dir):
    """Year from the title, missing -> median year."""
    return features.release_years(tables.items(spark, sf_dir))


@query("item_stats")
def q_item_stats(spark, sf_dir):
    """Item mean, std (0 when undefined), count."""
    return features.item_stats(C.ratings(spark, sf_dir, staged=False))


@query("item_popularity")
def q_item_popularity(spark, sf_dir):
    """Percent rank of the item's rating count."""
    return features.item_popularity(features.item_stats(C.ratings(spark, sf_dir, staged=False)))


@query("item_features")
def q_item_features(spark, sf_dir):
    """Items joined with flags, year, stats and popularity."""
    return features.item_features(tables.items(spark, sf_dir), C.ratings(spark, sf_dir), G)


@query("item_features_recent")
def q_item_features_recent(spark, sf_dir):
    """J3 where items are unrated: statistics of the last 30 days only; items without a
    rating there are dropped."""
    r = C.ratings(spark, sf_dir)
    last = r.select(F.max("ts")).scalar()
    return features.item_features(tables.items(spark, sf_dir),
                                  r.filter(F.col("ts") > last - 86400 * 30), G)


@query("user_stats")
def q_user_stats(spark, sf_dir):
    """User mean, std, count, first and last ts, active days."""
    return features.user_stats(C.ratings(spark, sf_dir, staged=False))


@query("user_genre_pref")
def q_user_genre_pref(spark, sf_dir):
    """User mean rating per genre, 0 when none."""
    return features.user_genre_pref(C.ratings(spark, sf_dir), tables.items(spark, sf_dir), G)


@query("user_features")
def q_user_features(spark, sf_dir):
    """User statistics joined with genre preferences."""
    return features.user_features(C.ratings(spark, sf_dir), tables.items(spark, sf_dir), G)


@query("item_dense_index")
def q_item_dense_index(spark, sf_dir):
    """0-based dense index of the featured items in item_id order."""
    feats = features.item_features(tables.items(spark, sf_dir), C.ratings(spark, sf_dir), G)
    return recommend.dense_index(feats)


@query("traj_indexed")
def q_traj_indexed(spark, sf_dir):
    """Trajectories with item ids replaced by dense indexes (-1 unknown)."""
    feats = features.item_features(tables.items(spark, sf_dir), C.ratings(spark, sf_dir), G)
    return traj.indexed_trajectories(C.train_sequences(spark, sf_dir), recommend.dense_index(feats),
                                     P.state_size)


@query("item_content_vector")
def q_item_content_vector(spark, sf_dir):
    """Genre flags, decade one-hot and three statistics."""
    it = tables.items(spark, sf_dir)
    stats = features.item_popularity(features.item_stats(C.ratings(spark, sf_dir)))
    return recommend.content_vectors(it, features.release_years(it), stats, G)


# ---------------------------------------------------------------- time windows
from recflow.operators import quantiles  # noqa: E402
from recflow.operators import rounds as rounds_op  # noqa: E402
from recflow.session import materialize  # noqa: E402
from recflow.streaming import windows as stream  # noqa: E402


@query("time_window_stats")
def q_time_window_stats(spark, sf_dir):
    """Four equal global time windows, last one closed."""
    return splits.window_stats(C.ratings(spark, sf_dir, staged=False), P.n_windows)


def _rounds(spark, sf_dir):
    return C.stage(("rounds", sf_dir), lambda: splits.backtest_rounds(C.ratings(spark, sf_dir),
                                                                     P.n_windows), ("round", "part"))


def _assigned(spark, sf_dir):
    """Ratings with their window, written once."""
    return C.stage(("assigned", sf_dir), lambda: splits.assign_windows(C.ratings(spark, sf_dir), P.n_windows))


def _progress(spark, sf_dir):
    return rounds_op.round_progress(_assigned(spark, sf_dir), P.n_windows, P.state_size)


@query("backtest_rounds")
def q_backtest_rounds(spark, sf_dir):
    """Expanding train windows and the next test window."""
    return _rounds(spark, sf_dir)


@query("backtest_eligible")
def q_backtest_eligible(spark, sf_dir):
    """Rounds whose train rows >= (K+1) x train users, from counts per window."""
    return _progress(spark, sf_dir).select("round", "train_rows", "train_users", "eligible")


@query("backtest_trajectories")
def q_backtest_trajectories(spark, sf_dir):
    """Trajectories of every eligible round in one job."""
    rounds = _rounds(spark, sf_dir)
    ok = _progress(spark, sf_dir).filter(F.col("eligible") == 1)
    tr = (rounds.filter(F.col("part") == "train").drop("part")
          .join(F.broadcast(ok.select("round")), "round", "left_semi"))
    return traj.build_trajectories(tr, P.state_size, keys=("round",))


@query("round_metadata_json")
def q_round_metadata_json(spark, sf_dir):
    """Per round the trajectory file, the sizes of both parts and the
    number of trajectories (none where the round is not eligible), as JSON."""
    meta = _progress(spark, sf_dir).select(
        "round", F.format_string("round_%d_trajectories.parquet", "round").alias("trajectory_file"),
        "train_rows", "train_users", "test_rows", "test_users", "eligible",
        (F.col("train_trajectories") * F.col("eligible")).cast("bigint").alias("n_trajectories"))
    path = scratch_path(spark, "rounds-json")
    csv_io.write_json(meta, path)
    return csv_io.read_json(spark, path, meta.schema)


@query("time_window_stats_stream")
def q_time_window_stats_stream(spark, sf_dir):
    """B2 as a stream: the ratings arrive as files, one window after another, and closed
    windows leave the stream as counts and user bitmaps."""
    assigned = _assigned(spark, sf_dir)
    source, out = scratch_path(spark, "arrivals"), scratch_path(spark, "closed-windows")
    lo, hi = assigned.agg(F.min("ts"), F.max("ts")).first()
    for w in range(P.n_windows):
        assigned.where(F.col("window_id") == w).select("user_id", "ts").write.mode("append").parquet(source)
    stream.closing_file(spark, source, lo, hi, P.n_windows)
    stream.stream_window_counts(spark, source, out, lo, hi, P.n_windows)
    return stream.streamed_window_stats(spark, out, lo, hi, P.n_windows)


@query("cold_start_kcore")
def q_cold_start_kcore(spark, sf_dir):
    """B0 until no row falls: every item left has >= 20 rows and every user >= 28."""
    return kcore.k_core(tables.interactions(spark, sf_dir), P.core_item, P.core_user)


@query("traj_sample_replay")
def q_traj_sample_replay(spark, sf_dir):
    """R6 at the replay buffer's size: exactly 100,000 transitions (all, if fewer)."""
    return traj.sample_trajectories(_traj(spark, sf_dir), P.replay_capacity, P.seed)


@query("approx_quantiles")
def q_approx_quantiles(spark, sf_dir):
    """A10 / R3 / P4 from sketches: release year of the items, trajectories per user, and
    rating time of the train rows of every round, merged from one sketch per window. Each
    quantile is held against all rows: ok = 1 where its rank is off by 2 % at most."""
    years = features.release_years(tables.items(spark, sf_dir))
    per_user = materialize(_traj(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows")),
                           "traj-per-user")
    assigned = _assigned(spark, sf_dir)
    out = None
    for name, rows, value in (("release_year", years, "release_year"), ("traj_per_user", per_user, "n_rows")):
        found = materialize(quantiles.quantiles(quantiles.sketches(rows, value), P.probs), "quantiles")
        part = quantiles.rank_within(rows.select(value), value, found, P.rank_tolerance).withColumn(
            "metric", F.lit(name)).withColumn("round", F.lit(0).cast("bigint"))
        out = part if out is None else out.unionByName(part)
    found = materialize(quantiles.quantiles(quantiles.round_sketches(assigned, "ts", P.n_windows), P.probs,
                                            ("round",)), "quantiles")
    train_rows = assigned.join(F.broadcast(splits.round_table(spark, P.n_windows).where("part = 'train'")),
                               "window_id")
    return out.unionByName(quantiles.rank_within(train_rows, "ts", found, P.rank_tolerance, ("round",))
                           .withColumn("metric", F.lit("rating_time")))


# ---------------------------------------------------------------- sources
@query("user_sample")
def q_user_sample(spark, sf_dir):
    """All rows of 1,000 users drawn in md5(user_id:seed) order."""
    return splits.user_sample(C.ratings(spark, sf_dir, staged=False), P.eval_user_sample, P.seed)


@query("src_csv_roundtrip")
def q_src_csv_roundtrip(spark, sf_dir):
    """Interactions written as CSV to the shared checkpoint
    folder and read back with the explicit schema."""
    path = scratch_path(spark, "csv-roundtrip")
    csv_io.write_csv(tables.interactions(spark, sf_dir), path)
    return csv_io.read_ratings_csv(spark, path)


@query("src_items_csv_roundtrip")
def q_src_items_csv_roundtrip(spark, sf_dir):
    """The item table written as CSV and read back with its schema."""
    path = scratch_path(spark, "items-csv")
    csv_io.write_csv(tables.items(spark, sf_dir), path)
    return csv_io.read_items_csv(spark, path)


@query("window_metadata_json")
def q_window_metadata_json(spark, sf_dir):
    """Window bounds and counts written as JSON and read back."""
    stats = splits.window_stats(C.ratings(spark, sf_dir, staged=False), P.n_windows)
    path = scratch_path(spark, "windows-json")
    csv_io.write_json(stats, path)
    return csv_io.read_json(spark, path, stats.schema)


@query("backtest_rounds_partitioned")
def q_backtest_rounds_partitioned(spark, sf_dir):
    """The round tables written by (round, part), one round's train
    and test read back through partition pruning."""
    path = scratch_path(spark, "rounds")
    rounds = splits.backtest_rounds(C.ratings(spark, sf_dir, staged=False), P.n_windows)
    csv_io.write_parquet(rounds, path, ("round", "part"))
    back = spark.read.schema(rounds.schema).parquet(path)
    return back.filter(F.col("round") == 2).groupBy("round", "part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users"),
        F.sum("ts").alias("ts_sum"))


@query("traj_ordered_files")
def q_traj_ordered_files(spark, sf_dir):
    """L1 / L2: trajectories written in (user_id, rn) order as a given number
    of files: files whose ranges overlap, and rows that break the order inside a file."""
    path = scratch_path(spark, "traj-files")
    # counted, sampled and sorted: three passes over one numbering
    built = traj.build_trajectories(C.train_sequences(spark, sf_dir, staged=True), P.state_size)
    traj.write_trajectories(built, path, 4)
    rows = spark.read.parquet(path).select(
        F.struct("user_id", "rn").alias("at"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("line"))
    per_file = rows.groupBy("file").agg(F.min("at").alias("lo"), F.max("at").alias("hi"),
                                        F.count(F.lit(1)).alias("n"))
    # every row meets the next one of its file
    following = rows.select("file", (F.col("line") - 1).alias("line"), F.col("at").alias("next"))
    breaks = rows.join(following, ["file", "line"]).agg(F.count(F.when(F.col("at") >= F.col("next"), 1)))
    # four files: one row each
    w = F.lag("hi").over(Window.orderBy("lo"))
    return per_file.withColumn("before", w).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows"),
        F.count(F.when(F.col("before") >= F.col("lo"), 1)).alias("overlaps")).withColumn(
        "breaks", breaks.scalar())


@query("traj_indexed_unknown")
def q_traj_indexed_unknown(spark, sf_dir):
    """P14 where states hold unknown items: indexes over the items rated at least 30
    times, -1 for all others in state, action and next state."""
    often = (C.train(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") >= 30))
    index = C.stage(("often", sf_dir), lambda: recommend.dense_index(often))
    return traj.indexed_trajectories(C.train_sequences(spark, sf_dir, staged=True), index, P.state_size)


@query("traj_index_inverse")
def q_traj_index_inverse(spark, sf_dir):
    """Item ids indexed over the items rated at least 30 times
    (all others -1) and mapped back through the inverse index."""
    tr = C.train(spark, sf_dir)
    often = tr.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 30)
    index = C.stage(("often", sf_dir), lambda: recommend.dense_index(often))
    t = traj.indexed_trajectories(C.train_sequences(spark, sf_dir, staged=True), index, P.state_size)
    back = recommend.from_index(t.select("user_id", "rn", F.col("action_idx").alias("idx")), index)
    return back.select("user_id", "rn", "idx", F.coalesce("item_id", F.lit(-1)).alias("item_id"))


@query("cold_start_strict")
def q_cold_start_strict(spark, sf_dir):
    """A4 / B0 / J1 where both thresholds bite: items >= 28 rows, then users
    >= 30 rows."""
    return splits.cold_start(C.interactions(spark, sf_dir), 28, 30, 1)


@query("item_content_vector_sparse")
def q_item_content_vector_sparse(spark, sf_dir):
    """Statistics of the last 30 days only, so many items have none and
    take the defaults."""
    it = tables.items(spark, sf_dir)
    r = C.ratings(spark, sf_dir, staged=False)
    last = r.select(F.max("ts")).scalar()
    stats = features.item_popularity(features.item_stats(r.filter(F.col("ts") > last - 86400 * 30)))
    return recommend.content_vectors(it, features.release_years(it), stats, G)


# ---------------------------------------------------------------- item-item CF
from recflow.operators import cf  # noqa: E402


def _cen(spark, sf_dir):
    return C.stage(("centered", sf_dir), lambda: cf.centered(C.ratings(spark, sf_dir)))


def _sims(spark, sf_dir, min_co):
    return cf.similarities(_cen(spark, sf_dir), min_co, P.pair_chunk_size)


@query("cf_centered")
def q_cf_centered(spark, sf_dir):
    """Mean over duplicates, user mean, centred value, item norm."""
    cen = _cen(spark, sf_dir)
    return cen.join(cf.item_norms(cen), "item_id").select(
        "user_id", "item_id", "rating", "user_mean", "centered", F.col("norm").alias("item_norm"))


@query("cf_similarity")
def q_cf_similarity(spark, sf_dir):
    """Adjusted cosine for pairs with >= 3 common users."""
    return _sims(spark, sf_dir, P.min_co_raters)


@query("cf_pair_counts")
def q_cf_pair_counts(spark, sf_dir):
    """Pairs with a common user, and with >= 3."""
    return cf.pair_counts(_cen(spark, sf_dir), P.min_co_raters, P.pair_chunk_size)


@query("cf_top_pairs")
def q_cf_top_pairs(spark, sf_dir):
    """15 most similar pairs (>= 3 common users) with titles."""
    return cf.top_pairs(_sims(spark, sf_dir, P.min_co_raters), tables.items(spark, sf_dir),
                        P.top_pairs)


@query("cf_recommend")
def q_cf_recommend(spark, sf_dir):
    """Top 20 for every user with
    titles, co >= 3 pairs."""
    cen = _cen(spark, sf_dir)
    recs = cf.recommend(cen, cf.similarities(cen, P.min_co_raters, P.pair_chunk_size), P.top_n)
    return cf.with_titles(recs, tables.items(spark, sf_dir), "item_id")


@query("cf_recommend_unfiltered")
def q_cf_recommend_unfiltered(spark, sf_dir):
    """C4 with every pair (co >= 1). Evidence of single common users nearly
    cancels, which magnifies rounding: scores are given to 3 decimals."""
    cen = _cen(spark, sf_dir)
    recs = cf.recommend(cen, cf.similarities(cen, 1, P.pair_chunk_size), P.top_n)
    return recs.withColumn("score", fixed(F.col("score"), 3))


@query("cf_recommend_target")
def q_cf_recommend_target(spark, sf_dir):
    """C4 / J11 for given users: every pair (co >= 1) counts, top 20 for 20 users drawn
    in md5(user_id:seed) order, with titles. Scores to 3 decimals (see above)."""
    cen = _cen(spark, sf_dir)
    users = splits.hash_sample(cen.select("user_id").distinct(), P.target_users, ("user_id",), P.seed)
    recs = cf.recommend_for(cen, users, P.top_n).withColumn("score", fixed(F.col("score"), 3))
    return cf.with_titles(recs, tables.items(spark, sf_dir), "item_id")


@query("cf_recommend_untitled")
def q_cf_recommend_untitled(spark, sf_dir):
    """J7 where titles are missing: items without a year in the title are not in the
    catalogue, and those without genres have no title there."""
    cen = _cen(spark, sf_dir)
    recs = cf.recommend(cen, cf.similarities(cen, P.min_co_raters, P.pair_chunk_size), P.top_n)
    known = tables.items(spark, sf_dir).where(F.col("title").contains("(")).withColumn(
        "title", F.when(F.col("genres") != tables.NO_GENRES, F.col("title")))
    return cf.with_titles(recs, known, "item_id")


@query("cf_explain")
def q_cf_explain(spark, sf_dir):
    """Top-5 contributing liked items of each user's first
    recommendation, with titles."""
    cen = _cen(spark, sf_dir)
    sims = C.stage(("sims", sf_dir), lambda: cf.similarities(cen, P.min_co_raters, P.pair_chunk_size))
    found = cf.explain(cf.recommend(cen, sims, P.top_n), cen, sims, P.top_contributors)
    return cf.with_titles(found, tables.items(spark, sf_dir), "item_id", "liked_item_id")


# ---------------------------------------------------------------- recommenders
from recflow.operators import ranking  # noqa: E402


def _test_users(test: DataFrame, keys=()) -> DataFrame:
    return test.select(*keys, "user_id").distinct()


def _pop_recs(spark, sf_dir):
    tr, te = C.train(spark, sf_dir), C.test(spark, sf_dir)
    return recommend.popularity_recommend(tr, _test_users(te), P.top_n)


def _random_recs(spark, sf_dir):
    tr, te = C.train(spark, sf_dir), C.test(spark, sf_dir)
    return recommend.random_recommend(tr, _test_users(te), P.top_n, P.seed)


def _cf_recs(sf_dir: str, train: DataFrame, keys=()):
    cen = C.stage(("centered_train", sf_dir, tuple(keys)), lambda: cf.centered(train, keys))
    return cf.recommend(cen, cf.similarities(cen, P.min_co_raters, P.pair_chunk_size, keys),
                        P.top_n, keys)


@query("rec_popularity")
def q_rec_popularity(spark, sf_dir):
    """Top 20 train-popular items per test user, seen excluded."""
    return _pop_recs(spark, sf_dir)


@query("rec_random")
def q_rec_random(spark, sf_dir):
    """One seeded md5 shuffle of the items, seen excluded, top 20."""
    return _random_recs(spark, sf_dir)


@query("candidates_top")
def q_candidates_top(spark, sf_dir):
    """The 2,000 most rated train items."""
    return recommend.top_candidates(C.train(spark, sf_dir), P.n_candidates)


# ---------------------------------------------------------------- ranking evaluation
@query("eval_ranking")
def q_eval_ranking(spark, sf_dir):
    """Popularity top-20 against the test part,
    ideal from all held-out items."""
    return ranking.evaluate(_pop_recs(spark, sf_dir), C.test(spark, sf_dir), P.k_values,
                            P.relevance_threshold, "user")


@query("eval_ranking_list")
def q_eval_ranking_list(spark, sf_dir):
    """E1-E6 in list mode: ideal and recall from the top-k list only."""
    return ranking.evaluate(_pop_recs(spark, sf_dir), C.test(spark, sf_dir), P.k_values,
                            P.relevance_threshold, "list")


@query("eval_compare")
def q_eval_compare(spark, sf_dir):
    """Popularity, random and item-CF side by side."""
    te = C.test(spark, sf_dir)
    methods = {"popularity": _pop_recs(spark, sf_dir),
               "random": _random_recs(spark, sf_dir),
               "itemcf": _cf_recs(sf_dir, C.train(spark, sf_dir))}
    out = None
    for name, recs in methods.items():
        s = ranking.evaluate(recs, te, P.k_values, P.relevance_threshold, "user") \
            .withColumn("method", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return ranking.compare_table(out, P.k_values, ("method",))


def _round_parts(spark, sf_dir):
    rounds = _rounds(spark, sf_dir)
    tr = rounds.filter(F.col("part") == "train").drop("part")
    te = rounds.filter(F.col("part") == "test").drop("part")
    return tr, te


def _curve(sf_dir: str, method: str, tr: DataFrame, te: DataFrame) -> DataFrame:
    keys = ("round",)
    if method == "popularity":
        recs = recommend.popularity_recommend(tr, _test_users(te, keys), P.top_n, keys=keys)
    else:
        recs = _cf_recs(sf_dir, tr, keys)
    s = ranking.evaluate(recs, te, P.k_values, P.relevance_threshold, "user", keys)
    return ranking.compare_table(s, P.k_values, keys).withColumn("method", F.lit(method))


@query("backtest_curve")
def q_backtest_curve(spark, sf_dir):
    """Popularity metrics and train rows for every round, from counts per window."""
    assigned = _assigned(spark, sf_dir)
    recs = rounds_op.popularity_backtest(assigned, P.n_windows, P.top_n)
    s = ranking.evaluate(recs, rounds_op.round_test(assigned), P.k_values, P.relevance_threshold,
                         "user", ("round",))
    rows = _progress(spark, sf_dir).select("round", "train_rows")
    return ranking.compare_table(s, P.k_values, ("round",)).join(rows, "round")


@query("backtest_compare")
def q_backtest_compare(spark, sf_dir):
    """Popularity against item-CF per round, verdict at +-0.003."""
    tr, te = _round_parts(spark, sf_dir)
    curve = _curve(sf_dir, "popularity", tr, te).unionByName(_curve(sf_dir, "itemcf", tr, te))
    return ranking.curve_compare(curve, "popularity", "itemcf", "ndcg_10", P.tie_margin)


# ---------------------------------------------------------------- off-policy evaluation
from recflow.operators import ope, policy  # noqa: E402


@query("ope_propensity")
def q_ope_propensity(spark, sf_dir):
    """Per-item share of logged test rows and mean rating."""
    return ope.item_models(C.test(spark, sf_dir))


@query("ope_summary")
def q_ope_summary(spark, sf_dir):
    """IPS, clipped and self-normalised IPS, DM, DR on the test part."""
    return ope.estimates(C.test(spark, sf_dir), P.clip)


@query("ope_policy")
def q_ope_policy(spark, sf_dir):
    """The estimators for a uniform top-20-popular target policy,
    behaviour and reward models fitted on train, scored on test."""
    tr = C.train(spark, sf_dir)
    return ope.policy_estimates(tr, C.test(spark, sf_dir),
                                ope.top_k_uniform_policy(tr, P.top_n), P.clip)


# ---------------------------------------------------------------- tabular policies
def _model(spark, sf_dir, category: str = "category"):
    """Category transitions of the train trajectories, reduced once to the
    (state, action, next_state) table that all policy queries iterate on."""
    def build():
        cats = tables.items(spark, sf_dir).select("item_id", F.expr(category).alias("category"))
        # every rated item has a category here, so the join drops no step of a sequence
        tr = C.train_sequences(spark, sf_dir).join(cats, "item_id")
        t = traj.build_trajectories(tr, P.state_size, carry=("category",))
        return policy.transition_model(policy.transitions(t))
    return C.stage(("transition_model", sf_dir, category), build)


# decade of release as category: titles without a year and those of 2000 are rare
# enough for the threshold of 0.3 to remove them
DECADE = r"coalesce(nullif(regexp_extract(title, '\\((\\d{3})\\d\\)', 1), '') || '0s', 'undated')"


@query("policy_behaviour")
def q_policy_behaviour(spark, sf_dir):
    """Q1: share of each action category in each state category."""
    return policy.behaviour_policy(_model(spark, sf_dir))


@query("q_unconstrained")
def q_q_unconstrained(spark, sf_dir):
    """Q2: the fixed point with the max over every observed action."""
    return policy.q_values(_model(spark, sf_dir), P.gamma)


@query("q_constrained")
def q_q_constrained(spark, sf_dir):
    """Q3: the fixed point, max only over actions with pi_b >= 0.3 max pi_b."""
    return policy.q_values(_model(spark, sf_dir), P.gamma, P.bcq_threshold)


@query("policy_greedy")
def q_policy_greedy(spark, sf_dir):
    """Q4: greedy constrained action per state."""
    m = _model(spark, sf_dir)
    q = policy.q_values(m, P.gamma, P.bcq_threshold)
    return policy.greedy_policy(q, policy.allowed_actions(policy.behaviour_policy(m),
                                                          P.bcq_threshold))


@query("policy_compare")
def q_policy_compare(spark, sf_dir):
    """Q5: unconstrained against constrained greedy actions per state."""
    return policy.compare_policies(_model(spark, sf_dir), P.gamma, P.bcq_threshold)


@query("policy_compare_strict")
def q_policy_compare_strict(spark, sf_dir):
    """Q3 / Q5 with a threshold that removes actions: the constrained values
    and choices differ from the unconstrained ones."""
    return policy.compare_policies(_model(spark, sf_dir), P.gamma, P.strict_threshold)


@query("policy_compare_decade")
def q_policy_compare_decade(spark, sf_dir):
    """Q2 / Q3 / Q5 on decades of release, where the threshold of 0.3 removes actions."""
    return policy.compare_policies(_model(spark, sf_dir, DECADE), P.gamma, P.bcq_threshold)


@query("policy_behaviour_decade")
def q_policy_behaviour_decade(spark, sf_dir):
    """Q1 / Q3 on decades of release: shares, and whether an action is allowed at 0.3."""
    beh = policy.behaviour_policy(_model(spark, sf_dir, DECADE))
    ok = policy.allowed_actions(beh, P.bcq_threshold).withColumn("allowed", F.lit(1))
    return beh.join(ok, ["state", "action"], "left").fillna(0, ["allowed"])


@query("policy_value")
def q_policy_value(spark, sf_dir):
    """Off-policy value of the greedy policies, unconstrained and
    under both thresholds."""
    m = _model(spark, sf_dir)
    beh = policy.behaviour_policy(m)
    out = None
    for name, tau in (("unconstrained", 0.0), ("constrained", P.bcq_threshold),
                      ("strict", P.strict_threshold)):
        q = policy.q_values(m, P.gamma, tau)
        v = policy.policy_value(m, policy.greedy_policy(q, policy.allowed_actions(beh, tau)), P.clip) \
            .withColumn("policy", F.lit(name))
        out = v if out is None else out.unionByName(v)
    return out


# ---------------------------------------------------------------- vector retrieval
from recflow.operators import knn  # noqa: E402


@query("vec_topk")
def q_vec_topk(spark, sf_dir):
    """10 nearest vectors (cosine) of every vector whose id is
    divisible by 50, exact search in clustered blocks."""
    emb = tables.embeddings(spark, sf_dir)
    return knn.nearest_vectors(emb, emb.where(F.col("vec_id") % 50 == 0)
                               .select(F.col("vec_id").alias("query_id")), 10)


@query("rec_content_knn")
def q_rec_content_knn(spark, sf_dir):
    """History vector of the last 10 train items -> cosine top 20 over
    all item content vectors, seen items excluded, for every test user."""
    it = tables.items(spark, sf_dir)
    tr = C.train(spark, sf_dir)
    # statistics from train only: nothing of the test part reaches the vectors
    stats = features.item_popularity(features.item_stats(tr))
    vecs = recommend.content_vectors(it, features.release_years(it), stats, G)
    return knn.content_recommend(tr, vecs, _test_users(C.test(spark, sf_dir)),
                                 P.top_n, P.state_size)
