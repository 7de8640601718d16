"""DuckDB SQL for every registered query, written from the operator
definitions. Rounding alone is shared with the Spark side (``_half_up``): both
engines round by the same formula, so equal values hash equally. Tables are the
driver's pre-registered views."""

from __future__ import annotations

BASE = """
interactions AS (
  SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey AS BIGINT) AS item_id,
         CAST(ceil(l_quantity / 5.0) * 0.5 AS DOUBLE) AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
items AS (
  SELECT CAST(p_partkey AS BIGINT) AS item_id,
         CASE WHEN p_partkey % 20 = 0 THEN p_name
              ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
         CASE WHEN p_partkey % 10 = 0 THEN '(no genres listed)'
              ELSE replace(p_name, ' ', '|') END AS genres,
         p_type AS category
  FROM part),
ic AS (SELECT item_id FROM interactions GROUP BY item_id HAVING count(*) >= 5),
r1 AS (SELECT * FROM interactions WHERE item_id IN (SELECT item_id FROM ic)),
uc AS (SELECT user_id FROM r1 GROUP BY user_id HAVING count(*) >= 10),
ratings AS (SELECT * FROM r1 WHERE user_id IN (SELECT user_id FROM uc)),
seq AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id, rating) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM ratings),
split AS (
  SELECT user_id, item_id, rating, ts,
         CASE WHEN rn <= n * CAST(0.8 AS DOUBLE) THEN 'train' ELSE 'test' END AS part
  FROM seq),
train AS (SELECT user_id, item_id, rating, ts FROM split WHERE part = 'train'),
test AS (SELECT user_id, item_id, rating, ts FROM split WHERE part = 'test')"""


def traj_ctes(src: str, name: str = "traj", k: int = 10, keys: str = "") -> str:
    """Trajectories of ``src`` by a self-join on the K-row band."""
    kk = f"{keys}, " if keys else ""
    kj = " AND ".join([f"a.{c.strip()} = b.{c.strip()}" for c in keys.split(",") if c.strip()])
    kj = f"{kj} AND " if kj else ""
    ka = ", ".join([f"a.{c.strip()}" for c in keys.split(",") if c.strip()])
    ka = f"{ka}, " if ka else ""
    return f"""
{name}_seq AS (
  SELECT *, row_number() OVER (PARTITION BY {kk}user_id ORDER BY ts, item_id, rating) AS rn,
         count(*) OVER (PARTITION BY {kk}user_id) AS total_ratings
  FROM {src}),
{name} AS (
  SELECT {ka}a.user_id, a.rn, a.total_ratings, a.ts,
    string_agg(CAST(b.item_id AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn < a.rn) AS state_item_ids,
    string_agg(CAST(CAST(round(b.rating, 6) AS DECIMAL(38,6)) AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn < a.rn) AS state_ratings,
    a.item_id AS action_item_id, a.rating AS reward,
    string_agg(CAST(b.item_id AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn > a.rn - {k}) AS next_state_item_ids,
    string_agg(CAST(CAST(round(b.rating, 6) AS DECIMAL(38,6)) AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn > a.rn - {k}) AS next_state_ratings,
    string_agg(CAST(CAST(round((b.rating - 0.5) / 4.5, 6) AS DECIMAL(38,6)) AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn < a.rn) AS state_ratings_normalized,
    string_agg(CAST(CAST(round((b.rating - 0.5) / 4.5, 6) AS DECIMAL(38,6)) AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn > a.rn - {k}) AS next_state_ratings_normalized
  FROM {name}_seq a JOIN {name}_seq b
    ON {kj}a.user_id = b.user_id AND b.rn BETWEEN a.rn - {k} AND a.rn
  WHERE a.rn > {k}
  GROUP BY {ka}a.user_id, a.rn, a.total_ratings, a.ts, a.item_id, a.rating)"""


TRAJ_COLS = ("user_id, rn, total_ratings, ts, state_item_ids, state_ratings, action_item_id, "
             "reward, next_state_item_ids, next_state_ratings")


def sql(*ctes: str, select: str) -> str:
    parts = [BASE] + [c.strip().rstrip(",") for c in ctes if c.strip()]
    recursive = any("_it AS (" in p for p in parts)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(p.strip() for p in parts) + "\n" + select


ORACLE: dict[str, str] = {}


def _half_up(text: str) -> str:
    """Rewrite ``round(x, 6)`` as floor(x * 1e6 + 0.5) / 1e6 and ``round(x, 9)``
    (ranking keys) as floor(x * 1e9 + 0.5), the formulas the Spark side uses,
    so both engines round with the same IEEE steps."""
    out, i = [], 0
    low = text.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(text[i:])
                return "".join(out)
            out.append(text[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = text[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = text[j + 6:comma] if comma > 0 else None
        places = text[comma + 1:k - 1].strip() if comma > 0 else None
        out.append(text[i:j])
        if places == "6":
            out.append(f"(floor(({_half_up(inner)}) * 1e6 + 0.5) / 1e6)")
        elif places == "9":
            out.append(f"floor(({_half_up(inner)}) * 1e9 + 0.5)")
        else:
            out.append(text[j:k])
        i = k

ORACLE["profile"] = sql(select="""
SELECT 'raw' AS stage, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       count(DISTINCT item_id) AS n_items,
       round(count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6) AS density
FROM interactions
UNION ALL
SELECT 'cold_start', count(*), count(DISTINCT user_id), count(DISTINCT item_id),
       round(count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6)
FROM ratings""")

ORACLE["rating_describe"] = sql(select="""
SELECT count(rating) AS count, round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS std,
       round(min(rating), 6) AS min, round(max(rating), 6) AS max
FROM ratings""")

ORACLE["rating_histogram"] = sql(select="""
SELECT round(rating, 6) AS rating, count(*) AS n FROM ratings GROUP BY rating""")

ORACLE["cold_start"] = sql(select="SELECT user_id, item_id, round(rating, 6) AS rating, ts FROM ratings")

ORACLE["seq_numbered"] = sql(select="""
SELECT user_id, item_id, round(rating, 6) AS rating, ts, rn FROM seq""")

ORACLE["split_temporal"] = sql(select="""
SELECT user_id, item_id, round(rating, 6) AS rating, ts, part FROM split""")

ORACLE["traj_build"] = sql(traj_ctes("train"), select=f"""
SELECT user_id, rn, total_ratings, ts, state_item_ids, state_ratings, action_item_id,
       round(reward, 6) AS reward, next_state_item_ids, next_state_ratings
FROM traj""")

ORACLE["traj_quality"] = sql(traj_ctes("train"), """
rd AS (SELECT CAST(count(*) AS DOUBLE) AS c, avg(reward) AS m, stddev_samp(reward) AS s,
              min(reward) AS lo, max(reward) AS hi FROM traj)""", """
pu AS (SELECT user_id, count(*) AS n FROM traj GROUP BY user_id)""", """
ud AS (SELECT CAST(count(*) AS DOUBLE) AS c, avg(n) AS m, stddev_samp(n) AS s,
              CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) AS DOUBLE) AS hi FROM pu)""", select="""
SELECT 'reward_count' AS metric, '' AS bucket, round(c, 6) AS value FROM rd
UNION ALL SELECT 'reward_mean', '', round(m, 6) FROM rd
UNION ALL SELECT 'reward_std', '', round(s, 6) FROM rd
UNION ALL SELECT 'reward_min', '', round(lo, 6) FROM rd
UNION ALL SELECT 'reward_max', '', round(hi, 6) FROM rd
UNION ALL SELECT 'reward_hist', CAST(reward AS VARCHAR), CAST(count(*) AS DOUBLE) FROM traj GROUP BY reward
UNION ALL SELECT 'state_len', CAST(len(string_split(state_item_ids, ',')) AS VARCHAR), CAST(count(*) AS DOUBLE)
  FROM traj GROUP BY 2
UNION ALL SELECT 'rows_per_user_count', '', round(c, 6) FROM ud
UNION ALL SELECT 'rows_per_user_mean', '', round(m, 6) FROM ud
UNION ALL SELECT 'rows_per_user_std', '', round(s, 6) FROM ud
UNION ALL SELECT 'rows_per_user_min', '', round(lo, 6) FROM ud
UNION ALL SELECT 'rows_per_user_max', '', round(hi, 6) FROM ud""")

ORACLE["traj_skew"] = sql(traj_ctes("train"), """
pu AS (SELECT user_id, count(*) AS n FROM traj GROUP BY user_id)""", select="""
SELECT count(*) AS n_users, round(CAST(quantile_disc(n, 0.99) AS DOUBLE), 6) AS p99,
       max(n) AS max_rows, round(max(n) / quantile_disc(n, 0.99), 6) AS max_over_p99,
       CAST(max(n) > 5 * quantile_disc(n, 0.99) AS BIGINT) AS skewed
FROM pu""")

ORACLE["traj_prepare"] = sql(traj_ctes("train"), select=f"""
SELECT user_id, rn, total_ratings, ts, state_item_ids, state_ratings, action_item_id,
       round(reward, 6) AS reward, next_state_item_ids, next_state_ratings,
       round((reward - 0.5) / 4.5, 6) AS reward_normalized,
       state_ratings_normalized, next_state_ratings_normalized,
       concat_ws('-', user_id, rn) AS trajectory_id
FROM traj""")

ORACLE["traj_capped"] = sql("""
cap_seq AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id, rating) AS rn0,
         count(*) OVER (PARTITION BY user_id) AS n0
  FROM train)""", """
capped AS (SELECT user_id, item_id, rating, ts FROM cap_seq WHERE rn0 > n0 - 50)""",
    traj_ctes("capped"), select=f"""
SELECT user_id, rn, total_ratings, ts, state_item_ids, state_ratings, action_item_id,
       round(reward, 6) AS reward, next_state_item_ids, next_state_ratings
FROM traj""")

ORACLE["traj_sample"] = sql(traj_ctes("train"), select=f"""
SELECT user_id, rn, total_ratings, ts, state_item_ids, state_ratings, action_item_id,
       round(reward, 6) AS reward, next_state_item_ids, next_state_ratings
FROM traj ORDER BY md5(concat_ws(':', user_id, rn, 42)), user_id, rn LIMIT 1000""")

# ---------------------------------------------------------------- features
# the genres of the binding and their flag columns, written out
DATA_GENRES = ("anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate",
               "red", "ring", "rod", "small", "widget", "(no genres listed)")


def genre_column(genre: str) -> str:
    return "genre_no_genres_listed" if genre.startswith("(") else f"genre_{genre}"


def _flag(g: str) -> str:
    return f"CAST(list_contains(string_split(genres, '|'), '{g}') AS BIGINT)"


FLAGS = ",\n       ".join(f"{_flag(g)} AS {genre_column(g)}" for g in DATA_GENRES)
FLAG_COLS = ", ".join(genre_column(g) for g in DATA_GENRES)

FEAT = f"""
flags AS (SELECT item_id, {FLAGS} FROM items),
yr AS (SELECT item_id, title,
              TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\)', 1) AS INTEGER) AS y FROM items),
years AS (SELECT item_id, title,
                 CAST(coalesce(nullif(y, 0), (SELECT quantile_disc(y, 0.5) FROM yr WHERE y > 0)) AS BIGINT)
                   AS release_year FROM yr),
istats AS (SELECT item_id, avg(rating) AS avg_rating, coalesce(stddev_samp(rating), 0) AS rating_std,
                  count(*) AS rating_count FROM ratings GROUP BY item_id),
ipop AS (SELECT *, percent_rank() OVER (ORDER BY rating_count) AS popularity_percentile FROM istats),
ifeat AS (SELECT i.item_id, i.title, i.genres, {", ".join("f." + genre_column(g) for g in DATA_GENRES)},
                 y.release_year, p.avg_rating, p.rating_std, p.rating_count, p.popularity_percentile
          FROM items i JOIN flags f USING (item_id) JOIN years y USING (item_id)
          JOIN ipop p USING (item_id)),
ustats AS (SELECT user_id, avg(rating) AS avg_rating, coalesce(stddev_samp(rating), 0) AS rating_std,
                  count(*) AS rating_count, min(ts) AS first_ts, max(ts) AS last_ts,
                  (max(ts) - min(ts)) / 86400.0 AS active_days FROM ratings GROUP BY user_id),
upref AS (SELECT r.user_id, {", ".join(
    f"coalesce(avg(CASE WHEN f.{genre_column(g)} = 1 THEN r.rating END), 0) AS {genre_column(g).replace('genre_', 'pref_', 1)}"
    for g in DATA_GENRES)}
          FROM ratings r JOIN flags f USING (item_id) GROUP BY r.user_id),
idx AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM ifeat)"""

R6 = lambda c: f"round({c}, 6) AS {c}"
PREF_COLS = [genre_column(g).replace("genre_", "pref_", 1) for g in DATA_GENRES]

ORACLE["item_genre_flags"] = sql(FEAT, select=f"SELECT * FROM flags")
ORACLE["item_release_year"] = sql(FEAT, select="SELECT item_id, title, release_year FROM years")
ORACLE["item_stats"] = sql(FEAT, select=f"""
SELECT item_id, {R6('avg_rating')}, {R6('rating_std')}, rating_count FROM istats""")
ORACLE["item_popularity"] = sql(FEAT, select=f"""
SELECT item_id, {R6('avg_rating')}, {R6('rating_std')}, rating_count, {R6('popularity_percentile')}
FROM ipop""")
ORACLE["item_features"] = sql(FEAT, select=f"""
SELECT item_id, title, genres, {FLAG_COLS}, release_year, {R6('avg_rating')}, {R6('rating_std')},
       rating_count, {R6('popularity_percentile')} FROM ifeat""")
ORACLE["user_stats"] = sql(FEAT, select=f"""
SELECT user_id, {R6('avg_rating')}, {R6('rating_std')}, rating_count, first_ts, last_ts,
       {R6('active_days')} FROM ustats""")
ORACLE["user_genre_pref"] = sql(FEAT, select=f"""
SELECT user_id, {", ".join(R6(c) for c in PREF_COLS)} FROM upref""")
ORACLE["user_features"] = sql(FEAT, select=f"""
SELECT s.user_id, {R6('avg_rating')}, {R6('rating_std')}, rating_count, first_ts, last_ts,
       {R6('active_days')}, {", ".join(R6(c) for c in PREF_COLS)}
FROM ustats s JOIN upref USING (user_id)""")
ORACLE["item_dense_index"] = sql(FEAT, select="SELECT item_id, idx FROM idx")


def _dec(x: str) -> str:
    return f"CAST(CAST(round({x}, 6) AS DECIMAL(38,6)) AS VARCHAR)"


ORACLE["traj_indexed"] = sql(FEAT, """
ti_seq AS (
  SELECT t.*, coalesce(i.idx, -1) AS idx,
         row_number() OVER (PARTITION BY t.user_id ORDER BY t.ts, t.item_id, t.rating) AS rn
  FROM train t LEFT JOIN idx i USING (item_id))""", select="""
SELECT a.user_id, a.rn,
  string_agg(CAST(b.idx AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn < a.rn) AS state_idx,
  a.idx AS action_idx,
  string_agg(CAST(b.idx AS VARCHAR), ',' ORDER BY b.rn) FILTER (WHERE b.rn > a.rn - 10) AS next_state_idx
FROM ti_seq a JOIN ti_seq b ON a.user_id = b.user_id AND b.rn BETWEEN a.rn - 10 AND a.rn
WHERE a.rn > 10
GROUP BY a.user_id, a.rn, a.idx""")

_VEC_PARTS = ([f"CAST({_flag(g)} AS DOUBLE)" for g in DATA_GENRES]
              + [f"CAST(least(greatest(coalesce(y.release_year, 1990), 1900), 2030) // 10 - 190 = {b} AS DOUBLE)"
                 for b in range(14)]
              + ["coalesce(p.avg_rating, 3.5)", "coalesce(p.rating_std, 0.5)",
                 "coalesce(p.popularity_percentile, 0.5)"])
ORACLE["item_content_vector"] = sql(FEAT, select=f"""
SELECT i.item_id, concat_ws(',', {", ".join(_dec(x) for x in _VEC_PARTS)}) AS vector
FROM items i LEFT JOIN years y USING (item_id) LEFT JOIN ipop p USING (item_id)""")

# ---------------------------------------------------------------- time windows
TIME = """
tb AS (SELECT min(ts) AS t_min, max(ts) AS t_max, (max(ts) - min(ts)) / 4.0 AS w FROM ratings),
aw AS (SELECT r.*, CAST(CASE WHEN tb.w > 0 THEN least(3, floor((r.ts - tb.t_min) / tb.w)) ELSE 0 END AS BIGINT)
                     AS window_id
       FROM ratings r, tb),
rounds AS (SELECT CAST(r AS BIGINT) AS round, CAST(w AS BIGINT) AS window_id,
                  CASE WHEN w = r THEN 'test' ELSE 'train' END AS part
           FROM range(1, 4) t1(r), range(0, 4) t2(w) WHERE w <= r),
rdata AS (SELECT round, part, user_id, item_id, rating, ts FROM aw JOIN rounds USING (window_id)),
relig AS (SELECT round, count(*) AS train_rows, count(DISTINCT user_id) AS train_users,
                 CAST(count(*) >= 11 * count(DISTINCT user_id) AS BIGINT) AS eligible
          FROM rdata WHERE part = 'train' GROUP BY round),
rtrain AS (SELECT round, user_id, item_id, rating, ts FROM rdata
           WHERE part = 'train' AND round IN (SELECT round FROM relig WHERE eligible = 1))"""

ORACLE["time_window_stats"] = sql(TIME, select="""
SELECT CAST(ids.window_id AS BIGINT) AS window_id,
       round(tb.t_min + tb.w * ids.window_id, 6) AS t_start,
       round(tb.t_min + tb.w * (ids.window_id + 1.0), 6) AS t_end,
       coalesce(s.n_ratings, 0) AS n_ratings, coalesce(s.n_users, 0) AS n_users
FROM range(0, 4) ids(window_id) CROSS JOIN tb
LEFT JOIN (SELECT window_id, count(*) AS n_ratings, count(DISTINCT user_id) AS n_users
           FROM aw GROUP BY window_id) s ON s.window_id = ids.window_id""")
ORACLE["backtest_rounds"] = sql(TIME, select="""
SELECT round, part, user_id, item_id, round(rating, 6) AS rating, ts FROM rdata""")
ORACLE["backtest_eligible"] = sql(TIME, select="SELECT * FROM relig")
ORACLE["backtest_trajectories"] = sql(TIME, traj_ctes("rtrain", keys="round"), select="""
SELECT round, user_id, rn, total_ratings, ts, state_item_ids, state_ratings, action_item_id,
       round(reward, 6) AS reward, next_state_item_ids, next_state_ratings
FROM traj""")

# ---------------------------------------------------------------- sources
ORACLE["user_sample"] = sql("""
su AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM ratings)
       ORDER BY md5(concat_ws(':', user_id, 42)), user_id LIMIT 1000)""", select="""
SELECT user_id, item_id, round(rating, 6) AS rating, ts FROM ratings
WHERE user_id IN (SELECT user_id FROM su)""")
ORACLE["src_csv_roundtrip"] = sql(select="""
SELECT user_id, item_id, round(rating, 6) AS rating, ts FROM interactions""")

ORACLE["src_items_csv_roundtrip"] = sql(select="SELECT item_id, title, genres, category FROM items")
ORACLE["window_metadata_json"] = ORACLE["time_window_stats"]
ORACLE["backtest_rounds_partitioned"] = sql(TIME, select="""
SELECT round, part, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       CAST(sum(ts) AS BIGINT) AS ts_sum FROM rdata WHERE round = 2 GROUP BY round, part""")
ORACLE["traj_ordered_files"] = sql("""
tn AS (SELECT user_id, greatest(count(*) - 10, 0) AS n FROM train GROUP BY user_id)""", select="""
SELECT CAST(4 AS BIGINT) AS n_files, CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS overlaps, CAST(0 AS BIGINT) AS breaks FROM tn""")
ORACLE["traj_index_inverse"] = sql("""
often AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx
          FROM (SELECT item_id FROM train GROUP BY item_id HAVING count(*) >= 30))""", """
ts2 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id, rating) AS rn FROM train)""", select="""
SELECT t.user_id, t.rn, coalesce(o.idx, -1) AS idx, coalesce(o.item_id, -1) AS item_id FROM ts2 t LEFT JOIN often o USING (item_id)
WHERE t.rn > 10""")
ORACLE["cold_start_strict"] = sql("""
si AS (SELECT * FROM interactions WHERE item_id IN (
         SELECT item_id FROM interactions GROUP BY item_id HAVING count(*) >= 28))""", select="""
SELECT user_id, item_id, round(rating, 6) AS rating, ts FROM si WHERE user_id IN (
  SELECT user_id FROM si GROUP BY user_id HAVING count(*) >= 30)""")
ORACLE["item_content_vector_sparse"] = ORACLE["item_content_vector"].replace(
    "FROM ratings GROUP BY item_id",
    "FROM ratings WHERE ts > (SELECT max(ts) FROM ratings) - 2592000 GROUP BY item_id")

# ---------------------------------------------------------------- item-item CF
def cf_ctes(src: str = "ratings", min_co: int = 3, keys: str = "") -> str:
    kk = f"{keys}, " if keys else ""
    kj = "".join(f"a.{c} = b.{c} AND " for c in keys.split(",") if c) if keys else ""
    ka = "".join(f"a.{c}, " for c in keys.split(",") if c) if keys else ""
    kp = "".join(f"p.{c} = na.{c} AND " for c in keys.split(",") if c) if keys else ""
    kq = "".join(f"p.{c} = nb.{c} AND " for c in keys.split(",") if c) if keys else ""
    kpp = "".join(f"p.{c}, " for c in keys.split(",") if c) if keys else ""
    return f"""
ui AS (SELECT {kk}user_id, item_id, avg(rating) AS rating FROM {src} GROUP BY {kk}user_id, item_id),
um AS (SELECT {kk}user_id, avg(rating) AS user_mean FROM ui GROUP BY {kk}user_id),
cen AS (SELECT ui.*, um.user_mean, ui.rating - um.user_mean AS centered FROM ui JOIN um USING ({kk}user_id)),
nrm AS (SELECT {kk}item_id, CASE WHEN sqrt(sum(centered * centered)) = 0 THEN 1e-10
                              ELSE sqrt(sum(centered * centered)) END AS norm
        FROM cen GROUP BY {kk}item_id),
pairs AS (SELECT {ka}a.item_id AS item_a, b.item_id AS item_b, sum(a.centered * b.centered) AS dot,
                 count(*) AS co
          FROM cen a JOIN cen b ON {kj}a.user_id = b.user_id AND a.item_id < b.item_id
          GROUP BY {ka}a.item_id, b.item_id),
sims AS (SELECT {kpp}p.item_a, p.item_b, p.dot / (na.norm * nb.norm) AS sim, p.co AS co_raters
         FROM pairs p JOIN nrm na ON {kp}na.item_id = p.item_a JOIN nrm nb ON {kq}nb.item_id = p.item_b
         WHERE p.co >= {min_co}),
liked AS (SELECT {kk}user_id, item_id, rating FROM cen WHERE rating >= user_mean),
nb AS (SELECT {kk}item_a AS item_id, item_b AS neighbor, sim FROM sims
       UNION ALL SELECT {kk}item_b, item_a, sim FROM sims),
cand AS (SELECT {"".join(f"l.{c}, " for c in keys.split(",") if c) if keys else ""}l.user_id, nb.neighbor AS item_id,
                sum(nb.sim) AS evidence, sum(nb.sim * l.rating) / sum(nb.sim) AS score
         FROM liked l JOIN nb USING ({kk}item_id)
         GROUP BY {"".join(f"l.{c}, " for c in keys.split(",") if c) if keys else ""}l.user_id, nb.neighbor),
scored AS (SELECT c.* FROM cand c
           WHERE round(c.evidence, 9) > 0 AND NOT EXISTS (
             SELECT 1 FROM ui WHERE {"".join(f"ui.{x} = c.{x} AND " for x in keys.split(",") if x) if keys else ""}ui.user_id = c.user_id AND ui.item_id = c.item_id)),
recs AS (SELECT {kk}user_id, item_id, score, evidence,
                row_number() OVER (PARTITION BY {kk}user_id ORDER BY round(score, 9) DESC, item_id) AS rank
         FROM scored)"""


REC_SELECT = """
SELECT user_id, item_id, round(score, 6) AS score, round(evidence, 6) AS evidence, rank
FROM recs WHERE rank <= 20"""
TITLED = """
SELECT user_id, r.item_id, round(score, 6) AS score, round(evidence, 6) AS evidence, rank,
       coalesce(i.title, 'Item ' || r.item_id) AS item_id_title
FROM recs r LEFT JOIN items i ON i.item_id = r.item_id WHERE rank <= 20"""

ORACLE["cf_centered"] = sql(cf_ctes(), select="""
SELECT c.user_id, c.item_id, round(c.rating, 6) AS rating, round(c.user_mean, 6) AS user_mean,
       round(c.centered, 6) AS centered, round(n.norm, 6) AS item_norm
FROM cen c JOIN nrm n USING (item_id)""")
ORACLE["cf_similarity"] = sql(cf_ctes(), select="""
SELECT item_a, item_b, round(sim, 6) AS sim, co_raters FROM sims""")
ORACLE["cf_pair_counts"] = sql(cf_ctes(), select="""
SELECT count(*) AS n_pairs, count(*) FILTER (WHERE co >= 3) AS n_pairs_min_co FROM pairs""")
ORACLE["cf_top_pairs"] = sql(cf_ctes(), """
tp AS (SELECT * FROM sims ORDER BY round(sim, 9) DESC, item_a, item_b LIMIT 15)""", select="""
SELECT tp.item_a, tp.item_b, round(tp.sim, 6) AS sim, tp.co_raters, a.title AS title_a, b.title AS title_b
FROM tp LEFT JOIN items a ON a.item_id = tp.item_a LEFT JOIN items b ON b.item_id = tp.item_b""")
ORACLE["cf_recommend"] = sql(cf_ctes(), select=TITLED)
ORACLE["cf_recommend_unfiltered"] = sql(cf_ctes(min_co=1), select=REC_SELECT.replace(
    "round(score, 6)", "floor(score * 1e3 + 0.5) / 1e3"))
ORACLE["cf_explain"] = sql(cf_ctes(), """
first AS (SELECT user_id, item_id AS rec_item FROM recs WHERE rank = 1)""", """
contrib AS (
  SELECT f.user_id, f.rec_item, l.item_id AS liked_item_id, l.rating, nb.sim, nb.sim * l.rating AS contribution
  FROM first f JOIN liked l USING (user_id)
  JOIN nb ON nb.item_id = l.item_id AND nb.neighbor = f.rec_item
  WHERE nb.sim > 0)""", select="""
SELECT user_id, x.item_id, liked_item_id, round(rating, 6) AS rating, round(sim, 6) AS sim,
       round(contribution, 6) AS contribution, rank,
       coalesce(a.title, 'Item ' || x.item_id) AS item_id_title,
       coalesce(b.title, 'Item ' || x.liked_item_id) AS liked_item_id_title
FROM (SELECT user_id, rec_item AS item_id, liked_item_id, rating, sim, contribution,
             row_number() OVER (PARTITION BY user_id ORDER BY round(contribution, 9) DESC, liked_item_id) AS rank
      FROM contrib) x LEFT JOIN items a ON a.item_id = x.item_id
      LEFT JOIN items b ON b.item_id = x.liked_item_id WHERE rank <= 5""")

# ---------------------------------------------------------------- recommenders and ranking
def list_recs(train: str, users: str, order: str, name: str, keys: str = "") -> str:
    """Brute-force top-20 over users x items, seen items removed."""
    K = [c.strip() for c in keys.split(",") if c.strip()]
    kk = "".join(f"{c}, " for c in K)
    ku = "".join(f"u.{c}, " for c in K)
    kj = "".join(f"p.{c} = u.{c} AND " for c in K)
    ks = "".join(f"s.{c} = u.{c} AND " for c in K)
    return f"""
{name}_items AS (SELECT {kk}item_id, count(*) AS n FROM {train} GROUP BY {kk}item_id),
{name}_rank AS (SELECT {kk}item_id, n, row_number() OVER (PARTITION BY {kk or "NULL, "[:-2] if not K else kk[:-2]} ORDER BY {order}) AS list_rank
                FROM {name}_items),
{name} AS (
  SELECT {kk}user_id, item_id, rank FROM (
    SELECT {ku}u.user_id, p.item_id,
           row_number() OVER (PARTITION BY {ku}u.user_id ORDER BY p.list_rank) AS rank
    FROM {users} u JOIN {name}_rank p ON {kj}TRUE
    WHERE NOT EXISTS (SELECT 1 FROM {train} s WHERE {ks}s.user_id = u.user_id AND s.item_id = p.item_id))
  WHERE rank <= 20)"""


def eval_ctes(recs: str, held: str, mode: str, keys: str = "", p: str = "e",
              ks=(5, 10, 20)) -> str:
    K = [c.strip() for c in keys.split(",") if c.strip()]
    kk = "".join(f"{c}, " for c in K)
    miss = "0.0" if mode == "user" else "((0.0 - 0.5) / 4.5)"
    sums = ",\n         ".join(
        [f"sum(CASE WHEN rank <= {k} THEN (pow(2, g) - 1) / log2(rank + 1) ELSE 0 END) AS dcg_{k}"
         for k in ks]
        + [f"count(*) FILTER (WHERE rank <= {k} AND g >= 0.6) AS hits_{k}" for k in ks]
        + ["min(CASE WHEN g >= 0.6 THEN rank END) AS first_rel"])
    parts = [f"""
{p}_rel AS (SELECT {kk}user_id, item_id, (max(rating) - 0.5) / 4.5 AS rel FROM {held}
            GROUP BY {kk}user_id, item_id)""", f"""
{p}_users AS (SELECT DISTINCT {kk}user_id FROM {p}_rel)""", f"""
{p}_hits AS (SELECT r.*, coalesce(t.rel, {miss}) AS g
             FROM {recs} r LEFT JOIN {p}_rel t USING ({kk}user_id, item_id))""", f"""
{p}_pu AS (SELECT {kk}user_id, {sums} FROM {p}_hits GROUP BY {kk}user_id)"""]
    if mode == "user":
        idcg = ", ".join(f"sum(CASE WHEN pos <= {k} THEN (pow(2, rel) - 1) / log2(pos + 1) ELSE 0 END) AS idcg_{k}"
                         for k in ks)
        parts.append(f"""
{p}_ideal AS (SELECT {kk}user_id, {idcg}, count(*) FILTER (WHERE rel >= 0.6) AS n_rel
              FROM (SELECT *, row_number() OVER (PARTITION BY {kk}user_id ORDER BY rel DESC, item_id) AS pos
                    FROM {p}_rel) GROUP BY {kk}user_id)""")
    else:
        vals = ", ".join(f"({k})" for k in ks)
        idcg = ", ".join(f"sum(CASE WHEN kv = {k} THEN (pow(2, g) - 1) / log2(pos + 1) ELSE 0 END) AS idcg_{k}"
                         for k in ks)
        parts.append(f"""
{p}_ideal AS (SELECT {kk}user_id, {idcg}, 0 AS n_rel FROM (
                SELECT h.*, kv.kv, row_number() OVER (PARTITION BY {''.join(f'h.{c}, ' for c in K)}h.user_id, kv.kv
                                                      ORDER BY h.g DESC, h.rank) AS pos
                FROM {p}_hits h JOIN (VALUES {vals}) kv(kv) ON h.rank <= kv.kv)
              GROUP BY {kk}user_id)""")
    mcols = []
    for k in ks:
        mcols.append(f"CASE WHEN coalesce(idcg_{k}, 0) > 0 THEN coalesce(dcg_{k}, 0) / idcg_{k} ELSE 0 END AS ndcg_{k}")
        if mode == "user":
            mcols.append(f"CASE WHEN coalesce(n_rel, 0) > 0 THEN coalesce(hits_{k}, 0) / n_rel ELSE 0 END AS recall_{k}")
        else:
            mcols.append(f"CASE WHEN coalesce(hits_{k}, 0) > 0 THEN 1.0 ELSE 0.0 END AS recall_{k}")
        mcols.append(f"coalesce(hits_{k}, 0) / {float(k)} AS precision_{k}")
    mcols.append("coalesce(1.0 / first_rel, 0) AS mrr")
    parts.append(f"""
{p}_m AS (SELECT {kk}user_id, {", ".join(mcols)}
          FROM {p}_users LEFT JOIN {p}_pu USING ({kk}user_id) LEFT JOIN {p}_ideal USING ({kk}user_id))""")
    unions = []
    for k in ks:
        for m in ("ndcg", "recall", "precision"):
            unions.append(f"SELECT {kk}'{m}' AS metric, CAST({k} AS BIGINT) AS k, {m}_{k} AS v FROM {p}_m")
    unions.append(f"SELECT {kk}'mrr', CAST({max(ks)} AS BIGINT), mrr FROM {p}_m")
    parts.append(f"""
{p}_long AS ({" UNION ALL ".join(unions)})""")
    parts.append(f"""
{p}_sum AS (SELECT {kk}metric, k, avg(v) AS mean, stddev_pop(v) AS std, count(*) AS n_users
            FROM {p}_long GROUP BY {kk}metric, k)""")
    return ",".join(parts)


def pivot_select(src: str, keys: str, ks=(5, 10, 20), places: int | None = 6) -> str:
    r = (lambda x: f"round({x}, {places})") if places else (lambda x: x)
    cols = []
    for m in ("ndcg", "recall", "precision"):
        for k in ks:
            cols.append(f"{r(f'max(CASE WHEN metric = {chr(39)}{m}{chr(39)} AND k = {k} THEN mean END)')} AS {m}_{k}")
    cols.append(f"{r('max(CASE WHEN metric = {q}mrr{q} THEN mean END)'.format(q=chr(39)))} AS mrr")
    cols.append("max(n_users) AS n_users")
    return f"SELECT {keys}, {', '.join(cols)} FROM {src} GROUP BY {keys}"


USERS = "tusers AS (SELECT DISTINCT user_id FROM test)"
POP = list_recs("train", "tusers", "n DESC, item_id", "prec")
RND = list_recs("train", "tusers", "md5(concat_ws(':', item_id, 42)), item_id", "rrec")

ORACLE["rec_popularity"] = sql(USERS, POP, select="SELECT user_id, item_id, rank FROM prec")
ORACLE["rec_random"] = sql(USERS, RND, select="SELECT user_id, item_id, rank FROM rrec")
ORACLE["candidates_top"] = sql(select="""
SELECT item_id, rating_count, rank FROM (
  SELECT item_id, count(*) AS rating_count,
         row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank
  FROM train GROUP BY item_id) WHERE rank <= 2000""")

EVAL_SELECT = """
SELECT metric, k, round(mean, 6) AS mean, round(std, 6) AS std, n_users FROM e_sum"""
ORACLE["eval_ranking"] = sql(USERS, POP, eval_ctes("prec", "test", "user"), select=EVAL_SELECT)
ORACLE["eval_ranking_list"] = sql(USERS, POP, eval_ctes("prec", "test", "list"), select=EVAL_SELECT)

ORACLE["eval_compare"] = sql(
    USERS, POP, RND, cf_ctes("train"),
    eval_ctes("prec", "test", "user", p="ep"), eval_ctes("rrec", "test", "user", p="er"),
    """cfrec AS (SELECT user_id, item_id, rank FROM recs WHERE rank <= 20)""",
    eval_ctes("cfrec", "test", "user", p="ec"), """
allsum AS (SELECT 'popularity' AS method, * FROM ep_sum UNION ALL SELECT 'random', * FROM er_sum
           UNION ALL SELECT 'itemcf', * FROM ec_sum)""", select=pivot_select("allsum", "method"))

RTIME = TIME + """,
rtr AS (SELECT round, user_id, item_id, rating, ts FROM rdata WHERE part = 'train'),
rte AS (SELECT round, user_id, item_id, rating, ts FROM rdata WHERE part = 'test'),
rusers AS (SELECT DISTINCT round, user_id FROM rte)"""
RPOP = list_recs("rtr", "rusers", "n DESC, item_id", "rprec", keys="round")
ORACLE["backtest_curve"] = sql(RTIME, RPOP, eval_ctes("rprec", "rte", "user", keys="round", p="bp"),
                               select=f"""
SELECT c.*, r.train_rows FROM ({pivot_select("bp_sum", "round")}) c
JOIN (SELECT round, count(*) AS train_rows FROM rtr GROUP BY round) r USING (round)""")

ORACLE["backtest_compare"] = sql(
    RTIME, RPOP, eval_ctes("rprec", "rte", "user", keys="round", p="bp"),
    cf_ctes("rtr", keys="round"), """
rcf AS (SELECT round, user_id, item_id, rank FROM recs WHERE rank <= 20)""",
    eval_ctes("rcf", "rte", "user", keys="round", p="bc"), f"""
cp AS ({pivot_select("bp_sum", "round", places=None)})""", f"""
cc AS ({pivot_select("bc_sum", "round", places=None)})""", """
j AS (SELECT cp.round, cp.ndcg_10 AS a, cc.ndcg_10 AS b FROM cp JOIN cc USING (round))""", """
ends AS (SELECT arg_min(a, round) AS fa, arg_max(a, round) AS la,
                arg_min(b, round) AS fb, arg_max(b, round) AS lb FROM j)""", select="""
SELECT round, round(a, 6) AS ndcg_10_popularity, round(b, 6) AS ndcg_10_itemcf, round(b - a, 6) AS delta,
       CASE WHEN b - a > 0.003 THEN 'itemcf wins' WHEN b - a < -0.003 THEN 'popularity wins' ELSE 'tie' END AS verdict,
       round(CASE WHEN fa <> 0 THEN (la / fa - 1) * 100 END, 6) AS change_popularity_pct,
       round(CASE WHEN fb <> 0 THEN (lb / fb - 1) * 100 END, 6) AS change_itemcf_pct
FROM j, ends""")

# ---------------------------------------------------------------- off-policy evaluation
PROP = """
prop AS (SELECT item_id, count(*) AS n, count(*) / (SELECT count(*) FROM test) AS propensity,
                avg(rating) AS mean_reward FROM test GROUP BY item_id)"""
ORACLE["ope_propensity"] = sql(PROP, select="""
SELECT item_id, n, round(propensity, 6) AS propensity, round(mean_reward, 6) AS mean_reward FROM prop""")


def _stack_sql(src: str, pairs: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS estimator, round({e}, 6) AS value FROM {src}"
                               for n, e in pairs)


ORACLE["ope_summary"] = sql(PROP, """
tj AS (SELECT t.rating AS r, p.propensity AS p, p.mean_reward AS rhat FROM test t JOIN prop p USING (item_id))""", """
agg AS (SELECT avg(r / p) AS ips_raw, stddev_samp(r / p) AS ips_std, avg(least(r / p, 10.0)) AS ips_clipped,
               sum(r / p) / sum(1 / p) AS ips_sn, avg(rhat) AS dm_value, avg(r - rhat) AS dm_bias,
               avg((1 / p) * (r - rhat)) AS correction_term,
               avg(rhat) + avg((1 / p) * (r - rhat)) AS v_dr,
               avg(rhat) + avg(least(1 / p, 10.0) * (r - rhat)) AS v_dr_clipped,
               avg(r) AS actual_avg FROM tj)""", select=_stack_sql("agg", [
    (n, n) for n in ("ips_raw", "ips_std", "ips_clipped", "ips_sn", "dm_value", "dm_bias",
                     "correction_term", "v_dr", "v_dr_clipped", "actual_avg")]))

ORACLE["ope_policy"] = sql("""
tm AS (SELECT item_id, count(*) / (SELECT count(*) FROM train) AS pi_b, avg(rating) AS rhat
       FROM train GROUP BY item_id)""", """
gm AS (SELECT avg(rating) AS g FROM train)""", """
pe AS (SELECT item_id, CAST(1 AS DOUBLE) / 20 AS pi_e FROM (
         SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS rk
         FROM train GROUP BY item_id) WHERE rk <= 20)""", """
model AS (SELECT coalesce(tm.item_id, pe.item_id) AS item_id, tm.pi_b,
                 coalesce(tm.rhat, (SELECT g FROM gm)) AS rhat, coalesce(pe.pi_e, 0) AS pi_e
          FROM tm FULL JOIN pe ON tm.item_id = pe.item_id)""", """
dm AS (SELECT sum(pi_e * rhat) AS dm FROM model)""", """
lj AS (SELECT t.rating AS r, CASE WHEN m.pi_b > 0 THEN m.pi_e / m.pi_b ELSE 0 END AS w,
              coalesce(m.rhat, (SELECT g FROM gm)) AS rhat
       FROM test t LEFT JOIN model m USING (item_id))""", """
agg AS (SELECT avg(w * r) AS ips, avg(least(w, 10.0) * r) AS ips_clipped,
               CASE WHEN sum(w) > 0 THEN sum(w * r) / sum(w) END AS ips_sn,
               (SELECT dm FROM dm) AS dm_value,
               (SELECT dm FROM dm) + avg(w * (r - rhat)) AS v_dr,
               (SELECT dm FROM dm) + avg(least(w, 10.0) * (r - rhat)) AS v_dr_clipped,
               avg(r) AS actual_avg FROM lj)""", select=_stack_sql("agg", [
    (n, n) for n in ("ips", "ips_clipped", "ips_sn", "dm_value", "v_dr", "v_dr_clipped", "actual_avg")]))

# ---------------------------------------------------------------- tabular policies
POLICY = """
pseq AS (SELECT t.*, i.category,
                row_number() OVER (PARTITION BY t.user_id ORDER BY t.ts, t.item_id, t.rating) AS rn
         FROM train t JOIN items i USING (item_id)),
scat AS (SELECT a.user_id, a.rn, b.category, avg(b.rating) AS m FROM pseq a JOIN pseq b
           ON a.user_id = b.user_id AND b.rn BETWEEN a.rn - 10 AND a.rn - 1
         WHERE a.rn > 10 GROUP BY a.user_id, a.rn, b.category),
ncat AS (SELECT a.user_id, a.rn, b.category, avg(b.rating) AS m FROM pseq a JOIN pseq b
           ON a.user_id = b.user_id AND b.rn BETWEEN a.rn - 9 AND a.rn
         WHERE a.rn > 10 GROUP BY a.user_id, a.rn, b.category),
spick AS (SELECT user_id, rn, category AS s FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, rn ORDER BY m DESC, category) AS o FROM scat)
          WHERE o = 1),
npick AS (SELECT user_id, rn, category AS s2 FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, rn ORDER BY m DESC, category) AS o FROM ncat)
          WHERE o = 1),
trans AS (SELECT sp.s AS state, a.category AS action, (a.rating - 0.5) / 4.5 AS reward, np.s2 AS next_state
          FROM pseq a JOIN spick sp USING (user_id, rn) JOIN npick np USING (user_id, rn) WHERE a.rn > 10),
beh AS (SELECT state, action, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY state) AS pi_b
        FROM trans GROUP BY state, action),
sa AS (SELECT state, action, count(*) AS n_sa, avg(reward) AS rbar FROM trans GROUP BY state, action),
sas AS (SELECT t.state, t.action, t.next_state, count(*) / max(sa.n_sa) AS p FROM trans t
        JOIN sa USING (state, action) GROUP BY t.state, t.action, t.next_state)"""


def q_ctes(tau: float, name: str) -> str:
    """Value iteration by recursion until its error is far below the digits shown
    (0.99^2600 < 1e-11); a state without a logged action loops with reward 0."""
    return f"""
{name}_ok AS (SELECT state, action FROM (
                SELECT *, max(pi_b) OVER (PARTITION BY state) AS mx FROM beh)
              WHERE pi_b >= {tau} * mx),
{name}_dead AS (SELECT DISTINCT next_state AS state FROM sas WHERE next_state NOT IN (SELECT state FROM sa)),
{name}_r AS MATERIALIZED (SELECT sa.state, sa.action, rbar FROM sa JOIN {name}_ok USING (state, action)
               UNION ALL SELECT state, '', 0 FROM {name}_dead),
{name}_p AS MATERIALIZED (SELECT sas.state, sas.action, next_state, p FROM sas JOIN {name}_ok USING (state, action)
               UNION ALL SELECT state, '', state, 1 FROM {name}_dead),
{name}_it AS (
  SELECT 0 AS t, state, CAST(0 AS DOUBLE) AS v FROM (SELECT DISTINCT state FROM {name}_r)
  UNION ALL
  SELECT t + 1, r.state, max(r.rbar + 0.99 * e.ev) FROM (
    SELECT it.t, p.state, p.action, sum(p.p * it.v) AS ev FROM {name}_it it
    JOIN {name}_p p ON p.next_state = it.state WHERE it.t < 2600 GROUP BY it.t, p.state, p.action) e
  JOIN {name}_r r ON r.state = e.state AND r.action = e.action GROUP BY t, r.state),
{name}_v AS (SELECT state AS next_state, v FROM {name}_it WHERE t = 2600),
{name}_q AS (SELECT sa.state, sa.action, sa.rbar + 0.99 * coalesce(e.ev, 0) AS q FROM sa LEFT JOIN (
               SELECT sas.state, sas.action, sum(sas.p * coalesce(v.v, 0)) AS ev FROM sas
               LEFT JOIN {name}_v v USING (next_state) GROUP BY sas.state, sas.action) e
             USING (state, action))"""


ORACLE["policy_behaviour"] = sql(POLICY, select="""
SELECT state, action, n, round(pi_b, 6) AS pi_b FROM beh""")
ORACLE["q_unconstrained"] = sql(POLICY, q_ctes(0.0, "qu"), select="""
SELECT state, action, round(q, 6) AS q FROM qu_q""")
ORACLE["q_constrained"] = sql(POLICY, q_ctes(0.3, "qc"), select="""
SELECT state, action, round(q, 6) AS q FROM qc_q""")
GREEDY = """
SELECT state, action, q FROM (
  SELECT q.*, row_number() OVER (PARTITION BY q.state ORDER BY round(q.q, 9) DESC, q.action) AS o
  FROM {src} q JOIN {ok} USING (state, action)) WHERE o = 1"""
ORACLE["policy_greedy"] = sql(POLICY, q_ctes(0.3, "qc"), select=f"""
SELECT state, action, round(q, 6) AS q FROM ({GREEDY.format(src="qc_q", ok="qc_ok")})""")
ORACLE["policy_compare"] = sql(POLICY, q_ctes(0.0, "qu"), q_ctes(0.3, "qc"),
                               f"gu AS ({GREEDY.format(src='qu_q', ok='qu_ok')})",
                               f"gc AS ({GREEDY.format(src='qc_q', ok='qc_ok')})", select="""
SELECT coalesce(gu.state, gc.state) AS state, gu.action AS action_unconstrained,
       round(gu.q, 6) AS q_unconstrained, gc.action AS action_constrained,
       round(gc.q, 6) AS q_constrained, CAST(gu.action = gc.action AS BIGINT) AS same_action
FROM gu FULL JOIN gc ON gu.state = gc.state""")

ORACLE["policy_compare_strict"] = ORACLE["policy_compare"].replace("pi_b >= 0.3 * mx", "pi_b >= 0.97 * mx")

DECADES = POLICY.replace("i.category", r"""coalesce(nullif(regexp_extract(i.title, '\((\d{3})\d\)', 1), '') || '0s',
                'undated') AS category""", 1)
ORACLE["policy_compare_decade"] = ORACLE["policy_compare"].replace(POLICY.strip(), DECADES.strip())
ORACLE["policy_behaviour_decade"] = sql(DECADES, select="""
SELECT state, action, n, round(pi_b, 6) AS pi_b,
       CAST(pi_b >= 0.3 * max(pi_b) OVER (PARTITION BY state) AS BIGINT) AS allowed FROM beh""")


def _value(name: str, src: str, ok: str) -> str:
    return f"""
SELECT '{name}' AS policy, round(avg(w * reward), 6) AS ips,
       round(avg(least(w, 10.0) * reward), 6) AS ips_clipped,
       round(sum(w * reward) / sum(w), 6) AS ips_sn, round(avg(w), 6) AS coverage
FROM (SELECT t.reward, CASE WHEN g.action = t.action THEN 1 / b.pi_b ELSE 0 END AS w
      FROM trans t JOIN beh b USING (state, action)
      LEFT JOIN ({GREEDY.format(src=src, ok=ok)}) g ON g.state = t.state)"""


ORACLE["policy_value"] = sql(
    POLICY, q_ctes(0.0, "qu"), q_ctes(0.3, "qc"), q_ctes(0.97, "qs"),
    select=" UNION ALL ".join([_value("unconstrained", "qu_q", "qu_ok"), _value("constrained", "qc_q", "qc_ok"),
                               _value("strict", "qs_q", "qs_ok")]))

# ---------------------------------------------------------------- vector retrieval
ORACLE["vec_topk"] = sql("""
eq AS (SELECT e.vec_id, CAST(e.embedding AS DOUBLE[]) AS v FROM embeddings e
       WHERE e.vec_id % 50 = 0)""", """
ev AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""", """
vs AS (SELECT q.vec_id AS query_id, e.vec_id,
              list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v))) AS score
       FROM eq q JOIN ev e ON e.vec_id <> q.vec_id)""", select="""
SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM vs)
WHERE rank <= 10""")

ORACLE["rec_content_knn"] = sql(FEAT.replace("FROM ratings GROUP BY item_id", "FROM train GROUP BY item_id"),
                                USERS, f"""
cvec AS (SELECT i.item_id, list_value({", ".join(_VEC_PARTS)}) AS v
         FROM items i LEFT JOIN years y USING (item_id) LEFT JOIN ipop p USING (item_id))""", """
hist AS (SELECT * FROM (SELECT t.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC, rating DESC) AS p
                        FROM train t) WHERE p <= 10)""", """
hw AS (SELECT h.user_id, (h.rating - 0.5) / 4.5 AS w, c.v FROM hist h JOIN cvec c USING (item_id))""", """
hd AS (SELECT user_id, d, sum(w * v[d]) AS sw, sum(v[d]) AS sp, sum(w) AS ws
       FROM hw, range(1, 35) r(d) GROUP BY user_id, d)""", """
uvec AS (SELECT user_id, list(CASE WHEN ws > 0 THEN sw ELSE sp END ORDER BY d) AS u FROM hd GROUP BY user_id)""", """
sc AS (SELECT u.user_id, c.item_id,
              list_dot_product(u.u, c.v) / (sqrt(list_dot_product(u.u, u.u)) * sqrt(list_dot_product(c.v, c.v))) AS score
       FROM uvec u JOIN tusers USING (user_id) CROSS JOIN cvec c
       WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = u.user_id AND s.item_id = c.item_id))""", select="""
SELECT user_id, item_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM sc)
WHERE rank <= 20""")


# ---------------------------------------------------------------- further forms
ORACLE["cold_start_kcore"] = sql("""
core_it AS (
  SELECT 0 AS step, user_id, item_id, rating, ts FROM interactions
  UNION ALL
  SELECT step + 1, user_id, item_id, rating, ts
  FROM (SELECT *, count(*) FILTER (WHERE ci < 20 OR cu < 28) OVER () AS low
        FROM (SELECT *, count(*) OVER (PARTITION BY item_id) AS ci,
                     count(*) OVER (PARTITION BY user_id) AS cu FROM core_it))
  WHERE low > 0 AND ci >= 20 AND cu >= 28)""", select="""
SELECT user_id, item_id, round(rating, 6) AS rating, ts
FROM (SELECT *, count(*) OVER (PARTITION BY item_id) AS ci, count(*) OVER (PARTITION BY user_id) AS cu
      FROM core_it WHERE step = (SELECT max(step) FROM core_it))
WHERE ci >= 20 AND cu >= 28""")

ORACLE["traj_sample_replay"] = ORACLE["traj_sample"].replace("LIMIT 1000", "LIMIT 100000")

ORACLE["time_window_stats_stream"] = ORACLE["time_window_stats"]

ORACLE["round_metadata_json"] = sql(TIME, traj_ctes("rtrain", keys="round"), select="""
SELECT e.round, 'round_' || e.round || '_trajectories.parquet' AS trajectory_file, e.train_rows, e.train_users,
       coalesce(t.test_rows, 0) AS test_rows, coalesce(t.test_users, 0) AS test_users, e.eligible,
       coalesce(j.n, 0) AS n_trajectories
FROM relig e
LEFT JOIN (SELECT round, count(*) AS test_rows, count(DISTINCT user_id) AS test_users
           FROM rdata WHERE part = 'test' GROUP BY round) t USING (round)
LEFT JOIN (SELECT round, count(*) AS n FROM traj GROUP BY round) j USING (round)""")

ORACLE["approx_quantiles"] = sql(FEAT, TIME, traj_ctes("train"), """
sizes AS (SELECT 'release_year' AS metric, 0 AS round, count(*) AS n FROM years
          UNION ALL SELECT 'traj_per_user', 0, count(DISTINCT user_id) FROM traj
          UNION ALL SELECT 'rating_time', round, count(*) FROM rdata WHERE part = 'train' GROUP BY round)""",
    select="""
SELECT metric, CAST(round AS BIGINT) AS round, CAST(p AS DOUBLE) AS p, n, CAST(1 AS BIGINT) AS ok
FROM sizes, (VALUES (0.5), (0.99)) probs(p)
WHERE n > 0""")

_TARGETS = """
targets AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM ratings)
            ORDER BY md5(concat_ws(':', user_id, 42)), user_id LIMIT 20)"""
ORACLE["cf_recommend_target"] = sql(_TARGETS, cf_ctes(min_co=1).replace(
    "WHERE rating >= user_mean", "WHERE rating >= user_mean AND user_id IN (SELECT user_id FROM targets)"),
    select=TITLED.replace("round(score, 6)", "floor(score * 1e3 + 0.5) / 1e3"))

ORACLE["traj_indexed_unknown"] = ORACLE["traj_indexed"].replace(
    "idx AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM ifeat)",
    "idx AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx"
    " FROM (SELECT item_id FROM train GROUP BY item_id HAVING count(*) >= 30))")

ORACLE["item_features_recent"] = ORACLE["item_features"].replace(
    "FROM ratings GROUP BY item_id",
    "FROM ratings WHERE ts > (SELECT max(ts) FROM ratings) - 2592000 GROUP BY item_id")

ORACLE["cf_recommend_untitled"] = sql(cf_ctes(), """
known AS (SELECT item_id, CASE WHEN genres <> '(no genres listed)' THEN title END AS title
          FROM items WHERE contains(title, '('))""", select=TITLED.replace("JOIN items i", "JOIN known i"))

for _name in list(ORACLE):
    ORACLE[_name] = _half_up(ORACLE[_name])
