"""Exact top-k search by inner product over norm-sorted vectors.

Components become integers, so scores are exact. All vectors are ranked by
descending length and packed into blocks of consecutive ranks. A query visits the
blocks in that order, in rounds that grow fourfold (1, 4, 16, ... blocks): after a
round its k-th best score is known, and by Cauchy-Schwarz no block whose longest
vector is shorter than that score over the query's length can hold a better one.
Inside a block vectors and queries stand in the basis of the right singular
vectors of a sample, which gathers most of a product in the first coordinates: a
partial sum over them plus the product of the two residual lengths bounds the
score; only pairs whose bound reaches the k-th best go on to the next coordinates
and at last to the exact integer product. Bounds carry a margin over rounding and
a pair that may tie is never pruned, so the answer is exact.

Scale: a task scores one block of at most ``BLOCK_ROWS`` vectors for one pack of
about ``QUERY_ROWS`` queries, both of bounded size; packs and blocks meet in an
equality join on the block, which AQE splits where a block is asked for by very
many packs; the first rounds broadcast their few blocks (``BROADCAST_BYTES`` at
most). At most k rows a query and block leave a task. The rotation is fitted on a
bounded sample (see ``vectors.sample``); only speed depends on it. The driver holds
that sample, the rotation and at most ``CUTS`` block lengths.

Defined results: a vector that is null or holds a null or non-finite component
takes no part; shorter vectors are padded with 0; an empty one scores 0. Every
other row is a candidate, also one equal to the query in all columns (repeated
rows); a row whose id is divisible but repeated asks once per row. Ties go to the
smaller id, null ids last; fewer candidates than k give fewer rows; an empty table
gives no rows. Products beyond 2^53 are computed in Python integers. Other columns
of the table are not carried, so none can clash.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.functions.ordering import global_row_number
from recflow.llm import vectors as _vectors
from recflow.llm.common import stored, table
from recflow.llm.vectors import NO_ID, best, floats, ids_of, longs, matrix, padded, products, sample, whole

# Python workers need not have this package on their path
cloudpickle.register_pickle_by_value(_vectors)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
QUERY_ROWS = 512
STEP = 512                    # vectors scored between two looks at the k-th best
CUTS = 1024
BROADCAST_BYTES = 32 << 20
GROWTH = 4

BLOCK = "block bigint, longest double, id binary, pos binary, vec binary, rot binary"
PACK = "upto bigint, qpos binary, qvec binary, qrot binary, floor binary"
FOUND = "qpos bigint, score bigint, id bigint, pos bigint"


def rotation(x: np.ndarray) -> np.ndarray:
    """Right singular vectors of the rows, largest singular value first."""
    d = x.shape[1]
    if len(x) < d:
        x = np.vstack([x, np.zeros((d - len(x), d))])
    return np.linalg.svd(np.linalg.qr(x, mode="r"))[2].T


def _pack_block(dim: int, turn: np.ndarray):
    def work(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        v = matrix(t["vec"], dim)
        return pa.table({"block": t["block"].slice(0, 1), "longest": [float(t["norm"][0].as_py())],
                         "id": [ids_of(t["id"]).tobytes()], "pos": [ids_of(t["pos"]).tobytes()],
                         "vec": [v.tobytes()], "rot": [(v @ turn).tobytes()]})
    return work


def _pack_queries(dim: int, turn: np.ndarray, start: int, end: int, cuts: list):
    """Queries of a pack with their k-th best scores, and up to which block any
    of them has to look; none if that block is before ``start``."""
    firsts = np.array([b for b, _ in cuts], dtype=np.int64)
    longest = np.array([x for _, x in cuts])

    def work(t: pa.Table) -> pa.Table:
        q = matrix(t["vec"], dim)
        floor = np.nan_to_num(t["floor"].cast(pa.float64()).to_numpy().astype(float), nan=-np.inf)
        size = np.linalg.norm(q, axis=1)
        # the first listed block all of whose vectors are too short ends the look-out
        short = (size[:, None] * longest[None, :] * (1 + 1e-9) + 1e-6 < floor[:, None]).all(axis=0)
        reach = int(firsts[np.argmax(short)]) if short.any() else end
        upto = min(end, reach)
        if upto <= start:
            return pa.table({n: pa.array([], k) for n, k in (
                ("upto", pa.int64()), *((c, pa.binary()) for c in ("qpos", "qvec", "qrot", "floor")))})
        return pa.table({"upto": [upto], "qpos": [ids_of(t["pos"]).tobytes()], "qvec": [q.tobytes()],
                         "qrot": [(q @ turn).tobytes()], "floor": [floor.tobytes()]})
    return work


def score_block(q, qr, qpos, floor, v, vr, vpos, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of every pair that may be among a query's first k,
    given the scores ``floor`` that it has reached before."""
    dim = q.shape[1]
    stages = sorted({c for c in (dim // 8, dim // 4, dim // 2) if c})
    rest = {c: (np.linalg.norm(qr[:, c:], axis=1), np.linalg.norm(vr[:, c:], axis=1)) for c in stages}
    qn, vn = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
    margin = 1e-9 * qn * vn.max(initial=0.0) + 1e-6
    tops = np.full((len(q), k), -np.inf)
    out = []
    for s in range(0, len(v), STEP):
        at = slice(s, s + STEP)
        low = np.maximum(floor, tops.min(axis=1))
        live = np.flatnonzero(qn * vn[s] + margin >= low)  # no later vector is longer
        if not len(live):
            break
        alive, part = None, None
        if stages and np.isfinite(low[live]).any():
            c = stages[0]
            part = qr[live, :c] @ vr[at, :c].T
            bound = part + rest[c][0][live, None] * rest[c][1][None, at]
            alive = bound + margin[live, None] >= low[live, None]
        if alive is None or alive.mean() > 0.25:
            exact = products(q[live], v[at])
            qi, vi = np.nonzero((exact >= low[live, None])
                                & (qpos[live, None] != vpos[None, at]))
            score, qi, vi = exact[qi, vi], live[qi], vi + s
        else:
            qi, vi = np.nonzero(alive)
            p, qi, vi = part[qi, vi], live[qi], vi + s
            for c, d in zip(stages, stages[1:]):
                p = p + np.einsum("ij,ij->i", qr[qi, c:d], vr[vi, c:d])
                keep = p + rest[d][0][qi] * rest[d][1][vi] + margin[qi] >= low[qi]
                p, qi, vi = p[keep], qi[keep], vi[keep]
            score = pair_products(q, v, qi, vi)
            keep = (score >= low[qi]) & (qpos[qi] != vpos[vi])
            score, qi, vi = score[keep], qi[keep], vi[keep]
        if len(qi):
            out.append((qi, vi, score))
            seen = np.full((len(q), STEP), -np.inf)
            seen[qi, vi - s] = score
            tops = -np.partition(-np.hstack([tops, seen]), k - 1, axis=1)[:, :k]
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    qi, vi, score = (np.concatenate(x) for x in zip(*out))
    keep = score >= np.maximum(floor, tops.min(axis=1))[qi]
    return qi[keep], vi[keep], score[keep].astype(np.int64)


def pair_products(q, v, qi, vi) -> np.ndarray:
    """Exact products of listed pairs, a slice of them at a time."""
    if len(qi) and np.linalg.norm(q, axis=1).max() * np.linalg.norm(v, axis=1).max() >= _vectors.EXACT / 2:
        return np.array([products(q[a:a + 1], v[b:b + 1])[0, 0] for a, b in zip(qi, vi)])
    return np.concatenate([np.zeros(0), *(
        np.einsum("ij,ij->i", q[qi[s:s + 65_536]], v[vi[s:s + 65_536]])
        for s in range(0, len(qi), 65_536))])


def _score(dim: int, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in
                     ("qpos", "qvec", "qrot", "floor", "id", "pos", "vec", "rot")}
                qpos, pos, ids = longs(r["qpos"]), longs(r["pos"]), longs(r["id"])
                qi, vi, score = score_block(
                    floats(r["qvec"], dim), floats(r["qrot"], dim), qpos, np.frombuffer(r["floor"]),
                    floats(r["vec"], dim), floats(r["rot"], dim), pos, k)
                first = best(qi, score, ids[vi], pos[vi], k)
                qi, vi, score = qi[first], vi[first], score[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qpos[qi]), pa.array(score.astype(np.int64)),
                     pa.array(ids[vi], mask=ids[vi] == NO_ID), pa.array(pos[vi])],
                    ["qpos", "score", "id", "pos"])
    return work


def top_k(vectors: DataFrame, k: int, asks: Column, scale: int, id_col: str = "vec_id",
          vec_col: str = "embedding", block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row with ``asks`` the ``k``
    other rows of the largest inner product."""
    spark = vectors.sparkSession
    rows = stored(vectors.select(F.col(id_col).cast("bigint").alias("id"),
                                 F.coalesce(asks, F.lit(False)).alias("asks"),
                                 whole(F.col(vec_col), scale).alias("vec"))
                  .where("vec is not null"), "ip-rows")
    n, n_asks, dim = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("vec"))).first()
    if not n_asks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = max(dim, 1)
    rows = rows.withColumn("vec", padded(F.col("vec"), dim)).withColumn(
        "norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)))
    ranked = global_row_number(rows, [F.col("norm").desc(), F.col("id")], "pos")
    turn = rotation(sample(ranked, "pos", n, dim))
    blocks = stored(ranked.withColumn("block", F.floor((F.col("pos") - 1) / F.lit(block_rows)))
                    .groupBy("block").applyInArrow(_pack_block(dim, turn), BLOCK), "ip-blocks")
    n_blocks = -(-n // block_rows)
    step = -(-n_blocks // CUTS)
    cuts = sorted(tuple(r) for r in blocks.where(F.pmod("block", F.lit(step)) == 0)
                  .select("block", "longest").collect())  # at most CUTS rows
    queries = stored(ranked.where("asks").select(
        "pos", F.col("id").alias("query_id"), "vec",
        F.pmod(F.xxhash64("pos"), F.lit(-(-n_asks // query_rows))).alias("pack")), "ip-queries")
    found, start, end = None, 0, 1
    while start < n_blocks:
        end = min(end, n_blocks)
        asked = queries.withColumn("floor", F.lit(None).cast("double"))
        if found is not None:
            kth = found.where(F.col("rank") == k).select(F.col("qpos").alias("pos"),
                                                         F.col("score").cast("double").alias("floor"))
            asked = queries.join(kth, "pos", "left")
        packs = (asked.groupBy("pack").applyInArrow(_pack_queries(dim, turn, start, end, cuts), PACK)
                 .withColumn("block", F.explode(F.sequence(F.lit(start).cast("bigint"), F.col("upto") - 1))))
        part = blocks.where((F.col("block") >= start) & (F.col("block") < end))
        small = (end - start) * block_rows * dim * 16 <= BROADCAST_BYTES
        part = F.broadcast(part) if small else part.hint("merge")
        new = packs.join(part, "block").mapInArrow(_score(dim, k), FOUND)
        if found is not None:
            new = new.unionByName(found.drop("rank"))
        order = Window.partitionBy("qpos").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "pos")
        found = stored(new.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k),
                       "ip-found")
        start, end = end, end + GROWTH * (end - start)
    return (found.join(queries.select(F.col("pos").alias("qpos"), "query_id"), "qpos")
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), 10, F.col("vec_id") % 100 == 0, 1024)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x,
    row_number() OVER () AS row_no
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.row_no, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.row_no ORDER BY list_inner_product(q.x, c.x) DESC,
                       c.vec_id NULLS LAST) AS rank
  FROM v q JOIN v c ON q.row_no <> c.row_no WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM s WHERE rank <= 10
"""
