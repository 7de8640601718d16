"""Exact mining of hard negatives through an inverted multi-index.

Components become integers, so scores are exact. Two codebooks, one for the first
half of a vector and one for the second, assign every row to a cell (one code of
each); a code also has a radius, the largest distance of its rows' halves from its
centre. For an anchor the inner product with any row of a cell is at most the sum
of two half bounds (anchor half times centre, plus its length times the radius),
and at least the like with minus. The multi-sequence heap lists cells by falling
summed bound: both halves' codes are sorted by their bound, and from a pair of
places the next ones on either side are pushed.

First the positives: cells are visited in rounds that grow fourfold until the
best unvisited bound is below the score of the last positive. Then the negatives:
each positive opens a window of scores; cells are visited until no unvisited bound
reaches the window or the last negative found in it, and cells whose lower bound
lies above all windows are skipped. So every window is certified, no cell is capped,
and the result equals a full search.

Scale: codebooks grow with the fourth root of the rows, so a cell holds about their
square root; a cell is cut into pages of about ``PAGE_ROWS`` rows by a hash of the row
number, so a cell with a third of all rows, copies included, is many pages. Anchors
that share their first code form packs of about ``PACK_ROWS``, whose bound for a
cell is the largest of theirs. A task scores a pack against a page; packs and pages
meet in an equality join on the cell, which AQE splits where a cell is hot. A pair
of tasks yields at most as many rows per anchor and window as are asked for. The
codebooks are fitted on a bounded sample (``vectors.sample``); every row is indexed,
and radii cover all rows. The driver holds the sample, the codebooks, and counts per
cell (``MAX_CODES`` squared at most).

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; shorter vectors are padded with 0; repeated rows are rows of
their own (a copy of the anchor can be its positive); ties go to the smaller id, null
ids last; an anchor without positives, or a window without negatives (every one of a
negative positive score), gives no rows; an empty table gives no rows. Other columns
of the table are not carried, so none can clash.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.llm import vectors as _vectors
from recflow.llm.common import stored, table
from recflow.llm.vectors import NO_ID, best, floats, ids_of, longs, matrix, padded, products, sample, whole

# Python workers need not have this package on their path
cloudpickle.register_pickle_by_value(_vectors)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_CODES = 256
PAGE_ROWS = 512
PACK_ROWS = 256
FIRST_CELLS = 16
GROWTH = 4
PASSES = 8        # of the codebooks' fitting

PAGE = "cell int, rid binary, id binary, label binary, vec binary"
PACK = "cells array<int>, rid binary, label binary, vec binary, floor binary, wins binary"
FOUND = "anchor bigint, win int, score bigint, id bigint, rid bigint"


# ------------------------------------------------------------ index

def codebook(x: np.ndarray, codes: int) -> np.ndarray:
    """Centres of ``codes`` clusters of the rows of ``x``."""
    codes = min(codes, len(x))
    centres = x[np.linspace(0, len(x) - 1, codes).astype(int)].copy()
    for _ in range(PASSES):
        near = nearest(x, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=codes)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every row and the distance to it."""
    near = np.argmin((centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T), axis=1) \
        if len(x) else np.zeros(0, np.int64)
    return near, np.linalg.norm(x - centres[near], axis=1)


def _assign(books: tuple[np.ndarray, np.ndarray], dim: int):
    half = dim // 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("vec"), dim)
            (c1, d1), (c2, d2) = nearest(x[:, :half], books[0]), nearest(x[:, half:], books[1])
            for name, v in (("c1", c1.astype(np.int32)), ("c2", c2.astype(np.int32)), ("d1", d1), ("d2", d2)):
                b = b.append_column(name, pa.array(v))
            yield b
    return work


def _pack_page(dim: int):
    def work(t: pa.Table) -> pa.Table:
        return pa.table({"cell": t["cell"].slice(0, 1), "rid": [ids_of(t["rid"]).tobytes()],
                         "id": [ids_of(t["id"]).tobytes()], "label": [ids_of(t["label"]).tobytes()],
                         "vec": [matrix(t["vec"], dim).tobytes()]})
    return work


# ------------------------------------------------------------ visiting

def cells_by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Multi-sequence: (first[i] + second[j], i, j) by falling sum."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))


def _plan(dim: int, books, radii, filled: frozenset, start: int, count: int):
    """Of a pack the cells number ``start`` to ``start + count - 1`` of its order that
    one of its anchors needs; nothing once all are certified."""
    half, codes = dim // 2, len(books[1])

    def work(t: pa.Table) -> pa.Table:
        q = matrix(t["vec"], dim)
        floor = np.nan_to_num(t["floor"].to_numpy().astype(float), nan=-np.inf)
        top = np.nan_to_num(t["top"].to_numpy().astype(float), nan=np.inf)
        mids, spans = [], []
        for part, book, radius in ((q[:, :half], books[0], radii[0]), (q[:, half:], books[1], radii[1])):
            mids.append(part @ book.T)
            spans.append(np.linalg.norm(part, axis=1)[:, None] * radius[None, :])
        high = [m + s for m, s in zip(mids, spans)]
        low = [m - s for m, s in zip(mids, spans)]
        margin = 1e-9 * sum(np.abs(m).max() + s.max() for m, s in zip(mids, spans)) + 1e-6
        need = floor.min()
        chosen, place = [], 0
        for bound, i, j in cells_by_bound(high[0].max(axis=0), high[1].max(axis=0)):
            if bound + margin < need or place >= start + count:
                break
            if i * codes + j not in filled:
                continue
            place += 1
            if place > start and ((high[0][:, i] + high[1][:, j] + margin >= floor)
                                  & (low[0][:, i] + low[1][:, j] - margin <= top)).any():
                chosen.append(i * codes + j)
        names = ("cells", "rid", "label", "vec", "floor", "wins")
        if not chosen:
            return pa.table({n: pa.array([], pa.binary() if n != "cells" else pa.list_(pa.int32()))
                             for n in names})
        wins = matrix(t["wins"], len(t["wins"][0]))
        return pa.table(dict(zip(names, (
            pa.array([chosen], pa.list_(pa.int32())), [ids_of(t["rid"]).tobytes()],
            [ids_of(t["label"]).tobytes()], [q.tobytes()], [floor.tobytes()], [wins.tobytes()]))))
    return work


def inside(score: np.ndarray, positive: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * positive <= 100 * score <= high * positive, in whole numbers."""
    if max(np.abs(score).max(initial=0), np.abs(positive).max(initial=0)) * 100 < _vectors.EXACT:
        return (low * positive <= 100 * score) & (100 * score <= high * positive)
    s = np.array(score, dtype=object)
    p = np.array([int(x) for x in positive.ravel()], dtype=object).reshape(positive.shape)
    return ((low * p <= 100 * s) & (100 * s <= high * p)).astype(bool)


def _rows(r: dict, dim: int):
    return (longs(r["rid"]), longs(r["label"]), floats(r["vec"], dim), np.frombuffer(r["floor"]),
            longs(r["page_rid"]), longs(r["page_id"]), longs(r["page_label"]), floats(r["page_vec"], dim))


def _emit(anchor, win, score, ids, rid) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor), pa.array(win.astype(np.int32)), pa.array(score.astype(np.int64)),
         pa.array(ids, mask=ids == NO_ID), pa.array(rid)], ["anchor", "win", "score", "id", "rid"])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in b.schema.names}


def _same_label(dim: int, k: int):
    """First ``k`` other rows of the anchors' labels in a page."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _each(batches):
            rid, label, q, floor, prid, pid, plabel, v = _rows(r, dim)
            score = products(q, v)
            a, p = np.nonzero((label[:, None] == plabel[None, :]) & (rid[:, None] != prid[None, :])
                              & (score >= floor[:, None]))
            f = best(a, score[a, p], pid[p], prid[p], k)
            a, p = a[f], p[f]
            yield _emit(rid[a], np.zeros(len(a)), score[a, p], pid[p], prid[p])
    return work


def _other_label(dim: int, k: int, windows: int, low: int, high: int):
    """First ``k`` rows of other labels in every window of the anchors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _each(batches):
            rid, label, q, floor, prid, pid, plabel, v = _rows(r, dim)
            wins = np.frombuffer(r["wins"]).reshape(len(rid), windows)  # positives' scores, nan: none
            score = products(q, v)
            other = (label[:, None] != plabel[None, :]) & (score >= floor[:, None])
            for w in range(windows):
                has = np.flatnonzero(~np.isnan(wins[:, w]))
                a, p = np.nonzero(other[has] & inside(score[has], wins[has, w][:, None], low, high))
                a = has[a]
                f = best(a, score[a, p], pid[p], prid[p], k)
                a, p = a[f], p[f]
                yield _emit(rid[a], np.full(len(a), w + 1), score[a, p], pid[p], prid[p])
    return work


class Index:
    """Rows (rid, id, label, asks, vec) in cells of two half-space codebooks."""

    def __init__(self, rows: DataFrame, n: int, dim: int, codes: int | None = None,
                 page_rows: int = PAGE_ROWS, pack_rows: int = PACK_ROWS):
        self.dim = dim
        codes = codes or int(min(MAX_CODES, max(4, round(n ** 0.25))))
        x = sample(rows, "rid", n, dim)
        self.books = (codebook(x[:, :dim // 2], codes), codebook(x[:, dim // 2:], codes))
        schema = "rid bigint, id bigint, label bigint, asks boolean, vec array<double>, " \
                 "c1 int, c2 int, d1 double, d2 double"
        coded = stored(rows.select("rid", "id", "label", "asks", "vec")
                       .mapInArrow(_assign(self.books, dim), schema), "mine-coded")
        self.radii = tuple(self._radius(coded, f"c{h}", f"d{h}", len(self.books[h - 1])) for h in (1, 2))
        cell = (F.col("c1") * F.lit(len(self.books[1])) + F.col("c2")).alias("cell")
        cells = coded.groupBy(cell).agg(F.count(F.lit(1)).alias("n"))
        sizes = stored(cells.select("cell", F.ceil(F.col("n") / F.lit(page_rows)).alias("pages")),
                       "mine-cells")  # a row per cell: MAX_CODES squared at most
        self.filled = frozenset(r[0] for r in sizes.select("cell").collect())
        self.pages = stored(coded.select("*", cell).join(F.broadcast(sizes), "cell")
                            .withColumn("page", F.pmod(F.xxhash64("rid"), F.col("pages")))
                            .groupBy("cell", "page").applyInArrow(_pack_page(dim), PAGE), "mine-pages")
        asking = coded.where("asks")
        per = asking.groupBy("c1").agg(F.ceil(F.count(F.lit(1)) / F.lit(pack_rows)).alias("packs"))
        self.anchors = stored(asking.join(F.broadcast(per), "c1").select(
            "rid", "id", "label", "vec", "c1", F.pmod(F.xxhash64("rid"), F.col("packs")).alias("part")),
            "mine-anchors")

    @staticmethod
    def _radius(coded: DataFrame, code: str, dist: str, n: int) -> np.ndarray:
        out = np.zeros(n)
        for c, r in coded.groupBy(code).agg(F.max(dist)).collect():
            out[c] = r * (1 + 1e-9) + 1e-6
        return out

    def search(self, state: DataFrame, task, k: int, floors) -> DataFrame:
        """Visits cells until every window is certified. ``state``: (rid, wins, floor,
        top) of the asking anchors; ``floors(found)``: (rid, floor) as raised by what was
        found. Returns the first ``k`` per (anchor, win)."""
        asking = stored(self.anchors.join(state, "rid"), "mine-asking")
        found, start, count = None, 0, FIRST_CELLS
        while start < len(self.filled):
            now = asking
            if found is not None:
                now = asking.join(floors(found).withColumnRenamed("floor", "raised"), "rid", "left") \
                    .withColumn("floor", F.coalesce("raised", "floor")).drop("raised")
            plan = stored(now.groupBy("c1", "part").applyInArrow(
                _plan(self.dim, self.books, self.radii, self.filled, start, count), PACK), "mine-plan")
            if plan.isEmpty():  # may hold again later: a pack skips cells above its windows
                if not self._open(now, start + count):
                    break
            else:
                pages = self.pages.select("cell", *(F.col(c).alias(f"page_{c}") for c in
                                                    ("rid", "id", "label", "vec")))
                # a pack's row is copied to each of its cells, which file sizes don't show
                new = (plan.withColumn("cell", F.explode("cells")).drop("cells")
                       .join(pages.hint("merge"), "cell")
                       .drop("cell").mapInArrow(task, FOUND))
                if found is not None:
                    new = new.unionByName(found.drop("rank"))
                order = Window.partitionBy("anchor", "win").orderBy(
                    F.col("score").desc(), F.col("id").asc_nulls_last(), "rid")
                found = stored(new.withColumn("rank", F.row_number().over(order))
                               .where(F.col("rank") <= k), "mine-found")
            start, count = start + count, GROWTH * count
        if found is None:
            found = self.anchors.sparkSession.createDataFrame([], FOUND + ", rank int")
        return found

    def _open(self, now: DataFrame, start: int) -> bool:
        """Does any pack still need a cell from number ``start`` on?"""
        return not now.groupBy("c1", "part").applyInArrow(
            _plan(self.dim, self.books, self.radii, self.filled, start, len(self.filled)), PACK).isEmpty()


def mine(vectors: DataFrame, label: Column, anchors: Column, scale: int, id_col: str = "vec_id",
         vec_col: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, codes: int | None = None, page_rows: int = PAGE_ROWS,
         pack_rows: int = PACK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for every row with ``anchors`` and each of its first ``positives`` rows of the same
    label the first ``negatives`` rows of other labels whose score lies in ``low`` to
    ``high`` percent of the positive's."""
    spark = vectors.sparkSession
    rows = stored(vectors.select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("asks"), whole(F.col(vec_col), scale).alias("vec"))
        .where("vec is not null and label is not null")
        .withColumn("rid", F.monotonically_increasing_id()), "mine-rows")
    n, n_asks, dim = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("vec"))).first()
    if not n_asks:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, "
                                         "negative_id bigint, positive_score bigint, negative_score bigint")
    dim = max(dim, 2)
    index = Index(rows.withColumn("vec", padded(F.col("vec"), dim)), n, dim, codes, page_rows, pack_rows)
    nothing = F.array(F.lit(0.0)).alias("wins")
    first = index.search(
        index.anchors.select("rid", nothing, F.lit(None).cast("double").alias("floor"),
                             F.lit(None).cast("double").alias("top")),
        _same_label(dim, positives), positives,
        lambda found: found.where(F.col("rank") == positives).select(
            F.col("anchor").alias("rid"), F.col("score").cast("double").alias("floor")))
    first = stored(first.select("anchor", F.col("rank").alias("win"), F.col("score").alias("positive_score"),
                                F.col("id").alias("positive_id")), "mine-positives")
    # a window is open for scores of 0 and more; its least score is a lower bound to start with
    wins = first.where("positive_score >= 0").select(
        "anchor", "win", F.col("positive_score").cast("double").alias("ps"),
        F.ceil(F.col("positive_score") * F.lit(low / 100) * F.lit(1 - 1e-12)).cast("double").alias("least"))
    most = F.max(F.col("ps") * F.lit(high / 100) * F.lit(1 + 1e-12))
    empty = F.array_repeat(F.lit(float("nan")), positives)
    state = wins.groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("win", "ps"))).alias("m"),
        F.min("least").alias("floor"), most.alias("top")).select(
        F.col("anchor").alias("rid"), "floor", "top",
        F.transform(empty, lambda x, i: F.coalesce(F.try_element_at("m", i + 1), x)).alias("wins"))

    def floors(found: DataFrame) -> DataFrame:
        last = found.where(F.col("rank") == negatives).select("anchor", "win", F.col("score").alias("last"))
        return (wins.join(last, ["anchor", "win"], "left")
                .groupBy(F.col("anchor").alias("rid"))
                .agg(F.min(F.greatest("least", F.col("last").cast("double"))).alias("floor")))

    second = index.search(state, _other_label(dim, negatives, positives, low, high), negatives, floors)
    return (second.join(first, ["anchor", "win"])
            .join(index.anchors.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), noisy, F.col("vec_id") % 50 == 0, 256)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x,
    row_number() OVER () AS row_no
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row_no AS a, a.vec_id AS anchor_id, c.row_no AS c, c.vec_id, a.label = c.label AS same,
    CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.row_no <> c.row_no WHERE a.vec_id % 50 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, c) AS k
    FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.k
      ORDER BY s.score DESC, s.vec_id NULLS LAST, s.c) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""
