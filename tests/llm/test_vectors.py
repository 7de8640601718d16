"""Exact vector operators against brute force over small tables with nulls,
non-finite and short vectors, ties, repeated rows and a large group of copies."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.llm import hard_negatives as hn
from recflow.llm import inner_products as ip

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def integers(vec, scale):
    if vec is None or any(x is None or not math.isfinite(x) for x in vec):
        return None
    return [math.floor(scale * float(np.float32(x))) for x in vec]


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def by_id(i):
    return (i is None, i or 0)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    out = []
    for i in range(500):
        v = rng.normal(size=6) * rng.choice([0.05, 0.3, 1.0])
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 4))))
    for i in range(500, 650):  # copies, more than a page
        out.append((i, out[7][1], i % 3))
    for i in range(650, 700):  # near copies
        out.append((i, [x + 0.01 * float(rng.normal()) for x in out[0][1]], 1))
    out += [(700, None, 1), (710, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (720, [float("nan")] * 6, 1),
            (730, [float("inf")] * 6, 1), (740, [0.5, 0.5], 2), (750, [], 2), (760, [0.0] * 6, 2),
            (None, [2.0] * 6, 2), (770, [1.0] * 6, None), (780, [-1.0] * 6, 3), out[0], out[0], out[100], out[50]]
    return [(i, v, la, "clash", "clash") for i, v, la in out]


def top_brute(rows, k, every, scale):
    whole = [(n, r[0], integers(r[1], scale)) for n, r in enumerate(rows)]
    whole = [(n, i, v) for n, i, v in whole if v is not None]
    out = []
    for n, i, q in whole:
        if i is not None and i % every == 0:
            scored = sorted((-product(q, v), by_id(j)) for m, j, v in whole if m != n)
            out += [(i, r + 1, None if j[0] else j[1], -s) for r, (s, j) in enumerate(scored[:k])]
    return Counter(out)


def mine_brute(rows, every, scale):
    live = []
    for n, (i, v, la, *_) in enumerate(rows):
        v = integers(v, scale)
        if v is not None and la is not None:
            live.append((n, i, v, (la + 1) % 10 if i is not None and i % 7 == 0 else la))
    out = []
    for n, i, a, la in live:
        if i is None or i % every:
            continue
        scored = sorted((-product(a, v), by_id(j), m, lb) for m, j, v, lb in live if m != n)
        for s, j, _, _ in [x for x in scored if x[3] == la][:5]:
            hits = [x for x in scored if x[3] != la and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, None if j[0] else j[1], r + 1, None if h[1][0] else h[1][1], -s, -h[0])
                    for r, h in enumerate(hits)]
    return Counter(out)


@pytest.mark.parametrize("block_rows,query_rows,scale", [(16, 8, 1024), (4096, 512, 1024), (64, 4, 2 ** 40)])
def test_topk_against_brute_force(spark, vectors, block_rows, query_rows, scale):
    df = spark.createDataFrame(vectors, SCHEMA).repartition(3)
    got = ip.top_k(df, 10, F.col("vec_id") % 50 == 0, scale, block_rows=block_rows, query_rows=query_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = Counter(tuple(r) for r in got.collect())
    want = top_brute(vectors, 10, 50, scale)
    if scale < 2 ** 30:
        assert found == want
    else:  # beyond a long the scores end at its range
        edge = 2 ** 63 - 1
        assert {(q, r): s for q, r, _, s in found} == {
            (q, r): max(-edge, min(edge, s)) for q, r, _, s in want}


def test_topk_prunes_by_length_and_residuals():
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(size=(4000, 32)) * 1024 * np.geomspace(1, 0.01, 32))
    v = v[np.argsort(-np.linalg.norm(v, axis=1), kind="stable")]
    q = v[::400].copy()
    turn = ip.rotation(v)
    assert np.allclose(turn @ turn.T, np.eye(32))
    pairs = []
    real, ip.pair_products = ip.pair_products, lambda *a: pairs.append(len(a[2])) or real(*a)
    try:
        pos = np.arange(len(v))
        qi, vi, score = ip.score_block(q, q @ turn, pos[::400], np.full(len(q), -np.inf), v, v @ turn, pos, 5)
    finally:
        ip.pair_products = real
    exact = q @ v.T
    exact[np.arange(len(q)), pos[::400]] = -np.inf
    for i in range(len(q)):
        assert sorted(score[qi == i])[-5:] == sorted(exact[i])[-5:]
    assert sum(pairs) < 0.2 * exact.size


def test_topk_few_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ip.top_k(none, 10, F.col("vec_id") % 50 == 0, 1024).count() == 0
    two = spark.createDataFrame([(0, [1.0], 1, "", ""), (1, [0.5], 1, "", ""), (50, [], 1, "", "")], SCHEMA)
    got = ip.top_k(two, 10, F.col("vec_id") % 50 == 0, 1024).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 512 * 1024), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 1, 0)]
    alone = spark.createDataFrame([(0, [1.0], 1, "", "")], SCHEMA)
    assert ip.top_k(alone, 10, F.col("vec_id") % 50 == 0, 1024).count() == 0


def noisy():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize("codes,page_rows,pack_rows", [(6, 16, 4), (None, 2048, 256), (30, 4, 1)])
def test_hard_negatives_against_brute_force(spark, vectors, codes, page_rows, pack_rows):
    df = spark.createDataFrame(vectors, SCHEMA).repartition(3)
    got = hn.mine(df, noisy(), F.col("vec_id") % 50 == 0, 256, codes=codes, page_rows=page_rows,
                  pack_rows=pack_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in got.collect()) == mine_brute(vectors, 50, 256)


def test_hard_negatives_few_rows(spark):
    def run(rows):
        return sorted(map(tuple, hn.mine(spark.createDataFrame(rows, SCHEMA), noisy(),
                                         F.col("vec_id") % 50 == 0, 256).collect()))
    assert run([]) == [] and run([(0, [1.0], 1, "", "")]) == []
    one, half = [1.0, 0.0], [0.75, 0.0]
    assert run([(50, one, 1, "", ""), (1, one, 1, "", ""), (2, half, 2, "", "")]) == [
        (50, 1, 1, 2, 65536, 49152)]
    assert run([(50, one, 1, "", ""), (1, [-1.0, 0.0], 1, "", ""), (2, half, 2, "", "")]) == []


def test_cells_come_by_falling_bound_and_all_of_them():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=9), rng.normal(size=7)
    got = list(hn.cells_by_bound(a, b))
    assert [round(x, 9) for x, *_ in got] == sorted((round(x + y, 9) for x in a for y in b), reverse=True)
    assert {(i, j) for _, i, j in got} == {(i, j) for i in range(9) for j in range(7)}


def test_windows_in_whole_numbers():
    big = 2 ** 55
    score = np.array([[50, 95, 96, 49, big // 2, 0]])
    assert hn.inside(score, np.array([[100]]), 50, 95)[0].tolist() == [True, True, False, False, False, False]
    assert hn.inside(np.array([[big // 2, big // 2 - 1]]), np.array([[float(big)]]), 50, 95)[0].tolist() == [True, False]
