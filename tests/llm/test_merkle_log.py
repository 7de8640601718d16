"""The postorder log, its proofs and the query against a plain recursive tree."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recflow.llm import merkle_log as ml


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(leaves):
    out = [list(leaves)]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def postorder(leaves):
    """Nodes in the order in which one builder completes them."""
    lv, out = levels(leaves), []

    def walk(level, i):
        if level:
            for j in (2 * i, 2 * i + 1):
                if j < len(lv[level - 1]):
                    walk(level - 1, j)
        out.append((level, i, lv[level][i]))
    walk(len(lv) - 1, 0)
    return out


def path(lv, i):
    out = []
    for level in lv[:-1]:
        j = i ^ 1
        out.append((level[j] if j < len(level) else None, i & 1))
        i >>= 1
    return out


@pytest.mark.parametrize("n", [*range(1, 40), 64, 100, 129])
def test_positions_are_the_postorder(n):
    order = postorder([h(str(i)) for i in range(n)])
    assert [ml.position(level, i, n) for level, i, _ in order] == list(range(len(order)))
    assert ml.grow([h(str(i)) for i in range(n)], (n - 1).bit_length()) == [d for *_, d in order]
    assert ml.subtree_size((n - 1).bit_length(), n) == len(order)


def test_segments_form_the_log_of_every_group(spark):
    sizes = {"a": 1, "b": 3, "c": 4, "d": 17, "e": 70, "f": 64}
    rows = [(g, i, n, h(g, str(i)), i, None) for g, n in sizes.items() for i in range(n)]
    log = ml.append_log(spark.createDataFrame(
        rows, "grp string, index long, n long, digest string, id long, other string"), span=2)
    assert len(log.segments) == 4  # 70 leaves, 18, 5 and 2 nodes
    got = {(r.grp, r.position): r.digest for r in log.nodes().collect()}
    want = {(g, k): d for g, n in sizes.items()
            for k, (*_, d) in enumerate(postorder([h(g, str(i)) for i in range(n)]))}
    assert got == want
    assert {r.grp: r.top for r in log.groups.collect()} == {
        g: levels([h(g, str(i)) for i in range(n)])[-1][0] for g, n in sizes.items()}
    for r in ml.proofs(log).collect():
        p = path(levels([h(r.grp, str(i)) for i in range(sizes[r.grp])]), r.id)
        assert r.path == "".join(s for s, _ in p if s)
        assert ml.fold(r.leaf, r["index"], r.n, r.path) == (r.subroot, len(r.path))


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, more=0):
        i, text, lang, source, n = r
        return h(part(i), part(source), part(lang), part(None if n is None else n + more), part(text))

    by = {}
    for r in rows:
        other = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0], leaf(r, 1) if other else None))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        by[g].sort(key=lambda x: x[:3])
        trees[g] = levels([x[2] for x in by[g]])
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, (_, _, lf, doc, other) in enumerate(by[g]):
            p, node = path(trees[g], i) + path(top, k), other or lf
            for s, left in p:
                node = h(node) if s is None else h(s, node) if left else h(node, s)
            out.append((doc, lf, trees[g][-1][0], top[-1][0], h(*(s for s, _ in p if s)), node,
                        node == top[-1][0]))
    return out


def test_manifest_against_brute_force(spark, rows, tmp_path):
    src = [r[:5] for r in rows] + [(300, "no count", "en", "s1", None), (301, "", None, None, None),
                                   (302, None, "é", "s", 0), (302, None, "é", "s", 0)]
    df = spark.createDataFrame(src, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumns({"leaf": F.lit("clash"), "index": F.lit(5), "grp": F.lit("x")})
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in ml.op11_merkle_manifest(spark, str(tmp_path)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert Counter(got) == Counter(brute(src))
    assert {v for *_, v in got} == {True, False}


def test_small_spans_give_the_same_manifest(spark):
    rows = [(f"g{i % 3}" if i % 5 else None, i // 2, h(str(i)), h("x") if i % 4 == 0 else None)
            for i in range(90)]
    df = spark.createDataFrame(rows, "group string, id long, digest string, other string")
    one = Counter(tuple(r) for r in ml.verify(df).collect())
    assert one == Counter(tuple(r) for r in ml.verify(df, span=1).collect())
    assert sum(not r[6] for r in one.elements()) == sum(i % 4 == 0 for i in range(90))


def test_empty_table(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert ml.op11_merkle_manifest(spark, str(tmp_path)).count() == 0
