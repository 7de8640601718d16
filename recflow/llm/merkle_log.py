"""Merkle manifest of a dataset, kept as a postorder append log.

Every row is a leaf: the sha256 of its fields, each written as ``-`` when null
and else as byte count, ``:``, value. The leaves of a group (a language) are
numbered by id; every two consecutive nodes of a level become their hash, a lone
last one is hashed alone, until one node, the subroot, remains. The subroots, in
the order of their groups, are the leaves of a last tree of the same kind, whose
top is the root.

The nodes of a tree form an append log in postorder: a node stands right after
its subtree, as a builder that takes leaf after leaf completes it. Positions have
a closed form. ``m = index * 2^level`` leaves lie left of a node's subtree; being
full, they have completed ``2 m - popcount(m)`` nodes, and the node is the last of
its own subtree, whose size is the sum of ceil(r / 2^l) over its levels for its
r leaves. So a sibling is addressed by arithmetic alone.

Builders are aligned: one takes ``2^SPAN`` consecutive nodes of a level and
completes the ``SPAN`` levels above them; its stretch of the log (a segment) is
one row. The tops of its segments are the nodes of the next turn, so the number of
turns is the logarithm of the largest group to the base ``2^SPAN``, and a hot
group is many builders. A proof is read from the top down: a segment adds its own
siblings, found by position, to what the segment above gives for its top; only
leaf segments are expanded to one proof per leaf.

Scale: the texts are read once and never shuffled. A leaf is a narrow row (id,
group, two digests) that is ranged by (group, id) and sent once to its builder;
segments hold at most ``2^SPAN`` leaves. The driver reads counts only.

Defined results: null ids come first, rows equal in group and id are ordered by
their digest, and repeated rows are leaves of their own; an empty table has no
tree and gives no rows; empty texts are values (``0:``), null ones are ``-``; a
long text is hashed in the row it stands in. Only the id and digests are returned;
columns of the table that are not fields neither count nor clash.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions.ordering import global_row_number
from recflow.llm.common import stored, table

# Python workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SPAN = 10

SEGMENT = ("grp string, turn int, chunk bigint, nodes_in bigint, at array<bigint>, "
           "digest array<string>, id array<bigint>, other array<string>")
UP = "grp string, turn int, chunk bigint, path string, digest string, n bigint"
PROOF = ("id bigint, leaf string, grp string, index bigint, n bigint, path string, "
         "other string, subroot string")


# ------------------------------------------------------------ log arithmetic

def subtree_size(level: int, leaves: int) -> int:
    """Nodes of a subtree over ``leaves`` leaves whose top is at ``level``."""
    return sum(-(-leaves // (1 << lv)) for lv in range(level + 1))


def position(level: int, index: int, leaves: int) -> int:
    """Place in the postorder log of node ``index`` of ``level`` in a tree of ``leaves``."""
    left = index << level
    own = min(1 << level, leaves - left)
    full = own == 1 << level
    size = (2 << level) - 1 if full else subtree_size(level, own)
    return 2 * left - left.bit_count() + size - 1


def siblings(index: int, leaves: int, height: int) -> Iterator[tuple[int, int, bool]]:
    """(level, index of the sibling, is it on the left) from a leaf up to ``height``."""
    for level in range(height):
        other = (index >> level) ^ 1
        if other << level < leaves:
            yield level, other, bool(other & 1 ^ 1)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def grow(leaves: list[str], height: int) -> list[str]:
    """The log of one builder: nodes in the order of their completion."""
    log: list[str] = []
    open_nodes: list[list[str]] = [[] for _ in range(height + 1)]

    def add(level: int, node: str, last: bool) -> None:
        log.append(node)
        if level == height:
            return
        open_nodes[level].append(node)
        if len(open_nodes[level]) == 2 or last:
            pair, open_nodes[level] = open_nodes[level], []
            add(level + 1, digest(*pair), last)

    for i, leaf in enumerate(leaves):
        add(0, leaf, i == len(leaves) - 1)
    return log


def fold(leaf: str, index: int, n: int, path: str) -> tuple[str, int]:
    """Top of a tree of ``n`` leaves from one leaf and its siblings' digests,
    which ``path`` begins with; and how many characters of it were read."""
    node, read = leaf, 0
    for level in range(max(n - 1, 0).bit_length()):
        other = (index >> level) ^ 1
        if other << level >= n:
            node = digest(node)
            continue
        side = path[read:read + 64]
        read += 64
        node = digest(side, node) if other < index >> level else digest(node, side)
    return node, read


# ------------------------------------------------------------ building

def _build(turn: int, span: int):
    """Builder of one segment: its nodes, numbered in the group, to its log."""
    def work(t: pa.Table) -> pa.Table:
        t = t.sort_by("index")
        n = t["n"][0].as_py()
        index = t["index"].to_numpy()
        chunk = int(index[0]) >> span
        here = -(-n // (1 << span * turn))  # nodes of the group in this turn
        height = span if here > 1 << span else (here - 1).bit_length()
        log = grow(t["digest"].to_pylist(), height)
        m = len(index)
        at = np.empty(len(log), np.int64)
        for level in range(height + 1):
            for i in range(-(-m // (1 << level))):
                # places in the whole tree's log, by levels counted from its leaves
                at[position(level, i, m)] = position(span * turn + level,
                                                     (chunk << span >> level) + i, n)
        if turn:  # its leaves are the tops that the turn before has logged
            at[[position(0, i, m) for i in range(m)]] = -1
        leaf = turn == 0
        return pa.table({"grp": [t["grp"][0].as_py()], "turn": pa.array([turn], pa.int32()),
                         "chunk": [chunk], "nodes_in": [m], "at": [at], "digest": [log],
                         "id": pa.array([t["id"].to_pylist() if leaf else []], pa.list_(pa.int64())),
                         "other": pa.array([t["other"].to_pylist() if leaf else []],
                                           pa.list_(pa.string()))})
    return work


@dataclass
class Log:
    """``segments`` of every turn (lists of tables) and ``groups``: one row per
    group with its number of leaves and its top."""
    segments: list[DataFrame]
    groups: DataFrame
    span: int

    def nodes(self) -> DataFrame:
        """(grp, position, digest) of every node, each once."""
        out = None
        for s in self.segments:
            rows = s.select("grp", F.inline(F.arrays_zip("at", "digest"))).where("at >= 0")
            out = rows if out is None else out.unionByName(rows)
        return out.select("grp", F.col("at").alias("position"), "digest")


def append_log(leaves: DataFrame, span: int = SPAN) -> Log:
    """Trees over (grp, index from 0, n, digest, id, other); ``n`` is the number
    of leaves of the group. Each turn is written once."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, segments, turn = leaves, [], 0
    while most:
        made = (nodes.withColumn("chunk", F.shiftright("index", span))
                .groupBy("grp", "chunk").applyInArrow(_build(turn, span), SEGMENT))
        segments.append(stored(made, f"merkle-turn{turn}"))
        if most <= 1 << span * (turn + 1):
            break
        sizes = leaves.where("index = 0").select("grp", "n")
        nodes = (segments[-1].select("grp", F.col("chunk").alias("index"),
                                     F.element_at("digest", -1).alias("digest"))
                 .join(sizes, "grp").where(F.col("n") > 1 << span * (turn + 1))
                 .select("grp", "index", "n", "digest", F.lit(None).cast("bigint").alias("id"),
                         F.lit(None).cast("string").alias("other")))
        turn += 1
    tops = None
    for turn, s in enumerate(segments):
        # the top of a group is made in the first turn that has a single segment for it
        t = (s.groupBy("grp").agg(F.count(F.lit(1)).alias("chunks"),
                                  F.max(F.element_at("digest", -1)).alias("top"))
             .where("chunks = 1").select("grp", "top", F.lit(turn).alias("turn")))
        tops = t if tops is None else tops.unionByName(t)
    if tops is None:
        tops = spark.createDataFrame([], "grp string, top string, turn int")
    groups = (tops.groupBy("grp").agg(F.min_by("top", "turn").alias("top"))
              .join(leaves.where("index = 0").select("grp", "n"), "grp"))
    return Log(segments, stored(groups, "merkle-tops"), span)


# ------------------------------------------------------------ proofs

def _paths(span: int, leaf: bool):
    """Siblings of every node of a segment, put before the path of its top."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                log, m = r["digest"], r["nodes_in"]
                height = span if r["above"] else (m - 1).bit_length()
                out = {"grp": [], "turn": [], "chunk": [], "path": [], "digest": [], "n": []} if not leaf \
                    else {k: [] for k in ("id", "leaf", "grp", "index", "n", "path", "other", "subroot")}
                for i in range(m):
                    path = "".join([log[position(level, j, m)] for level, j, _ in
                                    siblings(i, m, height)] + [r["path"] or ""])
                    node = log[position(0, i, m)]
                    index = (r["chunk"] << span) + i
                    if leaf:
                        row = (r["id"][i], node, r["grp"], index, r["n"], path, r["other"][i], r["top"])
                    else:
                        row = (r["grp"], r["turn"] - 1, index, path, node, r["n"])
                    for column, v in zip(out.values(), row):
                        column.append(v)
                yield pa.RecordBatch.from_pydict(out, schema=_arrow(PROOF if leaf else UP))
    return work


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.strip().split(" ") for x in ddl.split(","))])


def proofs(log: Log) -> DataFrame:
    """(id, leaf, grp, index, n, path, other, subroot): the siblings' digests of
    every leaf up to the top of its group, level by level."""
    above = None  # paths of the tops of this turn's segments
    groups = log.groups.select("grp", "n", F.col("top"))
    for turn in range(len(log.segments) - 1, -1, -1):
        rows = log.segments[turn].join(groups, "grp")
        if above is None:
            rows = rows.withColumns({"path": F.lit(None).cast("string"), "above": F.lit(False)})
        else:
            up = above.select("grp", "chunk", "path", F.lit(True).alias("above"))
            rows = rows.join(up, ["grp", "chunk"], "left").withColumn(
                "above", F.coalesce("above", F.lit(False)))
        leaf = turn == 0
        out = rows.mapInArrow(_paths(log.span, leaf), PROOF if leaf else UP)
        if leaf:
            return out
        above = stored(out, f"merkle-paths{turn}")
    return log.groups.sparkSession.createDataFrame([], PROOF)


# ------------------------------------------------------------ leaves

def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a row from its fields, in the order given."""
    parts = []
    for c in fields.values():
        text = c.cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame) -> DataFrame:
    """(grp, index, n, digest, id, other) from (group, id, digest, other): leaves
    numbered inside their group by (id, digest), and groups by their own order
    (``rank`` from 0, null first)."""
    ordered = global_row_number(rows, ["group", "id", "digest", "other"], "pos")
    # a group's rows stand together, so its first position orders the groups
    per = ordered.groupBy("group").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    named = per.withColumn("grp", F.concat(F.when(F.col("group").isNull(), F.lit("-")).otherwise(
        F.lit("=")), F.coalesce("group", F.lit("")))).withColumnRenamed("group", "named")
    return stored(ordered.join(named, F.col("group").eqNullSafe(F.col("named"))).select(
        "grp", (F.col("pos") - F.col("first")).alias("index"), "n", "digest", "id", "other",
        "first"), "merkle-numbered")


TOP = ("id bigint, leaf string, subroot string, root string, proof_sha256 string, "
       "folded_root string, verified boolean")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proof digest and the root folded from the leaf as it was found."""
    for b in batches:
        cols = {k: b.column(k).to_pylist() for k in (
            "id", "leaf", "index", "n", "path", "other", "subroot", "rank", "ranks", "top_path", "root")}
        sha, folded = [], []
        for leaf, i, n, path, other, rank, ranks, top_path in zip(
                *(cols[k] for k in ("leaf", "index", "n", "path", "other", "rank", "ranks", "top_path"))):
            sha.append(digest(path, top_path))
            sub, _ = fold(other or leaf, i, n, path)
            folded.append(fold(sub, rank, ranks, top_path)[0])
        yield pa.RecordBatch.from_pydict(
            {"id": cols["id"], "leaf": cols["leaf"], "subroot": cols["subroot"], "root": cols["root"],
             "proof_sha256": sha, "folded_root": folded,
             "verified": [f == r for f, r in zip(folded, cols["root"])]},
            schema=pa.schema([("id", pa.int64()), *((k, pa.string()) for k in (
                "leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())]))


def verify(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """Manifest of (group, id, digest, other): one row per leaf with its proof and
    whether the leaf found now (``other``; null: the one manifested) still folds to
    the root."""
    leaves = numbered(rows)
    log = append_log(leaves.drop("first"), span)
    # the last tree: subroots in the order of their groups
    order = leaves.where("index = 0").select(F.col("grp").alias("sub"), "first")
    subs = stored(log.groups.withColumnRenamed("grp", "sub").join(order, "sub").select(
        F.lit("").alias("group"), F.col("first").alias("id"), F.col("top").alias("digest"),
        F.lit(None).cast("string").alias("other"), "sub"), "merkle-subroots")
    top_leaves = numbered(subs.drop("sub"))
    top_log = append_log(top_leaves.drop("first"), span)
    tops = proofs(top_log).select(
        F.col("id").alias("first"), F.col("index").alias("rank"), F.col("n").alias("ranks"),
        F.col("path").alias("top_path"), F.col("subroot").alias("root"))
    tops = stored(tops.join(subs.select(F.col("id").alias("first"), F.col("sub").alias("grp")), "first")
                  .drop("first"), "merkle-top-paths")
    return proofs(log).join(tops, "grp").mapInArrow(_verified, TOP)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in FIELDS}
    more = {**fields, "n_chars": F.col("n_chars").cast("decimal(20,0)") + F.lit(1)}
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    rows = stored(docs.select(
        F.col("lang").alias("group"), F.col("doc_id").alias("id"), leaf_digest(fields).alias("digest"),
        F.when(hit & F.col("n_chars").isNotNull(), leaf_digest(more)).alias("other")), "merkle-rows")
    return verify(rows).withColumnRenamed("id", "doc_id")


ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_concat([4294967295::UBIGINT],
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::UBIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))) % 7 = 0 AS hit
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
hashed AS (
  SELECT d.doc_id, d.lang,
    sha256(f1 || f2 || f3 || CASE WHEN n_chars IS NULL THEN '-' ELSE
      strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || f5) AS leaf,
    CASE WHEN hit AND n_chars IS NOT NULL THEN sha256(f1 || f2 || f3 ||
      strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || f5) END AS other
  FROM (SELECT *,
      CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END AS f1,
      CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS f2,
      CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS f3,
      CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS f5
    FROM documents) d LEFT JOIN crc ON crc.doc_id = d.doc_id),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM hashed),
lv AS (
  SELECT lang, 0 AS level, i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2
  FROM lv WHERE n > 1 GROUP BY lang, level, i // 2),
subs AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM lv WHERE n = 1),
tv AS (
  SELECT 0 AS level, i, h, n FROM subs
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2
  FROM tv WHERE n > 1 GROUP BY level, i // 2),
steps AS (
  SELECT l.lang, l.i AS leaf_i, p.level, s.h AS sib, (p.i % 2 = 1) AS left_side
  FROM leaves l JOIN lv p ON p.lang IS NOT DISTINCT FROM l.lang AND p.i = l.i // (1 << p.level) AND p.n > 1
  LEFT JOIN lv s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = p.level AND s.i = xor(p.i, 1)),
tsteps AS (
  SELECT b.lang, p.level, s.h AS sib, (p.i % 2 = 1) AS left_side
  FROM subs b JOIN tv p ON p.i = b.i // (1 << p.level) AND p.n > 1
  LEFT JOIN tv s ON s.level = p.level AND s.i = xor(p.i, 1)),
every AS (
  SELECT lang, leaf_i, level, sib, left_side FROM steps
  UNION ALL
  SELECT l.lang, l.i, 1000 + t.level, t.sib, t.left_side
  FROM leaves l JOIN tsteps t ON t.lang IS NOT DISTINCT FROM l.lang),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang, leaf_i ORDER BY level) AS k FROM every),
folded AS (
  SELECT lang, i AS leaf_i, 0 AS k, coalesce(other, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.lang, f.leaf_i, f.k + 1, sha256(CASE WHEN s.sib IS NULL THEN f.node
    WHEN s.left_side THEN s.sib || f.node ELSE f.node || s.sib END)
  FROM folded f JOIN numbered s ON s.lang IS NOT DISTINCT FROM f.lang AND s.leaf_i = f.leaf_i AND s.k = f.k + 1),
ends AS (SELECT lang, leaf_i, arg_max(node, k) AS folded_root FROM folded GROUP BY lang, leaf_i),
proof AS (
  SELECT lang, leaf_i, sha256(coalesce(string_agg(sib, '' ORDER BY level), '')) AS proof_sha256
  FROM every GROUP BY lang, leaf_i)
SELECT l.doc_id, l.leaf, b.h AS subroot, r.h AS root,
  coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.h AS verified
FROM leaves l JOIN subs b ON b.lang IS NOT DISTINCT FROM l.lang
JOIN (SELECT h FROM tv WHERE n = 1) r ON true
JOIN ends e ON e.lang IS NOT DISTINCT FROM l.lang AND e.leaf_i = l.i
LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_i = l.i
"""
