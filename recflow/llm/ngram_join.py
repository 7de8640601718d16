"""Grouped prefix join on word-shingle Jaccard similarity.

Texts become sets of 5-word shingle hashes; equal sets form one class. Two
classes link when their Jaccard similarity is at least 0.75. With shingles in
one global order, rare ones first, linked sets share a shingle in their
prefixes (the first n - ceil(0.75 n) + 1 shingles), so only prefixes are joined.
A shingle that no other class has can never match; it only counts for the size.

1. Shared shingles. Every map task sends its shingles to hash buckets, packed
   in blobs and reduced to one entry per class; a bucket counts classes per
   shingle and answers every class with its shared shingles and their counts.
   The number of buckets follows the bytes of text, so a bucket stays small.
   Shingles seen in 1 % of a fixed-size sample are ``common`` (the list is
   bounded by the sample, not by the corpus): they rank last in the order and
   stay with their documents, so no bucket gathers a line that a third of all
   documents carry. The sample decides the order only, never the result.
2. Classes that share fewer than 75 % of their shingles link with nothing. The
   others get their ranked prefix; classes with identical prefix and size form
   one group.
3. Groups are joined on prefix shingles. Copies in large groups would make the
   join quadratic, so it runs in rounds: first every class is verified against
   one hub of its shingle lists, verified links are merged into components,
   and lists inside one component are done. The last round joins all group pairs that
   still lie in different components, expands them to members and verifies
   them, so no link is lost.

Everything runs in Spark; arrays inside tasks are numpy. Nothing but the bounded
``common`` list and iteration counters reaches the driver.

Defined results: null and blank texts have n_shingles 0 and are their own
component; null ids never name a component (a component of null ids only has
a null id); repeated rows are each reported; an empty table gives no rows; equal
sizes and counts are ordered by hash; extra columns are kept, input columns
named like an output are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm import text as _text
from recflow.llm.common import fresh, stored, table
from recflow.llm.components import components
from recflow.llm.text import mix64, shingle_sets

# task functions travel by value: workers need not have this package installed
cloudpickle.register_pickle_by_value(_text)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 5
NUM, DEN = 3, 4                  # similarity 0.75
SAMPLE_DOCS = 5_000              # documents that decide which shingles are common
COMMON_DOCS = 50                 # ... if so many of them have the shingle
BUCKET_BYTES = 6 << 20           # text bytes a bucket
MIN_BUCKETS = 128
SLICE = 128                      # rows that a task turns into numpy arrays at once
FLUSH = 1_000_000                # shingles a map task packs at once
HUB_TOKENS = 8                   # rarest prefix shingles used in the hub rounds
HUB_ROUNDS = 3
HUBS = 4                         # hubs of a shingle list from the second round on
HASH_BYTES = 5                   # of a shingle inside its bucket; the bucket number adds to them
BUCKET_BITS = 24


def _class_id(s: np.ndarray) -> int:
    """64-bit id of a set of hashes."""
    total = mix64(s).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(mix64(np.array([total], np.uint64)).view(np.int64)[0])


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, b.num_rows, SLICE):
        yield b.slice(i, SLICE)


def _sets(batches: Iterator[pa.RecordBatch], k: int):
    for b in batches:
        for part in _slices(b):
            yield part, list(shingle_sets(part.column("text"), k))


def _common(docs: DataFrame, n_docs: int, k: int) -> np.ndarray:
    """Hashes in at least ``COMMON_DOCS`` of about ``SAMPLE_DOCS`` documents."""
    step = max(1, n_docs // SAMPLE_DOCS)
    picked = docs.where(F.pmod(F.xxhash64("id", "text"), F.lit(step)) == 0).select("text")

    def hashes(batches):
        for _, sets in _sets(batches, k):
            h = np.concatenate([s.view(np.int64) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(h)], ["h"])

    rows = (picked.mapInArrow(hashes, "h long").groupBy("h").count()
            .where(F.col("count") >= COMMON_DOCS).select("h").toPandas())
    return np.sort(rows["h"].to_numpy(np.int64).view(np.uint64))


def _is_in(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return known[at] == x


def _classes(docs: DataFrame, common: np.ndarray, k: int) -> DataFrame:
    """(id, key, n, cid, hot): set size, class and the common shingles of each row."""
    def work(batches):
        for part, sets in _sets(batches, k):
            yield pa.RecordBatch.from_arrays([
                part.column("id"), part.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_class_id(s) for s in sets], pa.int64()),
                pa.array([s[_is_in(s, common)].tobytes() for s in sets], pa.binary())],
                ["id", "key", "n", "cid", "hot"])
    return docs.mapInArrow(work, "id long, key long, n long, cid long, hot binary")


def _pack(docs: DataFrame, common: np.ndarray, buckets: int, k: int) -> DataFrame:
    """(bucket, cids, counts, hashes): per bucket the classes of a map task with
    their shingles as short hashes."""
    def flush(sets: dict[int, np.ndarray]):
        cids = np.fromiter(sets, np.int64, len(sets))
        sizes = [len(s) for s in sets.values()]
        h = np.concatenate(list(sets.values()))
        bucket = ((h >> np.uint64(64 - BUCKET_BITS)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, owner = bucket[order], np.repeat(np.arange(len(cids)), sizes)[order]
        low = h[order].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
        new = np.flatnonzero(np.diff(bucket, prepend=-1) | np.diff(owner, prepend=-1))
        # runs of one class in one bucket, cut so that a length fits two bytes
        long = np.flatnonzero(np.diff(new, append=len(h)) > 65535)
        new = np.unique(np.concatenate([new, *[np.arange(new[i], new[i + 1] if i + 1 < len(new) else len(h), 65535)
                                               for i in long]]))
        count = np.diff(new, append=len(h)).astype(np.uint16)
        starts = np.flatnonzero(np.diff(bucket[new], prepend=-1))  # rows: runs of one bucket
        out = {"bucket": [], "cids": [], "counts": [], "hashes": []}
        for a, b in zip(starts, [*starts[1:], len(new)]):
            lo, hi = new[a], new[b] if b < len(new) else len(h)
            out["bucket"].append(int(bucket[lo]))
            out["cids"].append(cids[owner[new[a:b]]].tobytes())
            out["counts"].append(count[a:b].tobytes())
            out["hashes"].append(low[lo:hi].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(out["bucket"], pa.int32()), *[pa.array(out[c], pa.binary())
                                                    for c in ("cids", "counts", "hashes")]],
            ["bucket", "cids", "counts", "hashes"])

    def work(batches):
        held, total = {}, 0
        for _, sets in _sets(batches, k):
            for s in sets:
                if len(s):
                    cid = _class_id(s)
                    s = s[~_is_in(s, common)]
                    if cid not in held and len(s):
                        held[cid] = s
                        total += len(s)
            if total >= FLUSH:
                yield flush(held)
                held, total = {}, 0
        if held:
            yield flush(held)
    return docs.select("id", "text").mapInArrow(
        work, "bucket int, cids binary, counts binary, hashes binary")


def _answer(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: for every class its shingles that other classes have too."""
    cids = np.frombuffer(b"".join(pdf["cids"]), np.int64)
    counts = np.frombuffer(b"".join(pdf["counts"]), np.uint16)
    raw = np.frombuffer(b"".join(pdf["hashes"]), np.uint8).reshape(-1, HASH_BYTES)
    h = np.full(len(raw), np.uint64(key[0]) << np.uint64(8 * HASH_BYTES))
    h.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES] = raw
    del raw
    owner = np.repeat(cids, counts)
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    once = np.ones(len(h), bool)
    once[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[once], owner[once]
    begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    df = np.diff(begin, append=len(h))
    df = np.repeat(df, df)
    h, owner, df = h[df > 1], owner[df > 1], df[df > 1]
    order = np.argsort(owner, kind="stable")
    h, owner, df = h[order], owner[order], df[order].astype(np.int32)
    begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(h) else []
    end = [*begin[1:], len(h)]
    return pd.DataFrame({"cid": owner[begin] if len(h) else np.zeros(0, np.int64),
                         "hashes": [h[a:b].tobytes() for a, b in zip(begin, end)],
                         "dfs": [df[a:b].tobytes() for a, b in zip(begin, end)]})


def _ceil_share(n):
    return (n * NUM + DEN - 1) // DEN


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranked prefix and hash-sorted items of every class that can link."""
    for b in (s for whole in batches for s in _slices(whole)):
        out = {"cid": [], "n": [], "items": [], "prefix": []}
        for row in b.to_pylist():
            h = np.frombuffer(b"".join(p["hashes"] for p in row["parts"]), np.uint64)
            df = np.frombuffer(b"".join(p["dfs"] for p in row["parts"]), np.int32)
            n, need = row["n"], _ceil_share(row["n"])
            if len(h) < need:
                continue
            ranked = h[np.lexsort((h, df))]
            out["cid"].append(row["cid"])
            out["n"].append(n)
            out["items"].append(np.sort(h).tobytes())
            out["prefix"].append(ranked[:len(h) - need + 1].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["cid"], pa.int64()), pa.array(out["n"], pa.int64()),
             pa.array(out["items"], pa.binary()), pa.array(out["prefix"], pa.list_(pa.int64()))],
            ["cid", "n", "items", "prefix"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that link, by exact intersection."""
    def keep(batches):
        for b in (s for whole in batches for s in _slices(whole)):
            ok = []
            for na, nb, x, y in zip(*(b.column(c).to_pylist() for c in ("na", "nb", "ia", "ib"))):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64),
                                          assume_unique=True))
                ok.append(both * (NUM + DEN) >= NUM * (na + nb))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def side(x):
        return sets.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"),
                           F.col("items").alias(f"i{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(keep, "a long, b long")


def _similar_size(x: str, y: str) -> str:
    return f"{x} * {DEN} >= {y} * {NUM} and {y} * {DEN} >= {x} * {NUM}"


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (cid, comp) after the classes of every link are joined."""
    one = labels.toDF("a", "ca")
    two = labels.toDF("b", "cb")
    roots = components(links.join(one, "a").join(two, "b").select(
        F.col("ca").alias("a"), F.col("cb").alias("b")))
    return stored(labels.join(roots, F.col("comp") == F.col("node"), "left").select(
        "cid", F.coalesce("root", "comp").alias("comp")), "labels")


def _groups(members: DataFrame) -> DataFrame:
    """One row per group of identical prefix and size; comp is null if its
    members lie in different components. rep is the member with the least
    share of shingles that no other class has."""
    return members.groupBy("gid").agg(
        F.min(F.struct("lonely", "cid")).alias("rep"), F.first("n").alias("n"),
        F.first("prefix").alias("prefix"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).select(
        "gid", F.col("rep.cid").alias("rep"), F.col("rep.lonely").alias("lonely"), "n", "prefix",
        F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("comp"))


def _hub_pairs(members: DataFrame, turn: int) -> DataFrame:
    """(a, b): classes with hubs of their shingle lists.

    First turn: the hub is the list's most central group (the original among
    edited copies), and a class is paired with the hub it shares most of its
    rarest shingles with. Later turns: lists of other prefix shingles, drawn by
    hash, with up to HUBS random hubs each, and a class is paired with all of them
    that lie in another component."""
    groups = _groups(members)
    if turn == 0:
        drawn, first = F.slice("prefix", 1, HUB_TOKENS), F.col("lonely")
    else:
        drawn = F.slice(F.array_sort(F.transform("prefix", lambda t: F.struct(
            F.xxhash64(t, F.lit(turn)).alias("r"), t.alias("t")))), 1, HUB_TOKENS)["t"]
        first = F.lit(0.0)
    lists = groups.select("gid", "rep", "n", "comp", "lonely", F.explode(drawn).alias("t"))
    hubs = lists.groupBy("t", F.pmod(F.xxhash64(F.lit(-turn), "gid"), F.lit(HUBS if turn else 1))).agg(F.min(F.struct(
        first.alias("l"), F.xxhash64(F.lit(turn), "gid", "t").alias("r"), "gid", "rep", "n", "comp")
        ).alias("hub")).select("t", "hub")
    met = (lists.join(hubs, "t").where(_similar_size("n", "hub.n"))
           .where("comp is null or hub.comp is null or comp != hub.comp or gid = hub.gid")
           .groupBy("gid", F.col("hub.rep").alias("b")).agg(F.count(F.lit(1)).alias("c")))
    if turn == 0:
        met = met.groupBy("gid").agg(F.max_by("b", F.struct("c", "b")).alias("b"))
    hub_comp = members.select(F.col("cid").alias("b"), F.col("comp").alias("cb"))
    return (members.select("gid", F.col("cid").alias("a"), "comp").join(met, "gid")
            .join(hub_comp, "b").where("a != b and comp != cb").select("a", "b"))


def _rest_pairs(members: DataFrame) -> DataFrame:
    """(a, b): all pairs of classes that may link and lie in different
    components, through pairs of groups that share a prefix shingle."""
    groups = _groups(members)
    lists = groups.select("gid", "n", "comp", F.size("prefix").alias("p"),
                          F.posexplode("prefix").alias("pos", "t"))
    # shingles nobody shares rank before the prefix: the rank of a prefix
    # shingle from the end of the set is what matters for the bound below
    lists = lists.withColumn("after", F.expr(f"ceil(n * {NUM} / {DEN}) + p - 1 - pos - 1"))
    busy = (lists.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("lo"),
                                   F.max("comp").alias("hi"), F.count("comp").alias("pure"))
            .where("c > 1 and (pure < c or lo < hi)").select("t"))
    live = lists.join(busy, "t")
    one, two = live.alias("x"), live.alias("y")
    shared = (one.join(two, F.expr("x.t = y.t and x.gid < y.gid and "
                                   + _similar_size("x.n", "y.n")
                                   + " and (x.comp is null or y.comp is null or x.comp != y.comp)"
                                   # the first shared shingle has enough shingles behind it
                                   + f" and (1 + least(x.after, y.after)) * {NUM + DEN} >= {NUM} * (x.n + y.n)"))
              .groupBy(F.col("x.gid").alias("gx"), F.col("y.gid").alias("gy"),
                       F.col("x.n").alias("nx"), F.col("y.n").alias("ny"))
              .agg(F.count(F.lit(1)).alias("c"), F.min("x.after").alias("ax"),
                   F.min("y.after").alias("ay")))
    # beyond the last shared prefix shingle at most the shorter rest is shared
    pairs = shared.where(f"(c + least(ax, ay)) * {NUM + DEN} >= {NUM} * (nx + ny)").select("gx", "gy")
    mixed = groups.where("comp is null").select(F.col("gid").alias("gx"), F.col("gid").alias("gy"))
    m = members.select("gid", "cid", "comp")
    return (pairs.union(mixed)
            .join(m.toDF("gx", "a", "ca"), "gx").join(m.toDF("gy", "b", "cb"), "gy")
            .where("ca != cb and (gx != gy or a < b)").select("a", "b"))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(id, key, n_shingles, component_id) of every row; key hashes the text."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    common = _common(docs, size[0], k)
    buckets = min(1 << BUCKET_BITS, max(MIN_BUCKETS, -(-(size[1] or 0) // BUCKET_BYTES)))
    rows = stored(_classes(docs.withColumn("key", F.xxhash64(F.coalesce("text", F.lit("")))),
                           common, k), "join-rows")
    classes = rows.where("n > 0").groupBy("cid").agg(
        F.first("n").alias("n"), F.min("id").alias("least"), F.first("hot").alias("hot"))
    shared = (_pack(docs, common, buckets, k).groupBy("bucket")
              .applyInPandas(_answer, "cid long, hashes binary, dfs binary"))
    own = classes.where(F.length("hot") > 0).select(
        "cid", F.col("hot").alias("hashes"),
        F.expr("unhex(repeat('FFFFFF7F', cast(length(hot) / 8 as int)))").alias("dfs"))
    parts = (shared.union(own).groupBy("cid")
             .agg(F.collect_list(F.struct("hashes", "dfs")).alias("parts"),
                  F.sum(F.length("hashes") / 8).alias("m")))
    sets = stored(
        parts.join(classes.select("cid", "n"), "cid").where(f"m * {DEN} >= n * {NUM}")
        .select("cid", "n", "parts")
        .mapInArrow(_rank, "cid long, n long, items binary, prefix array<long>")
        .withColumn("gid", F.xxhash64("prefix", "n"))
        .withColumn("lonely", F.expr("(n - length(items) / 8) / n")), "join-sets")
    items = sets.select("cid", "n", "items")
    labels = sets.select("cid", F.col("cid").alias("comp"))
    for turn in range(HUB_ROUNDS + 1):
        members = sets.drop("items").join(labels, "cid")
        pairs = _hub_pairs(members, turn) if turn < HUB_ROUNDS else _rest_pairs(members)
        labels = _merge(labels, _verify(pairs, items))
    named = classes.join(labels, "cid", "left").select(
        "cid", "least", F.coalesce("comp", "cid").alias("comp"))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    final = named.join(names, "comp").select("cid", "component_id")
    return (rows.join(final, "cid", "left")
            .select("id", "key", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
                    .alias("component_id")))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               k: int = K) -> DataFrame:
    """``docs`` with n_shingles and component_id."""
    docs = docs.drop("n_shingles", "component_id")
    i, key = fresh(docs, "i", "key")
    found = link(docs, id_col, text_col, k).distinct().withColumnsRenamed({"id": i, "key": key})
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(i))
                     & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(key))).drop(i, key)


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = K) -> DataFrame:
    """Of every component the row with the smallest id (then text hash) stays;
    of rows equal in both the smallest by its other columns. Empty texts link
    with nothing and all stay."""
    i, key, rows = fresh(docs, "i", "key", "rows")
    found = link(docs, id_col, text_col, k)
    # one row of (id, text hash) per component; rows tells how many rows are equal in both
    texts = found.groupBy("id", "key").agg(
        F.first("component_id").alias("c"), F.max("n_shingles").alias("n"),
        F.count(F.lit(1)).alias("rows"))
    first = texts.where("n > 0").groupBy("c").agg(F.min(F.struct(
        F.col("id").isNull(), "id", "key", "rows")).alias("f")).select("f.id", "f.key", "f.rows")
    empty = texts.where("n = 0").select("id", "key", F.lit(1).cast("long").alias("rows"))
    stay = docs.join(first.union(empty).toDF(i, key, rows), F.col(id_col).eqNullSafe(F.col(i))
                     & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(key)))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = (stay.where(F.col(rows) > 1).select(i, key, whole.alias(rows))
             .groupBy(i, key).agg(F.min(rows).alias(rows)).select(f"{rows}.*"))
    return stay.where(F.col(rows) == 1).drop(i, key, rows).unionByName(again)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return link(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
