"""Benchmark decontamination: a hash set of normalised test n-grams probed by
the windows of every document, hits verified word by word.

Test side: every window of ``n`` consecutive words of an item (an item of fewer
words is one window) with the items that hold it; the distinct windows form the
hash set. It is broadcast while the test set has at most ``BROADCAST_WINDOWS``
windows (counted first); a larger one goes through a shuffled join on the same
columns. Document side: one pass hashes all windows of a text inside its own
array, only (row key, position, hash) is exploded, and only hits go on. The
row key is (id, two hashes of the text): rows equal in it have equal results.
Hits are verified against the words of the text before they count.

Scale: per document word there is one long in one hash probe, no shuffle unless
the test set is too large to broadcast. Hits are grouped per document (bounded
by the document's own length); a passage that many documents share gives
linearly many hits. Main path: DataFrame functions only.

Defined results: a null text or one without words has n_words 0 and no hit; a
benchmark without words (or an empty one) hits nothing; equal items are each
reported; null item ids are left out of the item list; repeated rows are each
reported; extra columns are kept, input columns named like an output are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm.common import ascii_lower, fresh, stored, table

# --- fixed value: ASCII characters that separate words once A-Z is folded ---
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 10
BROADCAST_WINDOWS = 1_000_000  # about 24 MB as (hash, id); beyond it the join is shuffled


def item_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS),
                    lambda w: w != "")


def bench_windows(bench: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(gram, len, hash, items): the distinct windows and the items with them."""
    w = bench.select(F.col(id_col).cast("string").alias("item"),
                     item_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    grams = w.select("item", F.explode(F.expr(
        f"transform(sequence(0, greatest(size(w) - {n}, 0)), i -> slice(w, i + 1, {n}))")).alias("gram"))
    return (grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
            .withColumn("len", F.size("gram")).withColumn("hash", gram_hash("gram")))


def gram_hash(gram: str) -> Column:
    """Hash of an array of words through the hashes of the words."""
    return F.expr(f"aggregate({gram}, 42L, (a, x) -> xxhash64(a, xxhash64(x)))")


def _window_hashes(h: str, length: int) -> str:
    """SQL for the hashes of all windows of ``length`` over word hashes ``h``."""
    fold = "42L"
    for j in range(length):
        fold = f"xxhash64({fold}, {h}[i + {j}])"
    return (f"if(size({h}) >= {length}, transform(sequence(0, size({h}) - {length}), i -> {fold}), "
            f"cast(array() as array<bigint>))")


def find_hits(docs: DataFrame, windows: DataFrame, lengths: list[int], id_col: str,
              text_col: str) -> DataFrame:
    """(k_id, k_a, k_b, pos, len, hash): window hash matches, not yet verified.
    The windows of all lengths share one array; the length of a hit tells where
    its part of the array begins."""
    base = docs.select(F.col(id_col).alias("k_id"), *_text_key(text_col),
                       F.transform(item_words(F.col(text_col)), lambda x: F.xxhash64(x)).alias("h"))
    parts = [_window_hashes("h", n) for n in lengths]
    probe = base.select("k_id", "k_a", "k_b", F.size("h").alias("n"),
                        F.posexplode(F.expr(f"concat({', '.join(parts)})")).alias("at", "hash"))
    keys = windows.select("hash", "len").distinct()
    if windows.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    found = probe.join(keys, "hash")
    skip = F.lit(0)
    for k, n in enumerate(lengths):  # at most n values
        ahead = sum((F.greatest(F.col("n") - F.lit(m - 1), F.lit(0)) for m in lengths[:k]), F.lit(0))
        skip = F.when(F.col("len") == n, ahead).otherwise(skip)
    pos = F.col("at") - skip
    return (found.withColumn("pos", pos).where((pos >= 0) & (pos + F.col("len") <= F.col("n")))
            .select("k_id", "k_a", "k_b", "pos", "len", "hash"))


def _text_key(text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias("k_a"), F.crc32(text.cast("binary")).alias("k_b")]


def scan(docs: DataFrame, bench: DataFrame, n: int = N, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, hit_ranges (start and length in words of
    every verified window), items and contaminated."""
    docs = docs.drop("n_words", "n_hit", "hit_ranges", "items", "contaminated")
    windows = stored(bench_windows(bench, n, item_col, item_text_col), "bench-windows")
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # at most n rows
    k_id, k_a, k_b, w, cand = fresh(docs, "k_id", "k_a", "k_b", "w", "cand")
    if not lengths:
        return (docs.withColumn("n_words", F.size(item_words(F.col(text_col))).cast("bigint"))
                .withColumn("n_hit", F.lit(0).cast("bigint"))
                .withColumn("hit_ranges", F.expr("cast(array() as array<struct<pos:int,len:int>>)"))
                .withColumn("items", F.expr("cast(array() as array<string>)"))
                .withColumn("contaminated", F.lit(False)))
    found = find_hits(docs, windows, lengths, id_col, text_col).distinct()
    grouped = (found.join(windows.drop("len"), "hash")
               .groupBy("k_id", "k_a", "k_b")
               .agg(F.collect_list(F.struct("pos", "len", "gram", "items")).alias(cand))
               .select(F.col("k_id").alias(k_id), F.col("k_a").alias(k_a), F.col("k_b").alias(k_b),
                       cand))
    text_a, text_b = _text_key(text_col)
    joined = docs.join(grouped, F.col(id_col).eqNullSafe(F.col(k_id)) & (text_a == F.col(k_a))
                       & (text_b == F.col(k_b)), "left").drop(k_id, k_a, k_b)
    # words are needed for the count of every row, and to verify the rows with hits
    joined = joined.withColumn(w, item_words(F.col(text_col)))
    real = F.filter(F.col(cand), lambda c: F.slice(F.col(w), c["pos"] + 1, c["len"]) == c["gram"])
    joined = joined.withColumn(cand, F.when(F.col(cand).isNotNull(), real))
    ranges = F.coalesce(F.transform(cand, lambda c: F.struct(
        c["pos"].alias("pos"), c["len"].alias("len"))),
        F.expr("cast(array() as array<struct<pos:int,len:int>>)"))
    return (joined.withColumn("n_words", F.size(w).cast("bigint"))
            .withColumn("hit_ranges", F.array_sort(ranges))
            .withColumn("n_hit", covered(F.col("hit_ranges")))
            .withColumn("items", F.array_sort(F.coalesce(
                F.array_distinct(F.flatten(F.transform(cand, lambda c: c["items"]))),
                F.expr("cast(array() as array<string>)"))))
            .withColumn("contaminated", F.col("n_hit") > 0)
            .drop(w, cand))


def covered(ranges: Column) -> Column:
    """Positions inside at least one of the sorted (pos, len) ranges."""
    return F.aggregate(
        ranges, F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda a, r: F.struct(
            F.greatest(a["end"], r["pos"] + r["len"]).alias("end"),
            (a["n"] + F.greatest(r["pos"] + r["len"] - F.greatest(a["end"], r["pos"]), F.lit(0))
             ).cast("bigint").alias("n")),
        lambda a: a["n"])


def remove_contaminated(docs: DataFrame, bench: DataFrame, n: int = N, **cols) -> DataFrame:
    """The documents without any hit, columns as given."""
    return scan(docs, bench, n, **cols).where("not contaminated").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         [x for x in regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w
  FROM documents),
b AS (
  SELECT item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w
  FROM benchmark),
bw AS (
  SELECT item_id, least(len(w), 10) AS n,
         unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
                 for i in generate_series(1, greatest(len(w) - 9, 1))]) AS gram
  FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, n, unnest(generate_series(1, len(w) - n + 1)) AS p,
         unnest([array_to_string(w[i:i + n - 1], ' ') for i in generate_series(1, len(w) - n + 1)]) AS gram
  FROM d, lens WHERE len(w) >= n),
hits AS (SELECT rid, p, dw.n AS n, item_id FROM dw JOIN bw USING (gram, n)),
words AS (SELECT rid, count(DISTINCT q) AS n_hit
          FROM (SELECT rid, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
