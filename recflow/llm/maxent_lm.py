"""Language-model scoring with a hashed maximum-entropy model.

Vocabulary. All words of the training documents are counted (one shuffle of
map-side reduced counts). The ``MODEL_WORDS`` most frequent words form classes
of ``CLASS_WORDS`` by rank; every other word, seen or unseen, belongs to one of
``TAIL_CLASSES`` classes by its last byte, there to one of ``CLASS_WORDS``
buckets and in the bucket to one of ``LEAVES`` leaves, both by its own hash.
Buckets and leaves in use, and the rows of every hashed table, follow the
number of distinct words counted (``Weights.sized``).

Model. P(word | context) = P(class | context) P(bucket or word | class, context)
P(leaf | bucket, context) P(word | leaf). The class is a softmax over class
scores: the class's share of the corpus plus weights of the previous word, of
the word before it (a skip feature) and of the pair of both. Inside a class the
frequent word or the bucket is a softmax of corpus shares plus hashed weights of
(class, previous word); the leaf likewise with (bucket, previous word); inside a
leaf it is the smoothed corpus share. A context word outside the frequent ones
is a hashed row of its leaf. So every word carries n-gram and skip features, as
context and as target. With zero weights this is the unigram model.

Training. Documents are dealt into ``SLICES`` slices; one update per slice.
Every task sums seen and expected counts of its part in numpy, tables are
summed by a shuffle over table pieces, and the driver applies one step to the
weights (hashed tables of at most 10 MB) and broadcasts them again. Below the
classes a row serves one class or bucket and one context row, so its expected
counts follow from its seen ones; they are not shipped, and ``STEPS`` steps are
taken on them. All training documents take part.

Counts of words outside the ``DICTIONARY`` most frequent (a list of bounded
size) come from an equality join of (document, word) with the counts, so every
count is exact however large the vocabulary is. Words are 64-bit hashes.

Defined results: a null or empty text has one token, the end; a null id counts
as empty text for the split; without training documents all counts are 0 and
both scores are those of one unseen word per token; repeated rows get equal
scores; words tied in count are ranked by hash; a very long text is one row with
one array of token ids; an empty table gives no rows; extra columns are not
returned, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm import text as _text
from recflow.llm.common import stored, table
from recflow.llm.text import word_hashes
from recflow.llm.toxicity import remainder

cloudpickle.register_pickle_by_value(_text)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLASS_WORDS = 64
HEAD_CLASSES = 16
TAIL_CLASSES = 16
CLASSES = HEAD_CLASSES + TAIL_CLASSES
MODEL_WORDS = CLASS_WORDS * HEAD_CLASSES
LEAVES = 32                          # leaves of a bucket at most
NODES = TAIL_CLASSES * CLASS_WORDS   # buckets of all tail classes
HASH_BITS = 11                       # bits of a word's hash that name bucket and leaf
BOS = (1 << 16) - 1                  # context id before the first word
DICTIONARY = 1 << 17                 # words at most whose counts every task knows
SLICES = 8
RATE = 0.5
STEPS = 4                            # steps on one slice's counts below the classes
PRIOR = 8.0                          # pseudo-count that keeps rare rows near zero
SMOOTH = 0.1
FLUSH = 2_000_000                    # tokens counted at once in a task
CHUNK = 1 << 15                      # tokens scored at once
PIECE_ROWS = 1 << 10                 # weight rows summed by one task
END = np.uint64(0x454E44)            # hash of the end token


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, last bytes, first token of every text) with the end tokens."""
    last: list[np.ndarray] = []
    h, first = word_hashes(texts, last=last)
    n = len(first) - 1
    at = np.arange(len(h)) + np.repeat(np.arange(n), np.diff(first))
    begin = first + np.arange(n + 1)
    out = np.full(len(h) + n, END, np.uint64)
    tail = np.zeros(len(h) + n, np.uint8)
    out[at] = h
    tail[at] = np.concatenate(last) if last else tail[:0]
    return out, tail, begin


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def leaf_codes(h: np.ndarray, last: np.ndarray, bits: int) -> np.ndarray:
    """Class (last byte) and ``bits`` bits of the hash: bucket first, then leaf."""
    return last.astype(np.int64) % TAIL_CLASSES + TAIL_CLASSES * (
        (h >> np.uint64(17)).astype(np.int64) & ((1 << bits) - 1))


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, leaf, c) over the texts given."""
    def work(batches):
        held, n = [], 0

        def flush():
            h = np.concatenate([x for x, _ in held])
            u, at, c = np.unique(h, return_index=True, return_counts=True)
            t = np.concatenate([x for _, x in held])[at]
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(leaf_codes(u, t, HASH_BITS).astype(np.int32)),
                 pa.array(c.astype(np.int64))], ["h", "leaf", "c"])
        for b in _texts(batches):
            h, t, _ = tokens(b.column("text"))
            held.append((h, t))
            n += len(h)
            if n >= FLUSH:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()
    return (docs.select("text").mapInArrow(work, "h long, leaf int, c long")
            .groupBy("h").agg(F.min("leaf").alias("leaf"), F.sum("c").alias("c")))


@dataclass
class Vocabulary:
    """Fixed-size view of the counts."""
    n: int
    v: int
    bits: int                   # hash bits that name bucket and leaf
    words: np.ndarray           # dictionary hashes, sorted
    counts: np.ndarray          # their counts
    ids: np.ndarray             # model word id, or -1
    class_log: np.ndarray       # natural log share of every class
    word_log: np.ndarray        # natural log share of every model word in its class
    bucket_log: np.ndarray      # natural log share of every bucket in its tail class
    leaf_log: np.ndarray        # natural log share of every leaf in its bucket
    tail_norm: np.ndarray       # log10 of the leaves' denominators

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.words):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return at, self.words[at] == h


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = int(total[0] or 0), int(total[1])
    # a histogram of the counts in sixteenths of powers of two (about 1,000 rows at
    # most) tells from which count on the words fit the dictionary
    step = F.floor(F.log2("c") * 16)
    hist = sorted(counts.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("k")).collect(),
                  key=lambda r: -r["b"])
    chosen, words = F.lit(True), 0
    for r in hist:
        if words + r["k"] > DICTIONARY:  # of the cut step, as many as fit, by hash
            share = int((DICTIONARY - words) / r["k"] * (1 << 30))
            chosen = (step > F.lit(r["b"])) | ((step == F.lit(r["b"]))
                                               & (F.pmod("h", F.lit(1 << 30)) < F.lit(share)))
            break
        words += r["k"]
    top = counts.where(chosen).toPandas()
    top = top.sort_values(["c", "h"], ascending=[False, True], ignore_index=True)
    bits = int(np.clip((v >> 7).bit_length(), 0, HASH_BITS))   # 4 to 8 words a leaf
    mask = (TAIL_CLASSES << bits) - 1
    tails = counts.groupBy(F.col("leaf").bitwiseAND(mask).alias("leaf")).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    h, c = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    m = min(MODEL_WORDS, len(h))
    rank = np.arange(len(h))
    ids = np.where(rank < m, rank, -1)
    tail_n, tail_v = np.zeros(mask + 1), np.zeros(mask + 1)
    tail_n[tails["leaf"]], tail_v[tails["leaf"]] = tails["n"], tails["v"]
    mt = top["leaf"].to_numpy(np.int64)[:m] & mask
    tail_n -= np.bincount(mt, c[:m], mask + 1)
    tail_v -= np.bincount(mt, minlength=mask + 1)
    leaf_size = tail_n + SMOOTH * (tail_v + 1)
    code = np.arange(mask + 1)
    node = code % TAIL_CLASSES * CLASS_WORDS + code // TAIL_CLASSES % CLASS_WORDS
    node_size = np.bincount(node, leaf_size, NODES)
    size = np.zeros(CLASSES)
    size[:HEAD_CLASSES] = np.bincount(rank[:m] // CLASS_WORDS, c[:m] + SMOOTH, HEAD_CLASSES)
    size[HEAD_CLASSES:] = node_size.reshape(TAIL_CLASSES, CLASS_WORDS).sum(axis=1)

    def log(x):
        with np.errstate(divide="ignore"):
            return np.maximum(np.log(x), -1e9).astype(np.float32)
    word_log = np.full((HEAD_CLASSES, CLASS_WORDS), -1e9, np.float32)
    word_log.ravel()[:m] = np.log(c[:m] + SMOOTH) - np.log(size[rank[:m] // CLASS_WORDS])
    leaf_log = np.full((NODES, LEAVES), -1e9, np.float32)
    leaf_log[node, code // (TAIL_CLASSES * CLASS_WORDS)] = np.log(leaf_size / node_size[node])
    order = np.argsort(h)
    return Vocabulary(n, v, bits, h[order], c[order], ids[order], log(size / size.sum()), word_log,
                      log(node_size.reshape(TAIL_CLASSES, CLASS_WORDS) / size[HEAD_CLASSES:, None]),
                      leaf_log, np.log10(leaf_size))


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Rows with model ids and everything the dictionary knows about them."""
    sc = docs.sparkSession.sparkContext.broadcast(vars(vocab))

    def work(batches):
        voc = Vocabulary(**sc.value)
        logs = np.log10(voc.counts + SMOOTH)
        for b in _texts(batches):
            h, tail, begin = tokens(b.column("text"))
            at, known = voc.lookup(h)
            ids = np.where(known, voc.ids[at] if len(voc.ids) else -1, -1)
            ids = np.where(ids >= 0, ids, MODEL_WORDS + leaf_codes(h, tail, voc.bits)).astype(np.uint16)
            log = np.where(known, logs[at] if len(logs) else 0.0, 0.0)
            sums = np.concatenate(([0.0], np.cumsum(log)))
            tsum = np.concatenate(([0.0], np.cumsum(np.where(ids >= MODEL_WORDS, log, 0.0))))
            seen = np.concatenate(([0], np.cumsum(known)))
            spans = list(zip(begin[:-1], begin[1:]))
            lo, hi = begin[:-1], begin[1:]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("rid", "id", "held_out", "slice")],
                 pa.array(hi - lo), pa.array(seen[hi] - seen[lo]), pa.array(sums[hi] - sums[lo]),
                 pa.array(tsum[hi] - tsum[lo]),
                 pa.array([ids[x:y].tobytes() for x, y in spans], pa.binary()),
                 pa.array([h[x:y][~known[x:y]].tobytes() for x, y in spans], pa.binary())],
                ["rid", "id", "held_out", "slice", "n_tokens", "known", "log", "tail_log", "ids", "rest"])
    return docs.mapInArrow(work, "rid long, id long, held_out boolean, slice int, n_tokens long, "
                                 "known long, log double, tail_log double, ids binary, rest binary")


def _table(rows: int, width: int):
    return field(default_factory=lambda: np.zeros((rows, width), np.float32))


@dataclass
class Weights:
    prev: np.ndarray = _table(MODEL_WORDS + 1 + 64, CLASSES)   # frequent words, BOS, hashed rows
    skip: np.ndarray = _table(MODEL_WORDS + 1 + 64, CLASSES)
    pair: np.ndarray = _table(1024, CLASSES)
    word: np.ndarray = _table(CLASSES * 16, CLASS_WORDS)       # (class, hashed context)
    leaf: np.ndarray = _table(NODES, LEAVES)                   # (bucket, hashed context)

    @classmethod
    def sized(cls, v: int) -> Weights:
        """Tables whose hashed rows follow the number of distinct words, up to
        fixed sizes: what the driver holds and every task reads is bounded."""
        def rows(share, least, most):
            return int(np.clip(1 << (v // share).bit_length(), least, most))
        context = MODEL_WORDS + 1 + rows(64, 64, 4096)
        shapes = [(context, CLASSES), (context, CLASSES), (rows(32, 1024, 8192), CLASSES),
                  (CLASSES * rows(512, 16, 512), CLASS_WORDS), (NODES * rows(1 << 15, 1, 16), LEAVES)]
        return cls(*[np.zeros(x, np.float32) for x in shapes])

    def like(self) -> Weights:
        return Weights(*[np.zeros_like(x) for x in vars(self).values()])


CLASS_TABLES = ("prev", "skip", "pair")
TABLES = (*CLASS_TABLES, "word", "leaf")


@dataclass
class Tokens:
    """Features of the tokens of some documents, one array entry a token."""
    doc: np.ndarray
    prev: np.ndarray            # rows of the class tables
    skip: np.ndarray
    pair: np.ndarray
    cls: np.ndarray
    word: np.ndarray            # cells of the word table
    tail: np.ndarray            # which tokens lie in a leaf
    leaf: np.ndarray            # cells of the leaf table, of those
    code: np.ndarray            # their class, bucket and leaf

    def chunks(self) -> Iterator[slice]:
        for a in range(0, len(self.doc), CHUNK):
            yield slice(a, a + CHUNK)


def features(ids: list[bytes], w: Weights) -> Tokens:
    seqs = [np.frombuffer(x, np.uint16) for x in ids]
    flat = np.concatenate(seqs).astype(np.int64) if seqs else np.zeros(0, np.int64)
    size = np.array([len(x) for x in seqs], np.int64)
    doc = np.repeat(np.arange(len(seqs)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    prev = np.where(place > 0, np.roll(flat, 1), BOS)
    skip = np.where(place > 1, np.roll(flat, 2), BOS)
    hashed = len(w.prev) - MODEL_WORDS - 1

    def row(c):
        far = MODEL_WORDS + 1 + (c * 0x9E3779B1 >> 9) % hashed
        return np.where(c < MODEL_WORDS, c, np.where(c == BOS, MODEL_WORDS, far))
    tail = flat >= MODEL_WORDS
    code = flat - MODEL_WORDS
    cls = np.where(tail, HEAD_CLASSES + code % TAIL_CLASSES, flat // CLASS_WORDS)
    part = np.where(tail, code // TAIL_CLASSES, flat) % CLASS_WORDS
    context = prev * 0x85EBCA6B >> 11
    per_class, per_node = len(w.word) // CLASSES, len(w.leaf) // NODES
    code = code[tail]
    node = code % TAIL_CLASSES * CLASS_WORDS + part[tail]
    return Tokens(
        doc, row(prev), row(skip), ((prev << 16 | skip) * 0x9E3779B1 >> 13) % len(w.pair), cls,
        (cls * per_class + context % per_class) * CLASS_WORDS + part, tail,
        (node * per_node + (context[tail] >> 9) % per_node) * LEAVES
        + code // (TAIL_CLASSES * CLASS_WORDS), code)


def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities and log normalisers, in place."""
    top = z.max(axis=1, keepdims=True)
    z -= top
    np.exp(z, out=z)
    total = z.sum(axis=1, keepdims=True)
    z /= total
    return z, (np.log(total) + top).ravel()


def _class_scores(w: Weights, vocab: dict, t: Tokens, s: slice) -> np.ndarray:
    z = w.prev[t.prev[s]]
    z += w.skip[t.skip[s]]
    z += w.pair[t.pair[s]]
    z += vocab["class_log"]
    return z


def _shares(name: str, vocab: dict, rows: int) -> np.ndarray:
    """Log corpus shares beside the ``rows`` of the word or leaf table. Without
    buckets in the vocabulary every tail class is one leaf."""
    def single(n, width):
        x = np.full((n, width), -1e9, np.float32)
        x[:, 0] = 0
        return x
    if name == "word":
        bucket = vocab.get("bucket_log", single(TAIL_CLASSES, CLASS_WORDS))
        base = np.concatenate((vocab["word_log"], bucket))
    else:
        base = vocab.get("leaf_log", single(NODES, LEAVES))
    return np.repeat(base, rows // len(base), axis=0)


def _add_rows(out: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """out[index] += rows, equal indices summed."""
    order = np.argsort(index.astype(np.uint16), kind="stable")
    i = index[order]
    begin = np.flatnonzero(np.diff(i, prepend=-1))
    out[i[begin]] += np.add.reduceat(rows[order], begin, axis=0)


def gradient(t: Tokens, w: Weights, vocab: dict, expected: Weights) -> None:
    """Adds the model's expected counts of the class tables."""
    for s in t.chunks():
        p, _ = _softmax(_class_scores(w, vocab, t, s))
        for name in CLASS_TABLES:
            _add_rows(getattr(expected, name), getattr(t, name)[s], p)


def log_tables(w: Weights, vocab: dict) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probabilities of every cell of the word and leaf tables."""
    out = []
    for name in ("word", "leaf"):
        z = getattr(w, name) + _shares(name, vocab, len(getattr(w, name)))
        _, norm = _softmax(z.copy())
        out.append((z - norm[:, None]).ravel())
    return out[0], out[1]


def log_probability(ids: list[bytes], w: Weights, vocab: dict,
                    logs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """log10 probability of every document, tail words without their own counts."""
    word_log, leaf_log = logs or log_tables(w, vocab)
    t = features(ids, w)
    log = word_log[t.word].astype(np.float64)
    log[t.tail] += leaf_log[t.leaf]
    for s in t.chunks():
        cls = t.cls[s]
        z = _class_scores(w, vocab, t, s)
        own = z[np.arange(len(cls)), cls].copy()
        _, norm = _softmax(z)
        log[s] += own - norm
    log /= np.log(10.0)
    log[t.tail] -= vocab["tail_norm"][t.code]
    return np.bincount(t.doc, log, minlength=len(ids))


def _sum_pieces(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    sums = {c: np.sum([np.frombuffer(x, np.float32) for x in pdf[c]], axis=0, dtype=np.float64)
            for c in ("expected", "seen")}
    return pd.DataFrame({"name": [key[0]], "piece": [key[1]],
                         **{c: [s.astype(np.float32).tobytes()] for c, s in sums.items()}})


def update(rows: DataFrame, weights: Weights, vocab: dict) -> Weights:
    """One gradient step over the rows given."""
    sc = rows.sparkSession.sparkContext.broadcast((vars(weights), vocab))

    def work(batches):
        plain, voc = sc.value
        w = Weights(**plain)
        expected, seen = w.like(), w.like()
        held: list[Tokens] = []

        def count():
            for name in TABLES:
                table = getattr(seen, name)
                cells = [getattr(t, name) if name not in CLASS_TABLES
                         else getattr(t, name) * CLASSES + t.cls for t in held]
                table += np.bincount(np.concatenate(cells), minlength=table.size).reshape(table.shape)
            held.clear()
        for b in _texts(batches):
            t = features(b.column("ids").to_pylist(), w)
            gradient(t, w, voc, expected)
            held.append(t)
            if sum(len(x.doc) for x in held) >= FLUSH // 4:
                count()
        if held:
            count()
        for name in TABLES:
            e, s = getattr(expected, name), getattr(seen, name)
            for k in range(0, len(s), PIECE_ROWS):
                if s[k:k + PIECE_ROWS].any():
                    told = e[k:k + PIECE_ROWS].tobytes() if name in CLASS_TABLES else b""
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([k], pa.int32()), pa.array([told], pa.binary()),
                         pa.array([s[k:k + PIECE_ROWS].tobytes()], pa.binary())],
                        ["name", "piece", "expected", "seen"])
    kind = "name string, piece int, expected binary, seen binary"
    summed = (rows.select("ids").mapInArrow(work, kind).groupBy("name", "piece")
              .applyInPandas(_sum_pieces, kind).collect())  # bounded size: the weight tables
    out = Weights(**{k: v.copy() for k, v in vars(weights).items()})
    shares = {name: _shares(name, vocab, len(getattr(out, name))) for name in ("word", "leaf")}
    for r in summed:
        at = slice(r["piece"], r["piece"] + PIECE_ROWS)
        t = getattr(out, r["name"])[at]
        s = np.frombuffer(r["seen"], np.float32).reshape(t.shape)
        if r["name"] in CLASS_TABLES:
            e = np.frombuffer(r["expected"], np.float32).reshape(t.shape)
            t += RATE * (s - e) / (np.maximum(s, e) + PRIOR)
            continue
        for _ in range(STEPS):
            e = _softmax(t + shares[r["name"]][at])[0] * s.sum(axis=1, keepdims=True)
            t += RATE * (s - e) / (np.maximum(s, e) + PRIOR)
    sc.unpersist()
    return out


def _rest_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(rid, rest_log, rest_known): the tokens outside the dictionary."""
    def work(batches):
        for b in batches:
            rid, h, m = [], [], []
            for r, x in zip(b.column("rid").to_pylist(), b.column("rest").to_pylist()):
                u, c = np.unique(np.frombuffer(x, np.int64), return_counts=True)
                rid.append(np.full(len(u), r))
                h.append(u)
                m.append(c)
            if rid:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (rid, h, m)],
                    ["rid", "h", "m"])
    words = rows.where(F.length("rest") > 0).select("rid", "rest").mapInArrow(
        work, "rid long, h long, m long")
    c = F.coalesce("c", F.lit(0))
    return (words.join(counts.select("h", "c"), "h", "left").groupBy("rid").agg(
        F.sum(F.col("m") * F.log10(c + F.lit(SMOOTH))).alias("rest_log"),
        F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("rest_known")))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    fold: int = 10) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row; rows whose crc32(id) mod ``fold`` is 0 are not learned from."""
    held = remainder(id_col, fold) == 0
    docs = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        held.alias("held_out"), F.monotonically_increasing_id().alias("rid"),
        F.when(held, F.lit(-1)).otherwise(F.pmod(F.xxhash64(id_col, text_col), F.lit(SLICES)))
        .cast("int").alias("slice"))
    counts = stored(word_counts(docs.where("not held_out")), "lm-counts")
    vocab = build_vocabulary(counts)
    rows = stored(encode(docs, vocab), "lm-rows", partition_by="slice")
    small = {k: getattr(vocab, k)
             for k in ("class_log", "word_log", "bucket_log", "leaf_log", "tail_norm")}
    weights = Weights.sized(vocab.v)
    for s in range(SLICES):
        weights = update(rows.where(F.col("slice") == s), weights, small)
    final = docs.sparkSession.sparkContext.broadcast((vars(weights), small))

    def work(batches):
        plain, voc = final.value
        w = Weights(**plain)
        logs = log_tables(w, voc)
        for b in _texts(batches):
            log = log_probability(b.column("ids").to_pylist(), w, voc, logs)
            keep = [b.column(c) for c in b.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(log)],
                                             [*[c for c in b.schema.names if c != "ids"], "model"])
    names = "rid long, id long, held_out boolean, n_tokens long, known long, log double, tail_log double"
    scored = rows.select("rid", "id", "held_out", "n_tokens", "known", "log", "tail_log", "ids"
                         ).mapInArrow(work, f"{names}, model double")
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    norm = float(np.log10(vocab.n + SMOOTH * (vocab.v + 1)))
    return scored.join(_rest_counts(rows, counts), "rid", "left").select(
        "id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("log") + rest_log - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("model") + F.col("tail_log") + rest_log).alias("score"))


def op8_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs).withColumnRenamed("id", "doc_id")
