"""Toxicity by a counterfactual-regularised classifier.

A logistic model over hashed word features is fitted on labelled documents.
For every labelled sentence that names a group, a counterfactual sentence names
another group of the same kind instead; the fit is penalised by the squared
change of the sentence's logit, so group names themselves cannot carry toxicity
and neutral mentions are not flagged.

The fit uses a bounded sample of labelled documents: the share of ids by hash
that gives ``MAX_SAMPLE`` of them (all if there are fewer). Its features
(bounded by the sample) are fitted on the driver. Scoring covers every whole
text: one narrow pass, Arrow batches in numpy, no shuffle; the model is a
vector of fixed size.

Defined results: a null or empty text has no words and gets the model's
constant; a document labelled more than once counts as toxic if any label says
so; null labels are ignored; without labels of both classes the constant is
the share of toxic labels (0 without labels); repeated rows get equal scores;
an empty table gives no rows; extra columns are kept, input columns named like
an output are replaced.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recflow.llm import text as _text
from recflow.llm.common import table
from recflow.llm.text import PUNCTUATION, word_hashes

cloudpickle.register_pickle_by_value(_text)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 18
MAX_SAMPLE = 20_000      # labelled documents the model is fitted on, give or take a hundredth
MAX_SENTENCES = 200_000  # counterfactual sentences of the sample at most
PENALTY = 1.0            # weight of squared logit changes under a swap
L2 = 1e-4                # ridge penalty, against the mean loss of a document
MIN_DF = 3               # features of fewer sampled documents get no weight
STEPS = 150

# --- fixed values: identity terms by kind; a term is swapped with the term at
# the same place of the next group ---
IDENTITY = {
    "religion": [["christian", "christians", "christianity"], ["muslim", "muslims", "islam"],
                 ["jewish", "jews", "judaism"], ["hindu", "hindus", "hinduism"],
                 ["buddhist", "buddhists", "buddhism"], ["atheist", "atheists", "atheism"]],
    "gender": [["woman", "women", "female", "girl", "girls"], ["man", "men", "male", "boy", "boys"]],
    "orientation": [["straight", "heterosexual"], ["gay", "homosexual"], ["lesbian", "bisexual"]],
    "ethnicity": [["black"], ["white"], ["asian"], ["latino"], ["arab"]],
    "origin": [["american", "americans"], ["mexican", "mexicans"], ["chinese", "chinese"],
               ["german", "germans"], ["french", "french"], ["spanish", "spaniards"],
               ["turkish", "turks"], ["african", "africans"]],
    "ability": [["blind"], ["deaf"], ["disabled"], ["autistic"]],
}


def _swaps() -> dict[str, str]:
    out: dict[str, str] = {}
    for groups in IDENTITY.values():
        for g, nxt in zip(groups, groups[1:] + groups[:1]):
            out.update({t: nxt[i % len(nxt)] for i, t in enumerate(g)})
    return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature indices of every text and where each text's begin."""
    h, first = word_hashes(texts, PUNCTUATION)
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))
    pairs = np.unique((doc << BITS) | (h >> np.uint64(64 - BITS)).astype(np.int64))
    return (pairs & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(
        pairs >> BITS, np.arange(len(first)))


def _index(words: list[str]) -> np.ndarray:
    h, _ = word_hashes(pa.array(words, pa.string()), PUNCTUATION)
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        idx, begin = features(texts)
        sums = np.concatenate(([0.0], np.cumsum(self.weights[idx], dtype=np.float64)))
        logit = self.bias + sums[begin[1:]] - sums[begin[:-1]]
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60)))


def fit(idx: np.ndarray, begin: np.ndarray, y: np.ndarray, swaps: list[tuple]) -> Model:
    """Ridge logistic regression with the counterfactual penalty. A feature
    is scaled by its log odds between the classes, so the ridge falls on words
    that say little. ``swaps`` holds (indices lost, indices gained, sentences)
    per kind of swap."""
    size, n = 1 << BITS, len(y)
    share = float(y.mean()) if n else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(size), np.log((share + 1e-6) / (1 - share + 1e-6)))
    used, col = np.unique(idx, return_inverse=True)
    row = np.repeat(np.arange(n), np.diff(begin))
    df = np.bincount(col, minlength=len(used))
    pos = np.bincount(col, y[row], minlength=len(used))
    scale = np.abs(np.log((pos + 1) / (y.sum() + 2)) - np.log((df - pos + 1) / (n - y.sum() + 2)))
    scale[df < MIN_DF] = 0.0
    w, b = np.zeros(len(used)), np.log(share / (1 - share))
    place = {int(u): i for i, u in enumerate(used)}
    deltas = [([place[i] for i in lost if i in place], [place[i] for i in gained if i in place], c)
              for lost, gained, c in swaps]
    total = max(1, sum(c for *_, c in deltas))
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = 1.0 / (1.0 + np.exp(-np.clip(b + np.bincount(row, (w * scale)[col], minlength=n), -60, 60)))
        err = (p - y) / n
        grad = np.bincount(col, err[row], minlength=len(used)) * scale + L2 * w
        for lost, gained, c in deltas:
            change = (w * scale)[gained].sum() - (w * scale)[lost].sum()
            pull = 2 * PENALTY * c / total * change
            np.add.at(grad, gained, pull * scale[gained])
            np.add.at(grad, lost, -pull * scale[lost])
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix1, fix2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= 0.1 * (m / fix1) / (np.sqrt(v / fix2) + 1e-7)
        b -= 0.1 * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-7)
    weights = np.zeros(size)
    weights[used] = w * scale
    return Model(weights, float(b))


def _swapped_sentences(sample: DataFrame) -> list[tuple]:
    """The swaps of the sample's sentences: (lost, gained, sentences). Equal
    swaps are counted in Spark, so only distinct ones come back."""
    swaps = _swaps()
    terms = "|".join(sorted(swaps, key=lambda t: (-len(t), t)))
    named = (sample.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[.!?\n]+")).alias("s"))
             .select(F.array_sort(F.array_distinct(F.regexp_extract_all(
                 "s", F.lit(rf"\b({terms})\b"), F.lit(1)))).alias("terms"))
             .where(F.size("terms") > 0).groupBy("terms").count()
             .orderBy(F.desc("count"), "terms").limit(MAX_SENTENCES).collect())
    return [(_index(list(r["terms"])).tolist(), _index([swaps[t] for t in r["terms"]]).tolist(),
             r["count"]) for r in named]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """Fit on the labelled documents given (filter ``labels`` to hold some out)."""
    picked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")))
    share = int(2**40 * min(1.0, MAX_SAMPLE / max(1, picked.count())))
    picked = picked.where(F.pmod(F.xxhash64("id"), F.lit(2**40)) < F.lit(share))
    # bounded by MAX_SAMPLE ids: broadcast, so no text is shuffled
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "id")

    def rows(batches):
        for b in batches:
            idx, begin = features(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("y").cast(pa.float64()),
                 pa.array([idx[x:z].tobytes() for x, z in zip(begin[:-1], begin[1:])], pa.binary())],
                ["y", "f"])
    got = sample.select("text", "y").mapInArrow(rows, "y double, f binary").toPandas()
    parts = [np.frombuffer(f, np.int32) for f in got["f"]]
    begin = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    idx = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return fit(idx, begin, got["y"].to_numpy(np.float64), _swapped_sentences(sample))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1)."""
    docs = docs.drop("score")
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # fixed size
    bias = model.bias

    def rows(batches):
        for b in batches:
            p = Model(weights.value, bias).scores(b.column(text_col))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], [*b.schema.names, "score"])
    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def remainder(id_col: str, of: int):
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(of))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
