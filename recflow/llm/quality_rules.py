"""Quality rules with adaptive thresholds per language and source.

Two fixed base rules (too short; too repetitive) reject as before. Every other
rule compares a ratio of the document with a limit learned from the corpus. The
distinct texts of a (language, source) give a mergeable KLL quantile sketch per
ratio. A group's limit is the median and a slack, plus ``SPREAD`` times the distance
of two inner quantiles, or the ratio's floor if that is higher. The quantiles lie
below the two-thirds point, so up to a third of junk (``TOLERATED``) with high ratios
leaves them among the clean documents. A language's limit is the median of its
groups' limits, weighted by their texts, the corpus's that of all groups. A group's
limit is drawn towards its language's by a weight that falls with its number of texts
(``SHRINK``), and never exceeds ``MULTIPLE`` times it; languages relate to the corpus in
the same way, so a group with more junk, or of junk alone, is held by the others as
long as these have most of the texts.

Sketches are built map-side and merged, so a hot source costs one sketch per task.
Copies are counted once: texts meet by hash on narrow rows, reduced map-side.

Main path: DataFrame functions only. Repeated 3-word windows are found inside
a document's own arrays: window hashes with the position in the low bits are
sorted as longs, equal neighbours are compared word by word.

Defined results: a null text has no words (all counts 0, base_failed, not
kept); null languages and sources are groups of their own; an empty table
gives no rows; repeated rows are judged alike; a ratio equal to its limit passes;
a very long text is arrays in one row, so it must fit a task. ``filter_quality``
keeps extra columns, whatever their names; ``judge_quality`` returns the id, the
language, the source and the columns of ``OUTPUTS`` only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm.common import SPACES, fresh, stored, table, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TOLERATED = 1 / 3    # share of junk in a group that the quantiles below stand
CENTRE = 0.5         # a limit is this quantile, SLACK of it more, ...
SLACK = 0.1
INNER = (0.2, 0.65)  # ... and SPREAD times the distance between these, all under 1 - TOLERATED
SPREAD = 6.0
SHRINK = 20          # so many texts weigh as much as the limit of the level above
MULTIPLE = 3.0       # of the limit of the level above, which no limit exceeds
SKETCH_K = 2048      # a sketch is exact up to about so many documents, rank error 0.1 % beyond
GRID = 0.05          # limits are rounded up to this grid, so sketch noise does not show
RATIOS = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length")
#: A ratio never fails below this, whatever the group looks like.
FLOORS = {"symbol_ratio": 0.2, "dup_line_ratio": 0.5, "repeat_ratio": 0.3, "word_length": 12.0}
OUTPUTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept", *RATIOS)


def _with_repeats(df: DataFrame, w: str, out: str) -> DataFrame:
    """Adds the count of words in repeated 3-word windows."""
    s, k, again = fresh(df, "sorted", "bits", "again")
    df = df.withColumn(k, F.greatest(F.ceil(F.log2(F.size(w) + 1)), F.lit(1)).cast("int"))
    df = df.withColumn(s, F.when(F.size(w) >= 4, F.sort_array(F.expr(
        f"transform(sequence(0, size({w}) - 3), i -> (shiftleft(xxhash64({w}[i], {w}[i + 1], {w}[i + 2]), {k})"
        f" | cast(i as bigint)))"))))
    pos = f"cast({s}[%s] & (shiftleft(1L, {k}) - 1) as int)"
    equal = (f"(shiftright({s}[%(a)s], {k}) = shiftright({s}[%(b)s], {k})"
             f" and slice({w}, {pos % '%(a)s'} + 1, 3) = slice({w}, {pos % '%(b)s'} + 1, 3))")
    # ranks in sorted order whose window equals its neighbour's, as positions
    df = df.withColumn(again, F.expr(
        f"transform(filter(sequence(0, size({s}) - 1), j -> "
        f"(j > 0 and {equal % {'a': 'j', 'b': 'j - 1'}}) or "
        f"(j < size({s}) - 1 and {equal % {'a': 'j', 'b': 'j + 1'}})), j -> {pos % 'j'})"))
    covered = F.size(F.array_union(F.array_union(
        F.col(again), F.transform(again, lambda p: p + 1)), F.transform(again, lambda p: p + 2)))
    return df.withColumn(out, F.when(F.size(again) > 0, covered).otherwise(0).cast("bigint")
                         ).drop(s, k, again)


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts and ratios of every document."""
    docs = docs.drop(*OUTPUTS)
    w, t, lines = fresh(docs, "words", "body", "lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_word = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    df = docs.withColumn(w, words(F.col(text_col)))
    df = (df.withColumn("n_words", F.size(w).cast("bigint"))
          .withColumn("word_chars", F.length(F.array_join(w, "")).cast("bigint"))
          .withColumn("n_symbols", (F.length(text) - F.length(
              F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("bigint"))
          .withColumn(lines, has_word)
          .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"))
          .withColumn(t, F.size(lines)))
    df = _with_repeats(df, w, "n_repeat_words")
    some = F.greatest(F.col("n_words"), F.lit(1))
    return (df.withColumn("symbol_ratio", F.col("n_symbols") / some)
            .withColumn("dup_line_ratio", F.col("n_dup_lines") / F.greatest(F.col(t), F.lit(1)))
            .withColumn("repeat_ratio", F.col("n_repeat_words") / some)
            .withColumn("word_length", F.col("word_chars") / some)
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
            .drop(w, t, lines))


def learned_limits(measured: DataFrame, lang_col: str, source_col: str, key_col: str) -> DataFrame:
    """(g_lang, g_source, limit_<ratio>) from the distinct texts (``key_col``: their
    hash). Documents that the base rules reject do not shape the limits."""
    texts = measured.where("not base_failed").select(
        F.col(lang_col).alias("g_lang"), F.col(source_col).alias("g_source"),
        F.col(key_col).alias("text_key"), *RATIOS).distinct()
    base = stored(texts.groupBy("g_lang", "g_source").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(F.col(r).cast("double"), F.lit(SKETCH_K)).alias(r) for r in RATIOS]),
        "quality-sketches")

    def limit(r):
        at = [F.kll_sketch_get_quantile_double(F.col(r), F.lit(p)) for p in (CENTRE, *INNER)]
        return F.greatest(at[0] * F.lit(1 + SLACK) + F.lit(SPREAD) * (at[2] - at[1]), F.lit(FLOORS[r]))

    def middle(mark: str) -> list:
        return [F.sum("n").alias(f"{mark}_n"), *[F.percentile(f"own_{r}", F.lit(0.5), F.col("n")).alias(f"{mark}_{r}")
                                                 for r in RATIOS]]

    def drawn(n: str, limit: str, above):
        weight = F.col(n) / (F.col(n) + F.lit(SHRINK))
        return F.least(weight * F.col(limit) + (1 - weight) * above, F.lit(MULTIPLE) * above)

    own = base.select("g_lang", "g_source", "n", *[limit(r).alias(f"own_{r}") for r in RATIOS])
    lang = own.groupBy("g_lang").agg(*middle("lang")).withColumnRenamed("g_lang", "l")
    joined = (own.join(lang, F.col("g_lang").eqNullSafe(F.col("l")))
              .crossJoin(F.broadcast(own.agg(*middle("all")))))  # one row
    return joined.select("g_lang", "g_source", *[
        (F.lit(GRID) * F.ceil(drawn("n", f"own_{r}", drawn("lang_n", f"lang_{r}", F.col(f"all_{r}")))
                              / F.lit(GRID))).alias(f"limit_{r}") for r in RATIOS])


def _judged(measured: DataFrame, lang_col: str, source_col: str, key_col: str) -> DataFrame:
    """``measured`` with kept, without its key."""
    lang, source = fresh(measured, "g_lang", "g_source")
    limits = learned_limits(measured, lang_col, source_col, key_col).withColumnsRenamed(
        {"g_lang": lang, "g_source": source})
    within = F.lit(True)
    for r in RATIOS:
        within = within & (F.col(r) <= F.coalesce(F.col(f"limit_{r}"), F.lit(float("inf"))))
    return (measured.join(limits, F.col(lang_col).eqNullSafe(F.col(lang))
                          & F.col(source_col).eqNullSafe(F.col(source)), "left")
            .withColumn("kept", ~F.col("base_failed") & within)
            .drop(lang, source, key_col, *[f"limit_{r}" for r in RATIOS]))


def judge_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """Counts, base_failed and kept of every document, without its text."""
    kept = [id_col, lang_col, source_col]
    docs = docs.select(*kept, text_col)
    key, = fresh(docs, "text_key")
    measured = stored(measures(docs.withColumn(key, F.xxhash64(text_col)), text_col).select(
        *kept, key, *[c for c in OUTPUTS if c != "kept"]), "quality-measures")
    return _judged(measured, lang_col, source_col, key)


def filter_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """The documents that are kept, columns as given."""
    clash = [c for c in docs.columns if c in OUTPUTS]
    renamed = dict(zip(clash, fresh(docs, *[f"in_{c}" for c in clash])))
    key, = fresh(docs, "text_key")
    keyed = docs.withColumnsRenamed(renamed).withColumn(key, F.xxhash64(text_col))
    measured = stored(measures(keyed, text_col), "quality-documents")
    kept = _judged(measured, lang_col, source_col, key).where("kept")
    return kept.select(*[F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")
