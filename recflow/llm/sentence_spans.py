"""Substring dedup by sliding sentence spans.

A text is cut into sentences (after ``.``, ``!``, ``?`` or a line break with all
white space behind it), so the pieces put together give the text again. A run of
sentences is a span if it has at least ``MIN_SENTENCES`` of them and
``MIN_CHARS`` characters, or, with fewer sentences, ``LONG_CHARS`` characters or
``LONG_WORDS`` words. Every sentence inside a span that is not the first of its
kind in the whole corpus is removed. First is the smallest (id, text hash,
position).

Not every span needs a row: a repeated run is the union of the shortest spans
that start at its sentences and the shortest that end at them, and where the run
is a later one these are, too. So these are hashed and joined, and every short
run that counts by its length alone beside them.

Scale: texts are cut once and the spans of a document written as one narrow row;
about one row per sentence, and one more for each that is long, is then
shuffled, (hash, id, text hash, position, length). The first occurrence comes from a
map-side reduced minimum, so a span in a third of all documents costs one row per
task; firsts are written too, and the join of the occurrences to them is an equality
join whose hot hashes AQE splits. Removed ranges are collected per document only
(bounded by its own sentences); texts are shuffled once, to their ranges.

Defined results: a null or blank text has no spans and stays as it is; rows
equal in id and text count as one occurrence and are cleaned alike; null ids
come after all others; a very long text is one row with one span list; an empty table gives no rows; extra columns are kept,
input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm.common import fresh, stored, table, words

MIN_SENTENCES = 3
MIN_CHARS = 60
LONG_CHARS = 180      # one or two sentences of so many characters ...
LONG_WORDS = 40       # ... or words are a span as well
#: A piece: up to a white-space run that follows . ! ? or holds a line break and
#: stands before a visible character, or up to the end. Every run is read once.
PIECE = r"(?s)(?!\z).*?(?:(?=\s)(?:(?<=[.!?])\s++|(?<!\s)[^\S\n]*+\n\s*+)(?=\S)|\z)"


def sentences(text: Column) -> Column:
    """Pieces of the text that concatenate to it."""
    return F.when(F.length(text) > 0, F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
                  ).otherwise(F.array(F.lit("")))


def spans(pieces: str) -> Column:
    """Array of (pos, len, hash) of the spans for an array of (chars, words, hash)."""
    def chained(first: str, n: int) -> str:
        out = "42L"
        for k in range(n):
            out = f"xxhash64({out}, {pieces}[{first} + {k}].hash)"
        return out

    def total(field: str, n: int) -> str:
        return " + ".join(f"{pieces}[i + {k}].{field}" for k in range(n))

    def span(pos: str, n: str, hashed: str) -> str:
        return f"named_struct('pos', {pos}, 'len', {n}, 'hash', {hashed})"

    def grown(part: str) -> str:
        """The shortest beginning of an array that is a span."""
        return f"""aggregate({part}, named_struct('done', false, 'n', 0, 'chars', 0),
          (a, x) -> if(a.done, a, named_struct(
            'done', a.n + 1 >= {MIN_SENTENCES} and a.chars + x.chars >= {MIN_CHARS},
            'n', a.n + 1, 'chars', a.chars + x.chars)))"""

    def run_hash(pos: str, n: str) -> str:
        return f"aggregate(slice({pieces}, {pos} + 1, {n}), 42L, (a, x) -> xxhash64(a, x.hash))"

    none = span("i", "0", "cast(null as bigint)")
    short = [f"if(i + {n} <= size({pieces}) and ({total('chars', n)} >= {LONG_CHARS} or "
             f"{total('words', n)} >= {LONG_WORDS}), {span('i', str(n), chained('i', n))}, {none})"
             for n in range(1, MIN_SENTENCES)]
    enough = f"{total('chars', MIN_SENTENCES)} >= {MIN_CHARS}"
    # no sentence is empty, so a run of MIN_CHARS sentences has MIN_CHARS characters
    most = max(MIN_SENTENCES, MIN_CHARS)
    # runs that need more sentences are looked for from i on and from i + MIN_SENTENCES - 1 back;
    # a run found backwards is another one only if it is a span without its last sentence too
    on = grown(f"slice({pieces}, i + 1, {most})")
    end = f"i + {MIN_SENTENCES}"
    back = grown(f"reverse(slice({pieces}, greatest({end} - {most}, 0) + 1, "
                 f"least({end}, {most})))")
    ends_here = f"{pieces}[{end} - 1].chars"
    longer = f"""if(i + {MIN_SENTENCES} > size({pieces}), array(), concat(
      transform(filter(array({on}), g -> g.done), g -> {span('i', 'g.n', run_hash('i', 'g.n'))}),
      transform(filter(array({back}), g -> g.done and g.chars - {ends_here} >= {MIN_CHARS}),
                g -> {span(f'{end} - g.n', 'g.n', run_hash(f'({end} - g.n)', 'g.n'))})))"""
    exact = f"array({span('i', str(MIN_SENTENCES), chained('i', MIN_SENTENCES))})"
    return F.expr(f"""
    filter(flatten(transform(sequence(0, size({pieces}) - 1), i -> concat(array({', '.join(short)}),
      if(i + {MIN_SENTENCES} <= size({pieces}) and {enough}, {exact}, {longer})))),
      s -> s.hash is not null)""")


def cut_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n, spans) per document: number of sentences and every span."""
    p = docs.select(F.col(id_col).alias("id"), _key(text_col).alias("key"),
                    F.transform(sentences(F.col(text_col)), lambda s: F.struct(
                        F.length(F.trim(s)).alias("chars"),
                        F.size(words(s)).alias("words"),
                        F.xxhash64(F.lower(F.trim(s))).alias("hash"))).alias("p"))
    return p.select("id", "key", F.size("p").cast("bigint").alias("n"), spans("p").alias("spans"))


def _key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` with the cleaned text in place, n_sentences, n_removed and
    removed (positions of the removed sentences)."""
    docs = docs.drop("n_sentences", "n_removed", "removed")
    cuts = stored(cut_texts(docs, id_col, text_col), "span-cuts")
    found = cuts.select("id", "key", F.inline("spans"))
    at = F.struct(F.col("id").isNull(), "id", "key", "pos")
    # rows equal in id and text give equal structs: min and max tell if there is another one;
    # written, so that both sides of the join are plain exchanges that AQE can split
    first = stored(found.groupBy("hash").agg(F.min(at).alias("first"), F.max(at).alias("last"))
                   .where("first != last").select("hash", "first"), "span-firsts")
    later = found.join(first, "hash").where(at != F.col("first"))
    i, key, n, ranges, pieces = fresh(docs, "i", "key", "n", "ranges", "pieces")
    ranged = later.groupBy("id", "key").agg(F.collect_set(F.struct("pos", "len")).alias(ranges))
    counted = cuts.groupBy("id", "key").agg(F.max("n").alias(n))
    per_doc = (counted.join(ranged.withColumnsRenamed({"id": "r_id", "key": "r_key"}),
                            F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left")
               .select(F.col("id").alias(i), F.col("key").alias(key), n, ranges))
    joined = docs.join(per_doc, F.col(id_col).eqNullSafe(F.col(i))
                       & (_key(text_col) == F.col(key)), "left").drop(i, key)
    # only texts that lose something are cut again
    joined = joined.withColumn(pieces, F.when(F.col(ranges).isNotNull(), sentences(F.col(text_col))))
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform(
        ranges, lambda r: F.sequence(r["pos"], r["pos"] + r["len"] - 1)))))
    joined = joined.withColumn("removed", F.coalesce(gone, F.array().cast("array<int>")))
    left = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), F.col("removed"))
    kept = F.array_join(F.transform(left, lambda j: F.get(F.col(pieces), j)), "")
    return (joined.withColumn("n_sentences", F.col(n))
            .withColumn("n_removed", F.size("removed").cast("bigint"))
            .withColumn(text_col, F.when(F.size("removed") == 0, F.col(text_col)).otherwise(kept))
            .drop(ranges, pieces, n))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_spans(docs).select(
        "doc_id", "n_sentences", "n_removed", F.array_join("removed", ",").alias("removed"),
        "text")
