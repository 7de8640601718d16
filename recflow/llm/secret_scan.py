"""Secret scan with corpus-wide ownership frequency.

Three base patterns give spans (assignments, access key ids, long hex). A wider
pattern gives candidates: long unbroken strings that mix letters and digits.
All values, base and wide, are hashed and counted over the corpus by distinct
repositories and distinct owners. A value that many owners have is a copied
example; a value that stays with one owner is live-looking. Wide candidates
that base spans do not cover in full are added as spans when they are
live-looking; base spans stay either way and are only labelled.

Scale: one pass finds the spans inside each row; what leaves the row is
(hash, owner, repository), reduced map-side to distinct triples before the
count, so a value copied into a third of all rows costs one row per task. The
label joins back on the hash. Main path: DataFrame functions only.

Positions come from cutting the text by the same pattern that extracts the
matches: lengths of pieces and matches add up to code point offsets.

Defined results: a null text is empty and has no spans; null owners and
repositories count as one owner or repository; an empty table gives no rows;
repeated rows are reported alike (their owner counts once); extra columns
are not returned, whatever their names; spans that start together are ordered by
kind; a very long text is one row with one span list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm.common import fresh, stored, table

# --- fixed values: base patterns, kinds in order, minimum lengths ---
ASSIGN = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
          r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"   # 16 characters and more
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "owned")
MIN_ASSIGN = 8

WIDE = r"[A-Za-z0-9+/_=-]{20,}"   # the method's wider candidates, kind "owned"
MAX_OWNERS = 1                    # live-looking: at most so many distinct owners
MAX_REPOSITORIES = 2              # ... and so many distinct repositories

SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def spans_of(text: Column, pattern: str, kind: int, group: int) -> Column:
    """Leftmost non-overlapping matches as (start, kind, stop, value of group)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    rows = F.zip_with(F.transform(F.split(text, pattern, -1), lambda p: F.length(p)),
                      F.arrays_zip(found.alias("m"), value.alias("v")),
                      lambda gap, x: F.struct(gap.alias("gap"), F.length(x["m"]).alias("n"),
                                              x["v"].alias("v")))
    empty = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("out"))
    walked = F.aggregate(
        F.filter(rows, lambda r: r["n"].isNotNull()), empty,
        lambda a, r: F.struct(
            (a["at"] + r["gap"] + r["n"]).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                (a["at"] + r["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (a["at"] + r["gap"] + r["n"]).alias("stop"), r["v"].alias("value")))).alias("out")),
        lambda a: a["out"])
    # the cut is made only for texts with a match
    return F.when(F.size(found) > 0, walked).otherwise(F.expr(f"cast(array() as {SPAN})"))


def find_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``base`` and ``wide`` span arrays."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(spans_of(text, ASSIGN, 0, 1), lambda s: F.length(s["value"]) >= MIN_ASSIGN)
    base = F.array_sort(F.concat(assign, spans_of(text, ACCESS, 1, 0), spans_of(text, HEX, 2, 0)))
    wide = F.filter(spans_of(text, WIDE, 3, 0), lambda s: s["value"].rlike("[0-9]")
                    & s["value"].rlike("[A-Za-z]"))
    # base spans in order of start cover a candidate as far as they follow on each other
    outside = F.filter(F.col("wide"), lambda s: F.aggregate(
        F.col("base"), s["start"], lambda upto, b: F.when(
            b["start"] <= upto, F.greatest(upto, b["stop"])).otherwise(upto)) < s["stop"])
    return (docs.withColumn("base", base).withColumn("wide", wide).withColumn("wide", outside))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos) from (hash, owner, repo): distinct triples
    first, then counts of distinct owners and repositories."""
    triples = candidates.select("hash", "owner", "repo").distinct()
    per_owner = triples.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"),
                                         F.sum("repos").alias("n_repos"))


def scan_secrets(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id",
                 text_col: str = "text", max_owners: int = MAX_OWNERS,
                 max_repos: int = MAX_REPOSITORIES) -> DataFrame:
    """(id, base, spans): base spans and all spans of every row, each with
    start, kind, stop, value and live (null where never counted)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = stored(find_spans(docs.select(
        F.col(id_col).alias("id"), F.struct(F.xxhash64(text), F.crc32(text.cast("binary"))).alias("key"),
        owner.cast("string").alias("owner"), repo.cast("string").alias("repo"),
        F.col(text_col).alias("body")), "body").drop("body"), "secret-spans")
    spans = found.select("id", "key", "owner", "repo", F.explode(F.concat("base", "wide")).alias("s"))
    spans = spans.withColumn("hash", F.sha2(F.col("s.value"), 256))
    counts = ownership(spans)
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    # rows equal in id and text have equal spans: one of them stands for all
    labelled = (spans.groupBy("id", "key", "s").agg(F.first("hash").alias("hash"))
                .join(counts, "hash").where(live)
                .groupBy("id", "key").agg(F.collect_list("s").alias("live"))
                .select(F.col("id").alias("i"), F.col("key").alias("k"), "live"))
    none = F.expr(f"cast(array() as {SPAN})")
    joined = (found.join(labelled, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")),
                         "left").withColumn("live", F.coalesce("live", none)))
    added = F.array_intersect(F.col("wide"), F.col("live"))
    return joined.select(
        F.col("id").alias(id_col), "base",
        F.array_sort(F.concat("base", added)).alias("spans"),
        F.array_intersect(F.col("base"), F.col("live")).alias("live_base"))


def span_text(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["stop"].cast("string"))), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner: the source; repository: the source's part in one language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    source = F.coalesce("source", F.lit(""))
    found = scan_secrets(docs, source, F.concat_ws("/", source, F.coalesce("lang", F.lit(""))))

    def n(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"),
        F.size("live_base").cast("bigint").alias("n_live"))
