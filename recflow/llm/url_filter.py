"""URL allow/block rules as a sort-merge range join.

A host is turned into its reversed-label canonical key (``www.example.com``
becomes ``com.example.www.``), so a rule for a host and all its subdomains is
the key interval from ``com.example.`` up to ``com.example/`` (``/`` follows
``.`` in code order). Intervals of such prefixes nest. A sorted sweep over the
interval bounds keeps the stack of open rules; between two bounds the stack is
constant, so every key needs only the last bound at or before it.

Scale: the sweep runs over distinct hosts plus the bounds, range-partitioned
by key; a partition takes the stack it starts with from the last bound of the
partitions before it (one row per partition is all that meets in one place).
Pages then join their host's stack by an equality join, which AQE can split
for a hot host. No page url is ever compared with every rule.

Defined results: a null url or one without ``://`` has empty host and path and
gets the default verdict; repeated pages each get a row; of rules with equal
host and path the first by verdict (``allow`` before ``block``) wins; no rules
leave every url with the default verdict; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.llm.common import LOWER, UPPER, fresh, stored, table

RULE_SCHEMA = "host string, path string, verdict string"
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed-label key with a closing dot; the empty host has an empty key."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): after the bound ``key`` the rules in ``stack`` are open.

    Bounds whose rule intervals nest have the open rules of their own prefixes,
    so the stack at a bound is found through the bound's label prefixes (an
    equality join on at most as many rows as the host has labels), not by
    comparing rules with rules.
    """
    r = (rules.select(
            F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"), "verdict")
         .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
         .where("host != ''")
         .withColumn("start", host_key(F.col("host"))))
    own = r.groupBy("start").agg(F.collect_list(F.struct(
        F.length("start").alias("depth"), F.length("path").alias("path_len"),
        F.concat("host", "path").alias("rule"), "path", "verdict")).alias("rules"))
    stop = F.concat(F.expr("left(start, length(start) - 1)"), F.lit("/"))
    bounds = (own.select(F.col("start").alias("key"))
              .union(own.select(stop.alias("key"))).distinct())
    # the starts that are open at a bound: its own label prefixes; at an end
    # bound the closed rule itself does not end in a dot and drops out
    labels = F.split(F.col("key"), r"\.", -1)
    prefixes = bounds.select("key", F.explode_outer(F.expr(
        "transform(sequence(1, greatest(size(split(key, '[.]', -1)) - 1, 1)), "
        "i -> concat(array_join(slice(split(key, '[.]', -1), 1, i), '.'), '.'))")).alias("start")
    ).where(F.size(labels) > 1).join(own, "start")
    stacks = prefixes.groupBy("key").agg(F.flatten(F.collect_list("rules")).alias("stack"))
    empty = stacks.schema["stack"].dataType.simpleString()
    return bounds.join(stacks, "key", "left").select(
        "key", F.coalesce("stack", F.array().cast(empty)).alias("stack"))


def sweep(hosts: DataFrame, stacks: DataFrame) -> DataFrame:
    """The stack open at every row of ``hosts`` (host, key): range-partition
    hosts and bounds together, carry the last bound forward."""
    spark = hosts.sparkSession
    kind = stacks.schema["stack"].dataType.simpleString()
    events = (stacks.select("key", F.lit(0).alias("side"), F.lit(None).cast("string").alias("host"),
                            "stack")
              .unionByName(hosts.select("key", F.lit(1).alias("side"), "host",
                                        F.lit(None).cast(kind).alias("stack"))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = stored(events.repartitionByRange(n, "key", "side")
                    .withColumn("part", F.spark_partition_id()), "url-sweep")
    last = tagged.where("side = 0").groupBy("part").agg(
        F.max_by("stack", "key").alias("last"))
    parts = tagged.select("part").distinct().join(last, "part", "left")
    carry = parts.select("part", F.last("last", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    run = Window.partitionBy("part").orderBy("key", "side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (tagged.withColumn("open", F.last("stack", ignorenulls=True).over(run))
            .where("side = 1").join(carry, "part")
            .select("host", F.coalesce("open", "carry", F.array().cast(kind)).alias("stack")))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict columns (an equally named
    input column is replaced)."""
    stack, best = fresh(pages, "stack", "best")
    split = (pages.withColumn("host", url_host(F.col(url_col)))
             .withColumn("path", url_path(F.col(url_col))))
    hosts = split.select("host").distinct().withColumn("key", host_key(F.col("host")))
    opened = sweep(hosts, rule_stacks(rules)).where(F.size("stack") > 0).withColumnRenamed(
        "stack", stack)
    # the longest open rule whose path begins the url's; deeper host first on equal length
    fits = F.filter(F.col(stack), lambda r: F.startswith(F.col("path"), r["path"]))
    longest = F.array_max(F.transform(fits, lambda r: F.struct(
        (F.length(r["rule"])).alias("len"), r["depth"].alias("depth"),
        r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return (split.join(opened, "host", "left").withColumn(best, longest)
            .withColumn("rule", F.col(best)["rule"])
            .withColumn("verdict", F.coalesce(F.col(best)["verdict"], F.lit(default)))
            .drop(stack, best))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_HOST = ("coalesce(translate(CASE WHEN contains(url, '://') THEN "
         "regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*') ELSE '' END, "
         f"'{UPPER}', '{LOWER}'), '')")
_PATH = ("coalesce(CASE WHEN contains(url, '://') THEN "
         "regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END, '')")

ORACLE = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path, row_number() OVER () AS rid FROM pages),
m AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
             arg_max(rverdict, length(rhost || rpath)) AS verdict
      FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
                       AND starts_with(path, rpath)
      GROUP BY rid)
SELECT page_id, host, path, m.rule AS rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (rid)
"""
