"""URL filtering by nested host and path rules, as a sort-merge range join.

A host becomes a canonical key: its labels reversed, each closed by a dot
(``www.example.com`` -> ``com.example.www.``). A rule's host and all its
subdomains are then one interval of keys, ``[key, key with '/' for the last dot)``,
and intervals of different rules are nested or disjoint. The rule side is turned
once into its sorted boundaries, each with the stack of rules that are active
from there on. Urls and boundaries are range-partitioned together by key, and a
sorted sweep over each range carries the current stack to every url; the stack a
range starts with is the last one of the ranges before it. Ranges are cut by
(host, path, page), so a host with a third of all pages spreads over many.
Of the active rules whose path begins the url's path, the longest wins.

Defined cases: host = after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; path = from there up to ``?``, ``#`` or the end; a null url or one
without ``://`` has an empty host and path and fits no rule. Longest = most
characters of host and path together, then the longer host, then ``block`` before
``allow``. Repeated rules and rows are harmless; with no rules or no fit the verdict
is ``default``. Columns other than ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read, staged

#: The rules of the registered query (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STACK = "array<struct<host:string,path:string,verdict:string>>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): from ``key`` on, up to the next one, the rules of ``stack`` are active."""
    rules = rules.select("host", "path", "verdict").distinct().withColumn("key", host_key(F.col("host")))
    own = rules.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("host", "path", "verdict"))).alias("own"))
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.", -1)
    depth = own.select("key", F.posexplode(labels).alias("n", "label"), labels.alias("labels"))
    above = depth.select("key", F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("n") + 1), "."), F.lit("."))
                         .alias("outer"))
    active = (above.join(own.select(F.col("key").alias("outer"), "own"), "outer")
              .groupBy("key")
              .agg(F.flatten(F.collect_list("own")).alias("stack"),
                   F.flatten(F.collect_list(F.when(F.col("outer") != F.col("key"), F.col("own")))).alias("rest")))
    end = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    return active.select("key", "stack").unionByName(
        active.select(end.alias("key"), F.coalesce("rest", F.expr(f"cast(array() as {_STACK})")).alias("stack")))


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", ranges: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(F.col("url"))
    urls = own_columns(pages, ["page_id", "url"]).select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.select("page_id", "host", "path", host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
                       F.expr(f"cast(null as {_STACK})").alias("stack"))
    marks = boundaries(rules).select(
        F.expr("cast(null as bigint)").alias("page_id"), F.lit("").alias("host"), F.lit("").alias("path"),
        "key", F.lit(0).alias("kind"), "stack")
    events = staged(
        urls.withColumn("page_id", F.col("page_id").cast("bigint")).unionByName(marks)
        .repartitionByRange(ranges, "key", "kind", "path", "page_id")
        .withColumn("range", F.spark_partition_id()), "url_events")
    # The stack each range starts with: one row per range, then a scan over those few rows.
    last_mark = events.groupBy("range").agg(
        F.max(F.when(F.col("kind") == 0, F.struct("key", "stack"))).alias("mark"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = last_mark.select("range", F.last("mark.stack", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("now", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fits = F.expr("filter(coalesce(now, carried), r -> startswith(path, r.path))")
    order = F.transform(fits, lambda r: F.struct(
        (F.char_length(r.host) + F.char_length(r.path)).alias("size"), F.char_length(r.host).alias("host_size"),
        r.verdict.alias("verdict"), F.concat(r.host, r.path).alias("rule")))
    won = swept.join(start, "range", "left").withColumn("won", F.array_max(order))
    return won.select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    literals = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), r, strict=True)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*literals)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rule_table(spark, RULES)
    return url_filter(read(spark, sf_dir, "pages"), rules)


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(h, s, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
       (SELECT max_by(h || s, length(h || s)) FROM r
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)) AS rule,
       coalesce((SELECT max_by(v, length(h || s)) FROM r
                 WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)), 'allow') AS verdict
FROM p
"""
