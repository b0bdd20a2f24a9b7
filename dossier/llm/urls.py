"""URL rules by hashed expressions.

Each URL is expanded into host-suffix and path-prefix expressions, the expressions meet the rules in an equi-join on a
short hash prefix, the full digest confirms a hit, and the longest rule decides.

Defined results: a null URL or one without ``://`` has empty host and path, no rule and the default verdict. An empty rule
table gives every URL the default. Repeated rows stay repeated. Of rules equally long, block wins, then the smaller text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SHORT = 8  # hex digits of the joined prefix
BROADCAST_RULES = 200_000  # rules; about 200 bytes each
SALTS = 16

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(u, SPLIT, 1)), F.regexp_extract(u, SPLIT, 2)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, SHORT), 16, 10).cast("long")


def _prepared(rules: DataFrame) -> DataFrame:
    """One row for each rule text: its digest, its short prefix, its shape and its verdict."""
    return (
        rules.select(ascii_lower(F.col("host")).alias("rh"), F.col("path").alias("rp"), F.col("verdict").alias("rv"))
        .where("rh is not null and rp is not null and rh <> ''")
        .groupBy("rh", "rp")
        .agg(F.max(F.when(F.col("rv") == "block", 1).otherwise(0)).alias("blocks"))
        .select(
            F.concat("rh", "rp").alias("rule"), "blocks",
            F.sha2(F.concat("rh", "rp"), 256).alias("digest"),
            F.size(F.split("rh", r"\.")).alias("labels"), F.length("rp").alias("chars"),
        )
        .withColumn("short", _short(F.col("digest")))
    )


def _expressions(shapes: DataFrame) -> Column:
    """Host suffix and path prefix of the column pair (host, path) in every shape that a rule has, as one array."""
    held = [(r["labels"], r["chars"]) for r in shapes.collect()]
    if not held:
        return F.array().cast("array<string>")
    parts = F.size(F.split("host", r"\."))
    wide = F.from_json(F.lit(json.dumps([{"n": n, "chars": c} for n, c in sorted(held)])), "array<struct<n:int,chars:int>>")
    fit = F.filter(wide, lambda s: (s["n"] <= parts) & (s["chars"] <= F.length("path")) & (F.col("host") != ""))
    return F.array_distinct(F.transform(fit, lambda s: F.concat(F.call_function("substring_index", F.col("host"), F.lit("."), -s["n"]), F.substring(F.col("path"), F.lit(1), s["chars"]))))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for each row of pages.

    The shapes (labels of the host, characters of the path) of the rules are few, as both numbers are short; only
    expressions of such shapes are made, so a URL with thousands of labels stays cheap. The join is on the short prefix alone; the
    full digest then confirms. Repeated rows of one partition are judged once.
    """
    ready = _prepared(rules).persist()
    small = ready.count() <= BROADCAST_RULES
    made = _expressions(ready.select("labels", "chars").distinct())
    host, path = url_parts(F.col("u"))
    rows = (
        pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("u")).withColumn("part", F.spark_partition_id())
        .groupBy("id", "u", "part").agg(F.count(F.lit(1)).alias("copies"))
        .select("id", "u", "part", "copies", host.alias("host"), path.alias("path"))
    )
    spread = rows.select("*", F.explode_outer(made).alias("expression")).withColumn("full", F.sha2("expression", 256)).withColumn("prefix", _short(F.col("full")))
    keep = ready.select("rule", "blocks", "digest", "short")
    if small:
        met = spread.join(F.broadcast(keep), F.col("prefix") == F.col("short"), "left")
    else:  # a hot host is salted over the rules' copies
        salted = keep.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = spread.withColumn("own", F.pmod(F.xxhash64("id", "u", "part"), F.lit(SALTS)).cast("int")).join(
            salted, (F.col("prefix") == F.col("short")) & (F.col("own") == F.col("salt")), "left"
        )
    order = F.struct(F.length("rule").alias("n"), F.col("blocks"), F.col("rule"))
    best = met.groupBy("id", "u", "part", "host", "path", "copies").agg(F.max(F.when(F.col("full") == F.col("digest"), order)).alias("best"))
    return best.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocks") == 1, "block").otherwise("allow").alias("verdict"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_n"),
    ).drop("_n")


SQL = r"""
with p as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages),
h as (
  select page_id, host, path,
    case when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
         when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
         when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
         when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end as rule
  from p)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from h
"""
