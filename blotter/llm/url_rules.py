"""URL filters: allow and block rules on host and path, by a sort-merge range join.

A host's labels are reversed and each ends with a dot (``www.example.com``
-> ``com.example.www.``), so a rule's host and all its subdomains are one
interval of keys. Intervals of rules are nested or disjoint. The rules'
interval ends and the URLs are sorted together by key and swept: each
interval end carries the stack of rules that are active after it, and a
URL takes the stack of the last interval end before it. Of that stack the
longest rule whose path starts the URL's path wins.

The sweep runs in parallel: keys are dealt by their first label (no rule
crosses it) and a salt of the URL, with the rules' interval ends present
in every salt, so a label or host with most of the URLs spreads over all
tasks. Only the rules (a parameter, not data) are replicated. DataFrame
functions only.

Defined results: a URL that is null or has no ``://`` has empty host and
path and no rule; the path of a URL without one is empty, so the rule
``com/`` does not fit it; repeated rows are judged each; a rule without
host fits nothing, a null rule path is empty; of equal rules ``block``
wins, of equally long fitting rules that with the longer host.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"
CLOSE, OPEN, URL = 0, 1, 2


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, AUTHORITY, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AUTHORITY, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.com`` -> ``com.example.www.``; empty for an empty host."""
    return F.when(host == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _interval_ends(rules: DataFrame) -> DataFrame:
    """(key, kind, stack): the stack of active rules after each interval's start and end."""
    r = (rules.select(lower_ascii(F.col("host")).alias("host"),
                      F.coalesce("path", F.lit("")).alias("path"), "verdict")
              .filter("host <> ''")
              .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
              .withColumn("key", host_key(F.col("host"))))
    labels = F.split("key", r"\.")
    outer = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                        lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))
    nested = (r.select("key").distinct()
               .select(F.col("key").alias("node"), F.explode(outer).alias("key"))
               .join(r, "key"))
    # Longest first; of equal length the longer host.
    entry = F.struct(-F.length(F.concat("host", "path")), -F.length("host"), "path",
                     F.concat("host", "path").alias("rule"), "verdict", "key")
    nodes = nested.groupBy("node").agg(F.sort_array(F.collect_list(entry)).alias("stack"))
    below = F.filter("stack", lambda e: e["key"] != F.col("node"))
    keep = lambda s: F.transform(s, lambda e: F.struct(e["path"].alias("path"),
                                                       e["rule"].alias("rule"), e["verdict"].alias("verdict")))
    starts = nodes.select(F.col("node").alias("key"), F.lit(OPEN).alias("kind"), keep(F.col("stack")).alias("stack"))
    # The first key after all keys that start with "x." is "x/": '/' follows '.', and no host holds it.
    after = F.concat(F.expr("substring(node, 1, length(node) - 1)"), F.lit("/"))
    ends = nodes.select(after.alias("key"), F.lit(CLOSE).alias("kind"), keep(below).alias("stack"))
    return starts.unionByName(ends)


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", salts: int | None = None) -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of ``urls``.

    ``rules`` has the columns host, path and verdict (``allow`` or
    ``block``). A URL that no rule fits has a null rule and the verdict
    ``default``. ``salts`` (as many as shuffle partitions unless given) is
    over how many tasks one top label's URLs are spread.
    """
    n = salts or shuffle_partitions(urls.sparkSession)
    # The first label with its dot, or without one where the key has ended ("com/").
    shard = F.regexp_extract("key", r"^([^./]*)", 1)
    ends = (_interval_ends(rules)
            .select(F.lit(None).cast(urls.schema[id_col].dataType).alias("id"), "key", "kind",
                    F.lit("").alias("host"), F.lit("").alias("path"), "stack",
                    F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("salt")))
    rows = (urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
                .select("id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
                .select("id", host_key(F.col("host")).alias("key"), F.lit(URL).alias("kind"), "host", "path",
                        F.lit(None).cast(ends.schema["stack"].dataType).alias("stack"),
                        F.pmod(F.xxhash64("id", "url"), F.lit(n)).cast("int").alias("salt")))
    sweep = (Window.partitionBy("shard", "salt").orderBy("key", "kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = (ends.unionByName(rows).withColumn("shard", shard)
             .withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
             .filter(F.col("kind") == URL))
    fits = F.filter("stack", lambda e: F.startswith(F.col("path"), e["path"]))
    best = swept.withColumn("best", F.get(fits, F.lit(0)))
    return best.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
