"""URL filters: host-suffix and path-prefix expressions, joined on short digest prefixes.

A URL is expanded into every (host suffix, directory prefix) expression that a rule of the given
set could have. Expressions meet the rules on the first digits of a SHA-256 digest; the full digest
and the rule's path confirm a meeting, and the longest rule wins. Everything is a DataFrame
expression: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that expressions and rules are joined on.
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null gives ""."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; null or no ``://`` gives ""."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rules given as (verdict, "host/path"), as the columns verdict, host and path."""
    split = [(verdict, *rule.partition("/")[::2]) for verdict, rule in rules]
    rows = [
        F.struct(F.lit(verdict).alias("verdict"), F.lit(host).alias("host"), F.lit(f"/{path}").alias("path"))
        for verdict, host, path in split
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _directory(path: Column) -> Column:
    """Up to and with the last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def _expressions(host: Column, path: Column, labels: int, depth: int) -> Column:
    """Digest input of each host suffix of at most ``labels`` labels with the empty path and each
    directory prefix of at most ``depth`` slashes. No rule is larger, so nothing is missed."""
    # substring_index stops at the ends; the distinct values are the suffixes and prefixes
    hosts = F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in range(1, labels + 1)]))
    cut = [F.substring_index(path, "/", n) for n in range(1, depth + 1)]
    slashes = F.array(*[F.when(F.length(path) > F.length(c), F.concat(c, F.lit("/"))) for c in cut])
    paths = F.array_distinct(F.array_compact(F.concat(F.array(F.lit("")), slashes)))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule and verdict.

    A rule (verdict, host, path) fits its host and all subdomains where the URL's path starts with the
    rule's. The longest fitting rule wins (host and path together); of equal ones the one with the
    longer host, then block before allow. Without a rule the verdict is ``default`` and the rule null.

    A null URL, an empty one or one without ``://`` has an empty host and path and fits no rule.
    Repeated pages and repeated rules are judged alike; rules with a null are left out; an empty page
    or rule table works. Only ``key`` and ``url`` are read, so other columns may have any name.
    """
    judged = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = rules.filter("verdict IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL").select(
        F.col("verdict").alias("_verdict"),
        F.col("host").alias("_host"),
        F.col("path").alias("_path"),
        F.sha2(F.concat(F.col("host"), _directory(F.col("path"))), 256).alias("_digest"),
    )
    # one row: no URL needs more labels or directories than the largest rule has
    labels, depth = known.agg(
        F.coalesce(F.max(F.size(F.split("_host", r"\."))), F.lit(1)),
        F.coalesce(F.max(F.size(F.split("_path", "/")) - 1), F.lit(1)),
    ).first()
    known = known.select(F.substring("_digest", 1, PREFIX_DIGITS).alias("_prefix"), "*")

    # a host that holds a third of the pages is expanded once per distinct URL, not once per page
    urls = judged.filter("host <> ''").select("host", "path").distinct()
    digest = F.explode(F.transform(_expressions(F.col("host"), F.col("path"), labels, max(depth, 1)), lambda e: F.sha2(e, 256)))
    asked = urls.select("host", "path", digest.alias("_asked")).select(
        "*", F.substring("_asked", 1, PREFIX_DIGITS).alias("_prefix")
    )
    on_host = (F.col("host") == F.col("_host")) | F.col("host").endswith(F.concat(F.lit("."), F.col("_host")))
    fits = (F.col("_asked") == F.col("_digest")) & on_host & F.col("path").startswith(F.col("_path"))
    rule = F.concat("_host", "_path")
    rank = F.struct(F.length(rule), F.length("_host"), (F.col("_verdict") == "block").cast("int"), rule)
    best = (
        asked.join(known, "_prefix")
        .filter(fits)
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(rule.alias("rule"), F.col("_verdict").alias("verdict")), rank).alias("_best"))
    )
    return judged.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )
