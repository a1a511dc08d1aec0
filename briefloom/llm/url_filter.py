"""URL filtering by hashed host-suffix and path-prefix expressions.

Every URL becomes the expressions ``suffix + prefix`` of its host suffixes and of
its path prefixes; an equi-join on four bytes of their SHA-256 finds the rules
that may fit, the full digest confirms them, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    ascii_low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(ascii_low, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(urls: DataFrame, rules: DataFrame, default: str = "allow", prefix_bytes: int = 4) -> DataFrame:
    """(url, host, path, rule, verdict) for the distinct rows of a column ``url``.

    ``rules``: (host, path, verdict).  A rule fits its host and all subdomains if
    the path starts with the rule's; the longest ``host + path`` wins, then the
    longer host, then ``block``.  A url that is null or has no ``://`` has an
    empty host and path and gets ``default``, as does an empty table of rules.
    Path prefixes are taken at the distinct lengths of the rules' paths (a list
    as long as the longest rule at most), so any prefix can be a rule.
    """
    rules = rules.select(F.lower("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    # one number per distinct length: no more than the longest path has characters
    lengths = sorted(r[0] for r in rules.select(F.length("r_path")).distinct().collect())
    rules = rules.withColumn("r_full", F.sha2(F.concat("r_host", F.lit("\x00"), "r_path").cast("binary"), 256))
    rules = rules.withColumn("r_short", F.substring("r_full", 1, 2 * prefix_bytes))
    parts = urls.select(F.col("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).distinct()
    labels = F.split("host", r"\.")
    expanded = (
        parts.filter(F.col("host") != "")
        .withColumn("suffix", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))))
        .withColumn("r_length", F.explode(F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))))
        .withColumn("full", F.sha2(F.concat("suffix", F.lit("\x00"), F.expr("substring(path, 1, r_length)")).cast("binary"), 256))
        .withColumn("short", F.substring("full", 1, 2 * prefix_bytes))
    )
    hits = expanded.join(rules, (F.col("short") == F.col("r_short")) & (F.col("full") == F.col("r_full")))
    rank = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), (F.col("r_verdict") == "block").cast("int"), "r_host", "r_path")
    best = hits.groupBy(F.col("url").alias("b_url")).agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")), rank).alias("best"))
    out = parts.join(best, F.col("url") == F.col("b_url"), "left")
    return out.select("url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def judge_pages(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row (page_id, host, path, rule, verdict) per row of ``pages``.

    Repeated rows and repeated or null page_ids give a row each; the distinct
    URLs are judged once, so a hot URL costs one expansion.
    """
    rows = pages.select("page_id", "url")
    judged = filter_urls(rows.select("url"), rules, default)
    host, path = host_of(F.col("p_url")), path_of(F.col("p_url"))
    fits = judged.filter("rule is not null").select(F.col("url").alias("j_url"), "rule", "verdict")
    return (
        rows.withColumnRenamed("url", "p_url")
        .join(fits, F.col("p_url") == F.col("j_url"), "left")
        .select("page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    )
