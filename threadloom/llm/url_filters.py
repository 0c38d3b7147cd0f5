"""URL rules by host suffix and path prefix; column functions only.

Each URL is expanded into its host suffixes times its path directories. The expressions meet the
rules in an equi-join on the first bytes of a digest; then the full digest, the whole path of the
rule and the precedence decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import prepare

# Hexadecimal digits of the digest that are joined on.
PREFIX_DIGITS = 8
# Rules up to this many are sent to the URLs; more are joined by a shuffle.
BROADCAST_RULES = 200_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path of a URL; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _directory(path: Column) -> Column:
    """The part up to the last slash: what a rule's path and a URL's path can share by equality."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _expressions(host: Column, path: Column, most_labels: int, most_steps: int) -> Column:
    """All host suffix + path directory texts of a URL, the path's empty prefix included.

    Suffixes and directories deeper than those of any rule cannot meet one and are not made.
    """
    labels, steps = F.split(host, r"\."), F.split(_directory(path), "/")
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - (most_labels - 1)), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    deepest = F.least(F.size(steps) - 1, F.lit(most_steps))
    prefixes = F.concat(F.array(F.lit("")), F.when(deepest > 0, F.transform(
        F.sequence(F.lit(1), deepest),
        lambda i: F.concat(F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/")),
    )).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(F.transform(
        suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, F.lit("\n"), p)))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains if
    the URL's path starts with the rule's path. Of several the longest (host and path together) wins,
    of equal ones the block. Rules with a null field do not count. URLs that no rule fits get a null
    rule and ``default``; null URLs and those without ``://`` have empty host and path. Every row is
    kept, equal ones too; columns already called like the four are replaced.
    """
    prepare(pages.sparkSession)
    host, path = url_parts(F.col(url))
    digest = F.sha2("expression", 256)
    clean = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    clean = clean.dropna().distinct()
    size = clean.agg(
        F.count("*").alias("n"), F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.max(F.size(F.split(_directory(F.col("rule_path")), "/"))).alias("steps"),
    ).first()
    # Equal addresses are judged once, so that one hot URL is one row in the join.
    known = pages.select(host.alias("host"), path.alias("path")).filter("host <> ''").distinct()
    asked = known.withColumn(
        "expression", F.explode(_expressions(F.col("host"), F.col("path"), size["labels"] or 1, (size["steps"] or 1) - 1)))
    asked = asked.select("host", "path", digest.alias("digest")).withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    listed = clean.withColumn("expression", F.concat("rule_host", F.lit("\n"), _directory(F.col("rule_path")))).select(
        digest.alias("rule_digest"), "rule_host", "rule_path", "rule_verdict", F.concat("rule_host", "rule_path").alias("rule"),
    ).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    small = size["n"] <= BROADCAST_RULES
    hits = asked.join(F.broadcast(listed) if small else listed, "short").filter(
        (F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path"))
        & F.concat(F.lit("."), "host").endswith(F.concat(F.lit("."), "rule_host")))
    order = F.struct(F.length("rule"), F.col("rule_verdict") == "block", "rule")
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "rule_verdict"), order).alias("best"))
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    # The row's own columns go in one, so that none of them can clash with a name of the join.
    judged = pages.select(F.struct(*keep).alias("row"), host.alias("host"), path.alias("path")).join(best, ["host", "path"], "left")
    return judged.select(
        "row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
