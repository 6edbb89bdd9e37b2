"""URL filter: host-suffix and path-prefix expressions, matched by short hashes, confirmed by full digests.

A URL is expanded into every suffix of its host's labels with every prefix of its path that a rule could have (rule paths
come in few lengths). Expressions meet rules in an equi-join on the first eight digits of their SHA-256; the whole digest
then confirms the match, and the longest rule wins. Each distinct host and path is expanded once, however many rows have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recado.operators.skew import attach, broadcast_if_small
from recado.sources.staging import staged

PREFIX = 8  # hexadecimal digits of the short hash
RULE_SCHEMA = "host string, path string, verdict string"


def _lower(c: Column) -> Column:
    """A-Z as a-z, nothing else changed."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> dict[str, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or
    the end. Both are empty for NULL and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return {"host": _lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)}


def _digest(host: Column, path: Column) -> Column:
    """The host is told from the path by a character that no host has."""
    return F.sha2(F.concat(host, F.lit("/"), path).cast("binary"), 256)


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """``urls`` (host, path) with a row for each host suffix and each path prefix of one of ``lengths`` characters."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.filter(F.array(*[
        F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull()))
    return urls.withColumn("_suffix", F.explode(suffixes)).withColumn("_prefix", F.explode(prefixes))


def judge(pages: DataFrame, rules: DataFrame, row_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``row_id``, ``host``, ``path``, ``rule`` (host and path as one; NULL without a match) and ``verdict`` of each row.

    A rule (host, path, verdict) fits its host and all subdomains, if the URL's path starts with its path. The longest rule
    wins; of equally long ones that with the longer host; of rules for one host and path a block. Rules' hosts are compared
    in lower case; a NULL host or path in a rule is empty, and a rule without a host fits only URLs without one. Without a
    rule the verdict is ``default``. The number of distinct lengths of rule paths, some dozens at most, comes to the driver.
    """
    known = rules.select(_lower(F.coalesce("host", F.lit(""))).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
    known = staged(known.groupBy("r_host", "r_path").agg(F.max_by("verdict", F.col("verdict") == "block").alias("r_verdict")).withColumn(
        "digest", _digest(F.col("r_host"), F.col("r_path"))).withColumn("short", F.substring("digest", 1, PREFIX)), "rules")
    lengths = sorted(r["n"] for r in known.select(F.length("r_path").alias("n")).distinct().collect())
    rows = pages.select(F.col(row_id).alias("_id"), *[c.alias(n) for n, c in host_and_path(F.col(url)).items()])
    urls = staged(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_rows")), "urls")
    found = expressions(urls, lengths).withColumn("_digest", _digest(F.col("_suffix"), F.col("_prefix"))).withColumn(
        "short", F.substring("_digest", 1, PREFIX)).join(broadcast_if_small(known), "short").where(F.col("_digest") == F.col("digest"))
    order = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"))
    best = found.groupBy("host", "path").agg(F.max_by(F.struct("r_host", "r_path", "r_verdict"), order).alias("best"))
    verdicts = urls.join(best, ["host", "path"], "left").select(
        "host", "path", "n_rows", F.concat("best.r_host", "best.r_path").alias("rule"),
        F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"))
    return attach(rows, staged(verdicts, "verdicts"), ["host", "path"], ["rule", "verdict"], ["_id"]).select(
        F.col("_id").alias(row_id), "host", "path", "rule", "verdict")
