"""URL filters: host-suffix and path-prefix expressions, hash-prefix equi-join, digest confirmation, rule precedence.

DataFrame functions only. A URL expands to (suffixes of its host) x (prefixes of its path), of as many labels and
characters as occur among the rules' hosts and paths; both sides carry the SHA-256 of host and path, join on its first
eight hex digits, and only then compare whole digests. A URL has a few dozen expressions at most, and expansion is of
distinct (host, path head) pairs, so that a host with a third of all rows is expanded and joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.storage import apart

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules join by broadcast up to this many rows; beyond it by shuffle.
BROADCAST_RULES = 50_000


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    rest = F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.locate("://", url) > 0, host).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    rest = F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def host_suffixes(host: Column, counts: list[int]) -> Column:
    """The host's last labels, as many as each of ``counts`` says, where it has them."""
    labels = F.split(host, r"\.", -1)
    each = [F.when(F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), ".")) for n in counts]
    return F.array_compact(F.array(*each)) if each else F.array().cast("array<string>")


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judges every row of ``pages`` by the longest rule that fits.

    ``rules`` has string columns ``host``, ``path`` (with its leading slash) and ``verdict``. A rule fits its host and
    all subdomains if the URL's path starts with the rule's. Longest host and path together win; among equally long
    rules the longer host, then ``block``, then the smaller rule text. Returns ``id_col, host, path, rule, verdict``,
    one row for each input row: repeated rows stay repeated, null or malformed URLs have empty host and path and the
    default verdict, null ids are kept, an empty table gives an empty result, other columns are ignored.
    """
    rules = rules.where("host is not null and path is not null and verdict is not null").select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    ).distinct()
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())  # bounded by the longest URL
    counts = sorted(r[0] for r in rules.select(F.size(F.split("rule_host", r"\.", -1))).distinct().collect())
    rules = rules.withColumns({"rule_digest": F.sha2(F.concat("rule_host", F.lit("\n"), "rule_path"), 256), "rule": F.concat("rule_host", "rule_path")})
    rules = rules.withColumn("short", F.substring("rule_digest", 1, 8))

    parts = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    longest = lengths[-1] if lengths else 0
    parts = parts.withColumn("head", F.substring("path", 1, longest))
    keys = parts.select("host", "head").distinct()
    heads = F.array_distinct(F.array(*(F.substring("head", 1, n) for n in lengths))) if lengths else F.array(F.lit(""))
    spread = keys.select("host", "head", F.explode(host_suffixes(F.col("host"), counts)).alias("suffix")).select("host", "head", "suffix", F.explode(heads).alias("prefix"))
    spread = spread.withColumn("digest", F.sha2(F.concat("suffix", F.lit("\n"), "prefix"), 256)).withColumn("short", F.substring("digest", 1, 8))
    small = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    hits = spread.join(F.broadcast(rules) if small else rules, "short").where("digest = rule_digest")
    rank = F.struct(F.length("rule"), F.length("rule_host"), (F.col("rule_verdict") == "block").alias("b"))
    best = hits.groupBy("host", "head").agg(
        F.max(F.struct(rank.alias("rank"), "rule", F.col("rule_verdict").alias("verdict"))).alias("best")
    ).select("host", "head", "best.rule", "best.verdict")
    out = parts.join(apart(best), ["host", "head"], "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
