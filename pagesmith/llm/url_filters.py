"""URL filters: host-suffix and path-prefix expressions, matched by hash prefix, confirmed by digest.

A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with the rule's.
Each distinct url is expanded into its host suffixes times its path prefixes, as many labels and as long
as some rule has them; the expressions meet the rules on a short hash prefix and are confirmed by the
whole SHA-256 digest. Of several rules that fit, the longest (host and path together) wins, then the
one with the longer host, then ``block`` before ``allow``. Where none fits, the default verdict holds.

A null url, or one without ``://``, has an empty host and path and no rule; a null page id stays null;
repeated rows are judged alike, each for itself; extra columns are ignored; an empty table of pages
gives no rows, and with no rules all pages get the default. Rules without a host, a path or
a known verdict take no part; ``refused_rules`` returns them. Only DataFrame functions run here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the hash prefix.
PREFIX = 8
#: Rules that are broadcast at most (about 300 bytes each); more are joined by a shuffle.
BROADCAST_RULES = 50_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
    there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


_GOOD = "coalesce(length(host) > 0 AND length(path) > 0 AND verdict IN ('allow', 'block'), false)"


def refused_rules(rules: DataFrame) -> DataFrame:
    """The rules that can't be used, all columns as they are: look at them before a long job."""
    return rules.where(f"NOT {_GOOD}")


def digests(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` rules with their digest and hash prefix, one row for each host and path."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    good = rules.where(_GOOD)
    whole = good.select(host.alias("r_host"), F.col("path").alias("r_path"), "verdict")
    one = whole.groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict"))  # block before allow
    digest = F.sha2(F.concat("r_host", "r_path").cast("binary"), 256)
    return one.select(
        "r_host", "r_path", "r_verdict", digest.alias("r_digest"), F.substring(digest, 1, PREFIX).alias("prefix"))


def expressions(urls: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """``host, path`` rows times the suffixes of so many labels and the prefixes of so many characters."""
    parts = F.split("host", r"\.")
    rows = urls.select("host", "path", parts.alias("parts"))
    suffixes = F.filter(F.array(*[F.lit(n) for n in labels]), lambda n: n <= F.size("parts"))
    rows = rows.select("host", "path", "parts", F.explode(suffixes).alias("n"))
    rows = rows.select("host", "path", F.array_join(F.slice("parts", F.size("parts") - F.col("n") + 1, F.col("n")), ".").alias("suffix"))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    rows = rows.select("host", "path", "suffix", F.explode(prefixes).alias("n"))
    return rows.select("host", "path", F.sha2(F.concat("suffix", F.expr("left(path, n)")).cast("binary"), 256).alias("digest"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
                broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = digests(rules)
    size = known.agg(F.count("*"), F.collect_set(F.size(F.split("r_host", r"\."))), F.collect_set(F.length("r_path"))).first()
    if not size[0]:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    asked = rows.where("host != ''").select("host", "path").distinct()
    made = expressions(asked, sorted(size[1]), sorted(size[2])).withColumn("prefix", F.substring("digest", 1, PREFIX))
    known = F.broadcast(known) if size[0] <= broadcast_rules else known
    sure = made.join(known, "prefix").where(F.col("digest") == F.col("r_digest"))
    rule = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("long"), F.length("r_host").alias("host_long"),
        F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule"))
    best = sure.groupBy("host", "path").agg(F.max(rule).alias("best"))
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
