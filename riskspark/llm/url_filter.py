"""URL allow and block rules by host-suffix and path-prefix expressions.

Every distinct URL is expanded into the expressions host suffix + path prefix
whose shapes (number of host labels, path length) occur among the rules, each
expression is joined to the rules on a 32-bit prefix of its SHA-256 digest, the
full digest confirms the hit, and the longest rule decides.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the operator adds; input columns of these names are replaced.
ADDED = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest_prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def url_verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (``host`` + ``path`` of the rule or null) and verdict.

    ``rules`` has columns host, path, verdict (``allow`` or ``block``).  A rule
    fits its host and all subdomains where the URL's path starts with the
    rule's path.  Of the fitting rules the longest expression wins; among equal
    lengths the one with the longer host, and block before allow where the same
    expression is listed twice.  No fitting rule: ``default``.

    A null URL or one without ``://`` has host and path empty and fits no rule;
    so does an empty host.  Rules with a null part or an empty host are unusable
    and ignored.  Repeated rows each come back; an empty rule table gives
    ``default`` everywhere; input columns called host, path, rule or verdict are
    replaced and all others kept.

    Judging runs once per distinct URL, so a URL or host that holds a third of
    the rows costs one row after the partial aggregation; the last join brings
    the verdicts back and is one that adaptive execution can split.
    """
    usable = rules.where("host is not null and host <> '' and path is not null and verdict is not null").select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    # the shapes of rules: at most a few hundred small integers each, read as scalar subqueries
    labels = usable.agg(F.array_sort(F.collect_set(F.size(F.split("r_host", r"\."))))).scalar()
    lengths = usable.agg(F.array_sort(F.collect_set(F.length("r_path")))).scalar()

    listed = usable.select("r_host", "r_path", "r_verdict", F.sha2(F.concat("r_host", "r_path"), 256).alias("r_digest"))
    listed = listed.withColumn("prefix", _digest_prefix(F.col("r_digest")))

    urls = pages.select(F.col(url_col).alias("u")).distinct().select("u", url_host(F.col("u")).alias("h"), url_path(F.col("u")).alias("p"))
    parts = urls.where("h <> ''").select("u", "h", "p", F.size(F.split("h", r"\.")).alias("n"), labels.alias("labels"), lengths.alias("lengths"))
    hosts = parts.select("u", "p", "lengths", F.explode(F.expr("transform(filter(labels, k -> k <= n), k -> substring_index(h, '.', -k))")).alias("suffix"))
    exprs = hosts.select("u", "suffix", F.explode(F.expr("transform(filter(lengths, k -> k <= length(p)), k -> substring(p, 1, k))")).alias("start"))
    digests = exprs.withColumn("digest", F.sha2(F.concat("suffix", "start"), 256)).withColumn("prefix", _digest_prefix(F.col("digest")))

    hits = digests.join(listed, "prefix").where("digest = r_digest and suffix = r_host and start = r_path")
    strength = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("total"), F.length("r_host").alias("host"),
        F.when(F.col("r_verdict") == "block", 1).otherwise(0).alias("block"),
        F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))
    best = hits.groupBy("u").agg(F.max(strength).alias("best"))

    kept = [c for c in pages.columns if c not in ADDED]
    url = F.col("page.u")
    framed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.struct(F.col(url_col).alias("u")).alias("page"))
    judged = framed.join(best, url.eqNullSafe(F.col("u")), "left")
    return judged.select("row.*", url_host(url).alias("host"), url_path(url).alias("path"), F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
