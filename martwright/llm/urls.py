"""URL filter by rules on hosts and paths (method: expansion, hash-prefix join, digest check).

Each URL is expanded into expressions: the suffixes of its host that have as many labels as some rule's
host, with every beginning of its path that is as long as some rule's path; so the work for a URL grows with its
length and the rules, not with the square of its labels. Expressions meet rules by the first four bytes of their
SHA-256, which are cheap to shuffle; the few that meet are then compared by the whole digest, and of
the rules that fit the longest decides. Runs in the JVM only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8  # hex digits of the digest that expressions are joined on
DEFAULT = "allow"  # the verdict where no rule fits


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A to Z in lower case) and path of a URL; both empty for null or without `://`."""
    known = F.coalesce(url, F.lit(""))
    has = F.instr(known, "://") > 0
    rest = F.regexp_replace(known, r"(?s)^.*?://", "")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, lower).otherwise(""), F.when(has, path).otherwise("")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule and verdict; columns with these names give way, all others stay.

    `rules` has host, path and verdict (allow or block). A rule fits its host and all subdomains, if
    the URL's path starts with the rule's. The longest host and path together win, then the longer
    host, then block. Pages of one URL are judged once, so that a frequent URL is one row in the join.
    Rules with a null host, path or verdict fit nothing; repeated rules count once. A null URL has an empty host and path.
    """
    mine = [F.col(f"page.`{c}`").alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rules = rules.select("host", "path", F.col("verdict").alias("_verdict")).dropna().distinct()
    rules = rules.withColumn("_rule", F.concat("host", "path")).withColumn("_digest", F.sha2(F.concat_ws("\n", "host", "path"), 256))
    rules = rules.select(
        F.substring("_digest", 1, PREFIX).alias("_short"), "_digest", "_rule", "_verdict", F.length("host").alias("_wide"), F.size(F.split("host", r"\.")).alias("_labels"))
    # As many as there are numbers of labels, and lengths of paths, among the rules.
    depths = sorted(r[0] for r in rules.select("_labels").distinct().collect())
    lengths = sorted(r[0] for r in rules.select(F.length("_rule") - F.col("_wide")).distinct().collect())

    host, path = split_url(F.col("_url"))
    urls = pages.select(F.col(url).alias("_url")).distinct().select("_url", host.alias("host"), path.alias("path"))
    n_labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    suffixes = F.filter(F.array(*[F.when(F.col("_n") >= n, F.substring_index("host", ".", -n)) for n in depths]).cast("array<string>"), lambda h: h.isNotNull())
    cuts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(cuts, lambda n: F.concat_ws("\n", h, F.substring("path", F.lit(1), n)))))
    asked = urls.withColumn("_n", n_labels).select("_url", F.explode(expressions).alias("_expression")).select("_url", F.sha2("_expression", 256).alias("_asked"))
    met = asked.join(rules, F.substring("_asked", 1, PREFIX) == F.col("_short")).filter(F.col("_asked") == F.col("_digest"))
    best = F.max(F.struct(F.length("_rule"), "_wide", "_verdict", "_rule")).alias("_best")  # "block" sorts behind "allow"
    found = met.groupBy("_url").agg(best)
    judged = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"), F.col(url).alias("_key"))
    judged = judged.join(found, F.col("_key").eqNullSafe(F.col("_url")), "left")
    host, path = split_url(F.col("_key"))
    return judged.select(
        *mine, host.alias("host"), path.alias("path"), F.col("_best._rule").alias("rule"),
        F.coalesce("_best._verdict", F.lit(DEFAULT)).alias("verdict"))
