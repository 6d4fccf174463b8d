"""URL rules: host-suffix and path-prefix expressions that meet on hash prefixes.

Every URL is expanded into the expressions a rule could be written as (``net/``,
``example.net/en/``), each expression is hashed, URL and rule meet on the first 32 bits of the
digest, and only equal full digests count. Precedence is settled per URL afterwards. Only
built-in functions; each different URL is judged once.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _hashed(df: DataFrame) -> DataFrame:
    """Add the digest of the expression and its first 32 bits."""
    digest = F.sha2(F.col("_expression"), 256)
    return df.withColumn("_digest", digest).withColumn("_short", F.substring(digest, 1, 8))


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and
    all subdomains where the URL's path starts with the rule's. The longest expression wins,
    then the longer host; of one expression with both verdicts block wins. Without a fitting
    rule the verdict is allow.

    NULL and malformed URLs have empty host and path, fit no rule and are allowed. Repeated
    rows stay repeated. Rules with a NULL host, path or verdict are left out. Columns of
    ``pages`` named as the four new ones are replaced.
    """
    taken = {"host", "path", "rule", "verdict"}
    host, path = host_and_path(F.col(url))
    keyed = pages.select(
        *[c for c in pages.columns if c not in taken], host.alias("host"), path.alias("path")
    )
    listed = _hashed(
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
        .select("host", "path", "verdict")
        .withColumn("_expression", F.concat("host", "path"))
    )
    # The shapes that rules have: so many labels of host, so many characters of path. Their
    # number is bounded by the longest rule, not by the number of rules.
    shape = listed.agg(
        F.collect_set(F.size(_labels(F.col("host")))).alias("hosts"),
        F.collect_set(F.length("path")).alias("paths"),
    ).first()
    host_sizes, path_sizes = sorted(shape["hosts"]), sorted(shape["paths"])
    if not host_sizes:
        return keyed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(ALLOW)})

    labels = _labels(F.col("host"))
    suffixes = F.filter(
        F.array(
            *[
                F.when(F.size(labels) >= n, F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
                for n in host_sizes
            ]
        ),
        lambda x: x.isNotNull(),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in path_sizes]),
        lambda x: x.isNotNull(),
    )
    urls = keyed.select("host", "path").distinct()
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    asked = _hashed(urls.withColumn("_expression", F.explode(expressions)))
    known = listed.select(
        "_short",
        F.col("_digest").alias("_full"),
        F.struct(
            F.length("_expression").alias("length"),
            F.length("host").alias("of_host"),
            (F.col("verdict") == BLOCK).alias("blocks"),
            F.col("_expression").alias("rule"),
            F.col("verdict"),
        ).alias("_rank"),
    )
    best = (
        asked.join(known, "_short")
        .where(F.col("_digest") == F.col("_full"))
        .groupBy("host", "path")
        .agg(F.max("_rank").alias("_rank"))
    )
    return keyed.join(best, ["host", "path"], "left").select(
        *keyed.columns,
        F.col("_rank.rule").alias("rule"),
        F.coalesce(F.col("_rank.verdict"), F.lit(ALLOW)).alias("verdict"),
    )
