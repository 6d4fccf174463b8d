"""Mixing sources to target weights by systematic sampling.

Within a source every document expects the same number of copies, the source's target over
its size. The expected copies are summed up along the documents, from small to large, one
offset is added per source, and a document is emitted once for each whole number the sum
crosses. In this order a document's neighbours have its size, so the words taken differ from
the target by little more than the largest document.

The running sum needs no global sort: documents are counted by source, size and bucket of
their id; the few distinct sizes of a source and the buckets of a size are summed by windows;
only then are the rows of one bucket numbered. A source, or a size, that holds a third of all
rows is thus spread over about sqrt(rows) buckets. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
MOST_REPEATED = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """Add ``target`` to rows of ``_source``, ``_none`` (a NULL source) and ``source_size``.

    Sources by code point, NULL last, weigh ``weights`` in turn. Targets are in proportion to
    the weights, but none exceeds ``most`` times its source's size; what is cut off goes to
    the others by weight. With sources sorted by the level at which they are full, the
    common level is the first that the next source can hold.
    """
    everyone = Window.partitionBy()
    place = F.row_number().over(everyone.orderBy("_none", "_source"))
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (place - 1) % len(weights) + 1)
    full = F.col("source_size") * most
    rising = everyone.orderBy("_full_at", "_none", "_source").rowsBetween(Window.unboundedPreceding, -1)
    falling = everyone.orderBy("_full_at", "_none", "_source").rowsBetween(0, Window.unboundedFollowing)
    level = (
        share * F.sum("source_size").over(everyone) - F.coalesce(F.sum(full).over(rising), F.lit(0))
    ) / F.sum("_weight").over(falling)
    return (
        sources.withColumn("_weight", weight)
        .withColumn("_full_at", full / F.col("_weight"))
        .withColumn("_level", level)
        .withColumn("_common", F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "_level"))).over(everyone))
        .withColumn(
            "target",
            F.coalesce(F.least(full.cast("double"), F.col("_weight") * F.col("_common._level")), full.cast("double")),
        )
        .drop("_weight", "_full_at", "_level", "_common")
    )


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source alone, in steps of 1/65536."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") / 65536


def mix(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    weights=WEIGHTS,
    share=SHARE,
    most=MOST,
    seed: str = "mix",
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``most``).

    ``key`` is a whole number that orders documents of one size. NULL sources form a source of
    their own, the last; documents of size 0 count as any other and weigh nothing; an empty
    table stays empty. Rows that repeat a key, or have none, are documents of their own, ordered
    by a digest of all their columns. Columns of ``docs`` named as the new ones are replaced.
    Reruns agree, as nothing depends on row order: rows that tie are equal in every column.

    Documents of one source and size are numbered in buckets by key; rows without a key, and
    those of keys that more than one row in ``MOST_REPEATED`` has, are dealt by their digest.
    """
    new = ("size", "source_size", "target", "copies")
    n_rows = docs.count()
    buckets = max(1, math.ceil(math.sqrt(n_rows)))
    repeated = docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") * MOST_REPEATED > n_rows)
    hot = [r[key] for r in repeated.where("_n > 1").select(key).collect()]  # at most MOST_REPEATED
    digest = F.xxhash64(*docs.columns)
    by_key = F.pmod(F.col(key), F.lit(buckets))
    by_digest = F.pmod(digest, F.lit(buckets))
    rows = docs.withColumns(
        {
            "_words": size,
            "_source": F.coalesce(F.col(source), F.lit("")),
            "_none": F.col(source).isNull(),
            "_bucket": F.when(F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False)), by_digest).otherwise(by_key),
            "_digest": digest,
        }
    ).drop(*new)
    of = ["_none", "_source"]
    cells = rows.groupBy(*of, "_words", "_bucket").agg(F.count("*").alias("_n"))
    sizes = cells.groupBy(*of, "_words").agg(F.sum("_n").alias("_n"))
    sources = sizes.groupBy(*of).agg(F.sum(F.col("_n") * F.col("_words")).alias("source_size"))
    back = (Window.unboundedPreceding, -1)
    by_size = Window.partitionBy(*of).orderBy("_words").rowsBetween(*back)
    by_bucket = Window.partitionBy(*of, "_words").orderBy("_bucket").rowsBetween(*back)
    below = sizes.select(*of, "_words", F.coalesce(F.sum("_n").over(by_size), F.lit(0)).alias("_below"))
    starts = (
        cells.select(*of, "_words", "_bucket", F.coalesce(F.sum("_n").over(by_bucket), F.lit(0)).alias("_before"))
        .join(below, [*of, "_words"])
        .join(targets(sources, weights, share, most), of)
    )
    numbered = rows.join(starts, [*of, "_words", "_bucket"]).withColumn(
        "_rank",
        F.row_number().over(Window.partitionBy(*of, "_words", "_bucket").orderBy(key, "_digest")) + F.col("_before") + F.col("_below"),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = F.when(F.col("_none"), offset(F.lit(None).cast("string"), seed)).otherwise(offset(F.col("_source"), seed))

    def crossed(rank: Column) -> Column:
        return F.floor(start + rate * rank)

    copies = F.least(crossed(F.col("_rank")) - crossed(F.col("_rank") - 1), F.lit(most).cast("bigint"))
    return numbered.select(
        *[c for c in docs.columns if c not in new],
        F.col("_words").alias("size"),
        "source_size",
        "target",
        copies.alias("copies"),
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """Each row as often as its copies say."""
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop("_copy")
