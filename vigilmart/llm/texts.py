"""Whole texts known by a digest: work done once per distinct text, carried back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_HOT = 4096


def digest(text: Column) -> Column:
    """128 bits of the text's SHA-256; NULL counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key`` and ``_digest`` of every row."""
    return docs.select(F.col(key).cast("bigint").alias("_key"), digest(F.col(text)).alias("_digest"))


def carried(rows: DataFrame, measures: DataFrame, on: str | list[str] = "_digest", copies: str = "copies") -> DataFrame:
    """Join ``rows`` with the one row of ``measures`` of their key ``on``.

    ``copies`` says how many rows have a key. Keys that more than one row in ``MOST_HOT`` has
    are at most ``MOST_HOT``; their measures are sent to all tasks, so that no task has to take
    all rows of a key. The others are joined by a shuffle.
    """
    on = [on] if isinstance(on, str) else on
    total = measures.agg(F.sum(copies)).first()[0] or 0
    often = F.col(copies) * MOST_HOT > F.lit(total)
    hot = F.broadcast(measures.where(often))
    rest = rows.join(hot.select(*on), on, "left_anti")
    return rows.join(hot, on).unionByName(rest.join(measures.where(~often), on))


def of_digests(docs: DataFrame, wanted: DataFrame, text: str, most_sent: int = 250_000) -> DataFrame:
    """``_digest`` and ``_text`` of each text that ``wanted`` names, once.

    Up to ``most_sent`` digests are sent to the tasks that read the texts; with more, one row
    of every text is taken before the join, so that copies of one text never meet in a task.
    """
    source = docs.select(digest(F.col(text)).alias("_digest"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    wanted = wanted.select("_digest")
    if wanted.count() <= most_sent:
        return source.join(F.broadcast(wanted), "_digest", "left_semi").groupBy("_digest").agg(F.first("_text").alias("_text"))
    return source.groupBy("_digest").agg(F.first("_text").alias("_text")).join(wanted, "_digest", "left_semi")
