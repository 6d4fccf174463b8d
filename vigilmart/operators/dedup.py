"""Latest row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: str | Sequence[Column] | None = None,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the newest, where a NULL time counts as newest.

    Equal times fall back to ``ties`` (default: all other columns), so the choice never
    depends on row order. Spark keeps only the best row of each key per input partition
    before the shuffle, so a key that holds a large part of the rows sends one row per
    partition to its task.
    """
    if newest is None:
        order = []
    elif isinstance(newest, str):
        order = [F.col(newest).desc_nulls_first()]
    else:
        order = list(newest)
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != newest]
    order += [F.col(c).asc_nulls_last() for c in ties]
    order = order or [F.col(c) for c in keys]
    best_first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(best_first)).where("_rank = 1").drop("_rank")
