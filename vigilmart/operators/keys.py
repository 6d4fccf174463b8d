"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilmart.sources.workspace import settle

# monotonically_increasing_id keeps the row position in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def dense_key(df: DataFrame, order_by: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Number rows start+1, start+2, ... in the order of ``order_by`` (NULLs last).

    The rows are range-partitioned and sorted once and written with their partition and
    position. Only the size of each partition comes to the driver; the key is then a
    projection over the written table, with no further shuffle. Ranges are sampled, so
    numbering must read the written rows, never a second run of the partitioning.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    table = settle(placed, f"key-{name}")
    sizes = {r["_part"]: r["n"] for r in table.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    counts = [sizes.get(part, 0) for part in range(max(sizes, default=0) + 1)]
    before = F.array(*[F.lit(n).cast("bigint") for n in accumulate([start, *counts[:-1]])])
    key = (F.element_at(before, F.col("_part") + 1) + F.col("_pos") + 1).alias(name)
    return table.select(key, *df.columns)
