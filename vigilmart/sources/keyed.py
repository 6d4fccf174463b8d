"""Tables of streams in hash buckets of their keys, so a batch opens only what it touches.

A batch writes a run: its rows, one folder per bucket. The map of a version lists the runs that
hold a bucket, with the range of the first key in each; it is one file, written after its runs. Whoever looks up keys opens the runs of their buckets whose ranges meet theirs. When
a bucket that a batch touches has collected too many runs, they are merged into one, and the
next map lists that one alone; older versions keep theirs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from vigilmart.sources.workspace import by_rows

BUCKETS = 8  # for small tables; take so many that a bucket is some 100 MB
MOST_RUNS = 8
BUCKET = "_bucket"
MAP_SCHEMA = "bucket INT, run STRING, n BIGINT, low STRING, high STRING, nulls BOOLEAN"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_run(df: DataFrame, keys: Sequence[str], buckets: int, path: str) -> None:
    """One folder per bucket; what Spark cuts up or joins are the tasks, not the folders."""
    placed = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
    placed.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_parts(spark: SparkSession, schema: str, paths: Iterable[str]) -> DataFrame:
    paths = sorted(paths)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def write_map(spark: SparkSession, root: str, schema: str, rows: list[tuple], version: int) -> None:
    """Publish a version: its map is one file, so what is seen of it is whole."""
    names = [f.name for f in StructType.fromDDL(schema)]
    listed = json.dumps([dict(zip(names, row, strict=True)) for row in rows], default=str)
    table = spark.range(1).select(F.inline(F.from_json(F.lit(listed), f"array<struct<{_typed(schema)}>>")))
    table.coalesce(1).write.mode("overwrite").parquet(f"{root}/map/v={version}")


def _typed(schema: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in StructType.fromDDL(schema))


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions; folders without a file don't count."""
    try:
        files = spark.read.schema("n BIGINT").option("recursiveFileLookup", "true").parquet(f"{root}/map").inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted({int(part[2:]) for f in files for part in f.split("/")[-2:-1] if part.startswith("v=")})


def last_version(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """The highest published version, below ``before`` if given."""
    return max((v for v in versions(spark, root) if before is None or v < before), default=None)


def read_map(spark: SparkSession, root: str, schema: str, before: int | None = None) -> list[Row]:
    """The rows of the last map, below ``before`` if given."""
    version = last_version(spark, root, before)
    return [] if version is None else spark.read.schema(schema).parquet(f"{root}/map/v={version}").collect()


class KeyedLog:
    """Rows by key over all batches; ``merge`` makes of several rows of a key what counts."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        keys: Sequence[str],
        merge: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        buckets: int = BUCKETS,
        most_runs: int = MOST_RUNS,
    ):
        self.spark, self.root, self.schema, self.keys, self.merge = spark, root.rstrip("/"), schema, list(keys), merge
        self.buckets, self.most_runs = buckets, most_runs
        self._maps: dict[int | None, list[Row]] = {}
        self._own: dict[int, DataFrame] = {}
        self._added: dict[int, list[Row]] = {}
        self.whole = isinstance(StructType.fromDDL(schema)[self.keys[0]].dataType, IntegralType)

    def parts(self, before: int | None = None) -> list[Row]:
        """The map of the last version, below ``before`` if given: at most buckets x runs rows."""
        if before is None or before not in self._maps:
            self._maps[before] = read_map(self.spark, self.root, MAP_SCHEMA, before)
        return self._maps[before]

    def _paths(self, parts: Iterable[Row]) -> list[str]:
        return [f"{self.root}/runs/{p['run']}/{BUCKET}={p['bucket']}" for p in parts]

    def _stats(self, rows: DataFrame, run: str | None) -> list[Row]:
        first = F.col(self.keys[0])
        found = rows.groupBy(bucket_of(self.keys, self.buckets).alias("bucket")).agg(
            F.count("*").alias("n"),
            F.min(first).cast("string").alias("low"),
            F.max(first).cast("string").alias("high"),
            F.coalesce(F.bool_or(first.isNull()), F.lit(False)).alias("nulls"),
        )
        return found.select("bucket", F.lit(run).alias("run"), "n", "low", "high", "nulls").collect()

    def _meet(self, a: Row, b: Row) -> bool:
        """Whether a key may be in both."""
        if a["nulls"] and b["nulls"]:
            return True
        if a["low"] is None or b["low"] is None:
            return False
        as_key = int if self.whole else str
        return as_key(a["low"]) <= as_key(b["high"]) and as_key(b["low"]) <= as_key(a["high"])

    def opened(self, rows: DataFrame, before: int) -> list[str]:
        """The folders in which keys of ``rows`` may lie, in the version before a batch."""
        return self._opened(self._touched(rows, before), before)

    def _touched(self, rows: DataFrame, before: int) -> dict[int, Row]:
        """How many rows each bucket gets and the range of their keys; empty if nothing is held yet."""
        stats = self._added.get(before) if rows is self._own.get(before) else None
        return {r["bucket"]: r for r in stats or self._stats(rows, None)} if self.parts(before) else {}

    def _opened(self, touched: dict[int, Row], before: int) -> list[str]:
        return self._paths(p for p in self.parts(before) if p["bucket"] in touched and self._meet(p, touched[p["bucket"]]))

    def matching(self, rows: DataFrame, before: int) -> DataFrame:
        """What earlier batches hold of the keys of ``rows``, merged."""
        touched = self._touched(rows, before)
        opened = self._opened(touched, before)
        earlier = read_parts(self.spark, self.schema, opened)
        if not opened:
            return self.merge(earlier)
        asked = rows.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        asked = by_rows(asked, sum(r["n"] for r in touched.values()))
        return self.merge(earlier.join(asked, same_keys(self.keys, [f"_{k}" for k in self.keys]), "left_semi"))

    def add(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write a batch's run and publish the version with it; a replay writes the same again."""
        run = str(batch_id)
        write_run(rows, self.keys, self.buckets, f"{self.root}/runs/{run}")
        written = read_parts(self.spark, self.schema, [f"{self.root}/runs/{run}"])
        new = self._stats(written, run)
        parts = [*self.parts(batch_id), *new]
        held: dict[int, int] = {}
        for p in parts:
            held[p["bucket"]] = held.get(p["bucket"], 0) + 1
        full = {p["bucket"] for p in new if held[p["bucket"]] > self.most_runs}
        if full:
            merged = self.merge(read_parts(self.spark, self.schema, self._paths(p for p in parts if p["bucket"] in full)))
            write_run(merged, self.keys, self.buckets, f"{self.root}/runs/{run}-merged")
            again = read_parts(self.spark, self.schema, [f"{self.root}/runs/{run}-merged"])
            parts = [*[p for p in parts if p["bucket"] not in full], *self._stats(again, f"{run}-merged")]
        write_map(self.spark, self.root, MAP_SCHEMA, [tuple(p) for p in parts], batch_id)
        self._own[batch_id], self._added[batch_id] = written, new
        return written

    def read(self) -> DataFrame:
        """All keys as of the last version."""
        return self.merge(read_parts(self.spark, self.schema, self._paths(self.parts())))
