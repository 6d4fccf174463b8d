"""Merkle fixity audit of WARC archives.

An archive is a set of files, a file a row of records, each at its offset. A record's hash is a
leaf; every level above joins the hashes of an ordered range of offsets, ``FAN`` times as wide
as the ranges below it, up to one root a file. Replicas with equal roots are equal. Where roots
differ, only the children of differing ranges are compared, level by level, down to the
records. Each level is one grouping of the level below, so no file's records are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilmart.sources.workspace import settle

FAN = 16
LEAF_RANGE = 1 << 16  # bytes of offsets under a lowest range
CRLF = "\r\n"


def record(url: Column, payload: Column, content_type: str = "text/html") -> Column:
    """The bytes of a WARC resource record; NULL url and payload count as empty."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{CRLF}Content-Type: {content_type}{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(CRLF + CRLF),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit(CRLF + CRLF), "UTF-8"))


def leaves(records: DataFrame, file: str, offset: str, data: str | None) -> DataFrame:
    """``file``, ``start``, ``length`` and ``hash`` of each record.

    Without ``data`` the records bring their ``length`` and ``hash`` themselves.
    """
    length = F.col("length") if data is None else F.octet_length(F.col(data))
    digest = F.col("hash") if data is None else F.sha2(F.col(data), 256)
    return records.select(
        F.col(file).alias("file"),
        F.col(offset).cast("bigint").alias("start"),
        length.cast("bigint").alias("length"),
        digest.alias("hash"),
    )


def _width(level: int) -> int:
    return LEAF_RANGE * FAN ** (level - 1)


def levels_for(size: int) -> int:
    """Levels until one range covers offsets up to ``size``."""
    level = 1
    while _width(level) <= size:
        level += 1
    return level


def tree(leaf: DataFrame, top: int) -> list[DataFrame]:
    """Level 1 to ``top``: ``file``, ``node`` (number of the offset range) and ``hash``.

    A range's hash covers the start, length and hash of its records, or the numbers and
    hashes of its child ranges, in order. Repeated records of one offset count each.
    """
    out = []
    below = leaf.select(
        "file",
        F.floor(F.col("start") / _width(1)).alias("node"),
        F.struct("start", "length", "hash").alias("child"),
    )
    for level in range(1, top + 1):
        joined = F.array_join(F.transform(F.array_sort(F.collect_list("child")), lambda c: F.to_json(c)), "\n")
        nodes = settle(below.groupBy("file", "node").agg(F.sha2(joined, 256).alias("hash")), f"merkle-{level}")
        out.append(nodes)
        below = nodes.select("file", F.floor(F.col("node") / FAN).alias("up"), F.struct("node", "hash").alias("child"))
        below = below.withColumnRenamed("up", "node")
    return out


def audit(primary: DataFrame, replica: DataFrame, file: str = "file", offset: str = "offset", data: str | None = "record") -> DataFrame:
    """Records in which two replicas differ: file, start, both lengths and hashes, status.

    Status is ``changed``, ``missing`` (only in the primary) or ``extra`` (only in the
    replica). Rows need a file and an offset; those without are left out, NULL data counts as
    missing bytes with a NULL hash. Of records that repeat an offset each different one is
    compared. Empty replicas differ in every record.
    """
    def sound(records: DataFrame) -> DataFrame:
        found = leaves(records.where(F.col(file).isNotNull() & F.col(offset).isNotNull()), file, offset, data)
        return settle(found.fillna({"hash": "", "length": 0}), "leaves")

    left, right = sound(primary), sound(replica)
    size = left.unionByName(right).agg(F.max(F.col("start"))).first()[0] or 0
    top = levels_for(size)
    left_tree, right_tree = tree(left, top), tree(right, top)
    suspects: DataFrame | None = None
    for level in range(top, 0, -1):
        ours, theirs = left_tree[level - 1], right_tree[level - 1].withColumnRenamed("hash", "other")
        if suspects is not None:
            ours = ours.join(suspects, (F.floor(ours["node"] / FAN) == suspects["up"]) & (ours["file"] == suspects["of"]), "left_semi")
            theirs = theirs.join(suspects, (F.floor(theirs["node"] / FAN) == suspects["up"]) & (theirs["file"] == suspects["of"]), "left_semi")
        differing = ours.join(theirs, ["file", "node"], "full").where(~F.col("hash").eqNullSafe(F.col("other")))
        suspects = settle(differing.select(F.col("file").alias("of"), F.col("node").alias("up")), "suspects")

    def reached(leaf: DataFrame) -> DataFrame:
        there = (F.floor(leaf["start"] / LEAF_RANGE) == suspects["up"]) & (leaf["file"] == suspects["of"])
        return leaf.join(suspects, there, "left_semi").distinct()

    ours = reached(left)
    theirs = reached(right).select("file", "start", F.col("length").alias("replica_length"), F.col("hash").alias("replica_hash"))
    alone_left = ours.join(theirs, (ours["file"] == theirs["file"]) & (ours["start"] == theirs["start"]) & (ours["hash"] == theirs["replica_hash"]) & (ours["length"] == theirs["replica_length"]), "left_anti")
    alone_right = theirs.join(ours, (ours["file"] == theirs["file"]) & (ours["start"] == theirs["start"]) & (ours["hash"] == theirs["replica_hash"]) & (ours["length"] == theirs["replica_length"]), "left_anti")
    status = F.when(F.col("hash").isNull(), "extra").when(F.col("replica_hash").isNull(), "missing").otherwise("changed")
    return alone_left.join(alone_right, ["file", "start"], "full").withColumn("status", status)


def archived(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    keep: tuple[str, ...] = (),
    pages_per_file: int = 1024,
) -> DataFrame:
    """Pages as records of an archive: key, ``file``, ``offset``, ``length``, ``hash``, ``record``
    and the columns to ``keep``.

    A file takes the keys of one span of ``pages_per_file`` numbers, in order; records that
    repeat a key follow each other. Rows without a key go to file -1. Lengths and hashes are
    taken before the rows are put in order, so a reader that needs no more moves no record.
    """
    body = record(F.col(url), F.col(payload))
    rows = pages.select(
        F.col(key),
        *keep,
        F.octet_length(body).cast("bigint").alias("length"),
        F.sha2(body, 256).alias("hash"),
        body.alias("record"),
    ).withColumn("file", F.coalesce(F.floor(F.col(key) / pages_per_file), F.lit(-1)))
    before = Window.partitionBy("file").orderBy(key, "hash").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return rows.withColumn("offset", offset).select(key, "file", "offset", "length", "hash", "record", *keep)
