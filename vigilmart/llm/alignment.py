"""Alignment of two tokenizers over a corpus, each distinct text done once.

Documents are shuffled by their full text; each distinct text is tokenised with both
vocabularies and aligned once, by byte offsets. The pairs of tokens that overlap are counted
over the corpus, weighted by how many documents hold the text, and the measures that follow
from these counts are joined back to the ids of all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilmart.llm import texts
from vigilmart.llm.coding import ByteCoder, PieceCoder, vocabulary
from vigilmart.sources.workspace import new_folder, settle

# Pairs with their counts that are sent to all tasks at once; more are sent in rounds.
MOST_SENT = 1_000_000
_CHARS = 1_000_000


@dataclass(frozen=True)
class Aligned:
    """``links``: ids of B and A (B in the upper 32 bits) for each overlap, in byte order."""

    n_groups: int
    links: np.ndarray
    groups: str


class Aligner:
    def __init__(self, a_bytes: np.ndarray, b_bytes: np.ndarray):
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in t], np.int64) for t in (a_bytes, b_bytes))
        self.decimal = np.array([str(i) for i in range(max(len(a_bytes), len(b_bytes)))], object)

    def align(self, whole: bytes, a: list[int], b: list[int]) -> Aligned | None:
        """None where the tokens of one side don't spell ``whole``."""
        a_ids, b_ids = np.array(a, np.int64), np.array(b, np.int64)
        if b"".join(self.a_bytes[a_ids]) != whole or b"".join(self.b_bytes[b_ids]) != whole:
            return None
        a_ends, b_ends = np.cumsum(self.a_lengths[a_ids]), np.cumsum(self.b_lengths[b_ids])
        # Between two neighbouring edges lies exactly one token of either side: one link.
        edges = np.union1d(a_ends, b_ends)
        links = (b_ids[np.searchsorted(b_ends, edges)] << 32) | a_ids[np.searchsorted(a_ends, edges)]
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        b_before = np.searchsorted(b_ends, np.append(0, cuts[:-1]), "right")
        a_through = np.searchsorted(a_ends, cuts, "right")
        listed = np.empty(2 * (len(a_ids) + len(b_ids)), object)
        for ids, ends, of, shift, last in ((a_ids, a_ends, of_a, b_before, "|"), (b_ids, b_ends, of_b, a_through, ";")):
            place = 2 * (np.arange(len(ids)) + shift[of])
            listed[place] = self.decimal[ids]
            listed[place + 1] = np.where(ends == cuts[of], last, ",")
        return Aligned(len(cuts), links, "".join(listed[:-1]))


def _batches(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Parts of a batch of about ``_CHARS`` characters, one text at least."""
    ends = np.cumsum(batch["_text"].str.len().to_numpy())
    first = 0
    while first < len(batch):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _CHARS, "right")))
        yield batch.iloc[first:last]
        first = last


def alignments(distinct: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Tokenise and align each row's ``_text``; ``_digest`` and ``copies`` are kept.

    Adds ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (ids of A and B by group), and
    the different linked pairs as ``pairs`` (B in the upper 32 bits, A in the lower) with their
    ``times``. Texts without tokens have zeros, '' and empty arrays. The two vocabularies are
    files on the driver (ranks; piece model) and go to the workers with the function.
    """
    context = distinct.sparkSession.sparkContext
    with open(a_path, encoding="ascii") as lines:
        ranks = context.broadcast(vocabulary(lines))
    with open(b_path, "rb") as file:
        model = context.broadcast(file.read())

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a_coder, b_coder = ByteCoder(ranks.value), PieceCoder(model.value)
        aligner = Aligner(a_coder.bytes, b_coder.bytes)
        none = np.zeros(0, np.int64)
        for batch in batches:
            for part in _batches(batch):
                bodies = part["_text"].tolist()
                rows = []
                for body, a, b in zip(bodies, a_coder.encode([" " + t for t in bodies]), b_coder.encode(bodies), strict=True):
                    found = aligner.align(b" " + body.encode(), a, b) if body else None
                    if found is None:
                        rows.append((0, 0, 0, 0, "", none, none))
                    else:
                        pairs, times = np.unique(found.links, return_counts=True)
                        rows.append((len(a), len(b), found.n_groups, len(found.links), found.groups, pairs, times))
                names = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
                out = pd.DataFrame(dict(zip(names, zip(*rows, strict=True), strict=True)))
                yield pd.concat([part[["_digest", "copies"]].reset_index(drop=True), out], axis=1)

    columns = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<int>"
    return distinct.mapInPandas(run, f"_digest binary, copies bigint, {columns}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``count`` over all documents, and ``best``: no pair of that B id counts more."""
    linked = aligned.select("copies", F.inline(F.arrays_zip("pairs", "times")))
    counts = settle(linked.groupBy(F.col("pairs").alias("pair")).agg(F.sum(F.col("times") * F.col("copies")).alias("count")), "pairs")
    of_b = F.shiftrightunsigned("pair", 32).alias("_b")
    most = counts.groupBy(of_b).agg(F.max("count").alias("_most"))
    return settle(counts.withColumn("_b", of_b).join(most, "_b").select("pair", "count", (F.col("count") == F.col("_most")).alias("best")), "pairs")


def aligned_documents(
    docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", most_sent: int = MOST_SENT
) -> DataFrame:
    """``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` per row.

    A link is an overlap of a token of A (space + text) with one of B (text); its count is how
    many links of the corpus join the same two ids. ``n_best``: links whose count is the
    highest of their B id; ``count_sum``: sum of the links' counts. NULL and empty texts, and
    texts that one side does not spell byte by byte, have no tokens: zeros and ''. Rows that
    repeat a key, or have none, are documents of their own.

    A text is worked on in one task, whatever the number of its copies: the shuffle by text
    counts copies before it moves them. Pairs are counted where they lie before they are
    shuffled. The counts, fewer than pairs of ids that overlap somewhere, go back to the texts
    in rounds of about ``most_sent``, so what is sent to a task never grows with the corpus.
    """
    body = F.coalesce(F.col(text), F.lit("")).alias("_text")
    distinct = docs.select(body).groupBy("_text").agg(F.count("*").alias("copies"))
    distinct = distinct.withColumn("_digest", texts.digest(F.col("_text")))
    done = alignments(distinct, a_path, b_path)
    done = done.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")
    folder = new_folder(docs.sparkSession, "aligned")
    done.write.option("compression", "zstd").parquet(folder)
    aligned = docs.sparkSession.read.schema(done.schema).parquet(folder)
    counts = pair_counts(aligned)
    linked = aligned.select("_digest", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    rounds = max(1, math.ceil(counts.count() / most_sent))
    sums = None
    for i in range(rounds):
        sent = counts.where(F.pmod(F.xxhash64("pair"), F.lit(rounds)) == i) if rounds > 1 else counts
        found = linked.join(F.broadcast(sent), "pair").groupBy("_digest").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
        found = settle(found, "sums")
        sums = found if sums is None else sums.unionByName(found)
    if rounds > 1:
        sums = sums.groupBy("_digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measures = aligned.drop("pairs", "times").join(sums, "_digest", "left").fillna(0, ["n_best", "count_sum"])
    found = texts.carried(texts.keyed(docs, key, text), settle(measures, "measures"))
    return found.select(F.col("_key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
