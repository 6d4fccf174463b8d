"""Byte-level BPE with content-defined chunk reuse.

A rolling hash over the code points cuts each text where its own content says so, hence
passages that texts share give the same chunks. Texts that share their lowest chunk hash are
brought to the same partition; there each different chunk is encoded once, for as long as it
is among the ``_CACHED_CHARS`` last used characters, and its ids serve all texts. What a cut
may have changed lies around it. The stretch from the second to last place in the chunk before
to the second place in the chunk after where a word ends before a space is encoded again. It
is taken only if its ids agree exactly with those of both chunks over the outer words; otherwise
it grows, in the end to the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilmart.llm.coding import PATTERN, ordinary, vocabulary

# Fixed value: the special token of the vocabulary.
SPECIAL = {"<|endoftext|>": 50256}

LEAST, MOST, CUT_BITS = 256, 8192, 10
_CACHED_CHARS = 8_000_000
_SPACES = re.compile("[ \n]")


def cuts(text: str) -> list[int]:
    """Ends of the chunks: between LEAST and MOST code points, where the rolling hash says so."""
    n = len(text)
    if n <= LEAST:
        return [n] if n else []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    rolled = points * np.uint32(0x9E3779B1)
    rolled ^= rolled >> np.uint32(15)
    for k in (1, 2, 4, 8):  # sums over 2, 4, 8, 16 code points
        step = rolled.copy()
        step[k:] += rolled[:-k] * np.uint32(2 * k + 1)
        rolled = step ^ (step >> np.uint32(13))
    found = (np.flatnonzero((rolled * np.uint32(0x85EBCA6B)) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    ends, last = [], 0
    for end in [*found, n]:
        while end - last > MOST:
            last += MOST
            ends.append(last)
        if end - last >= LEAST or (end == n and end > last):
            ends.append(end)
            last = end
    return ends


def chunks(text: str) -> list[str]:
    out, last = [], 0
    for end in cuts(text):
        out.append(text[last:end])
        last = end
    return out


def _solid(c: str) -> bool:
    return c.isprintable() and not c.isspace()


def _edges(chunk: str, backwards: bool = False) -> Iterator[int]:
    """Places where every encoding of a text holding the chunk has a token edge."""
    if backwards:
        at = len(chunk)
        while (at := max(chunk.rfind(" ", 0, at), chunk.rfind("\n", 0, at))) > 0:
            if _solid(chunk[at - 1]):
                yield at
    else:
        for m in _SPACES.finditer(chunk, 1):
            if _solid(chunk[m.start() - 1]):
                yield m.start()


class _Chunk:
    """Ids of a chunk, and its outer common edges as (place in the text, tokens before it).

    ``heads`` are the first two edges, ``tails`` the last two, from the outside in.
    """

    __slots__ = ("text", "ids", "heads", "tails")

    def __init__(self, text: str, ids: np.ndarray, heads: list[tuple[int, int]], tails: list[tuple[int, int]]):
        self.text, self.ids, self.heads, self.tails = text, ids, heads, tails

    def whole(self) -> bool:
        """Whether two edges from either side leave the middle untouched."""
        return len(self.heads) == 2 and len(self.tails) == 2 and self.heads[1][0] <= self.tails[1][0]


class Coder:
    """Encodes and decodes whole texts with a vocabulary; keeps the chunks it has encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, special: dict[str, int] | None = None):
        special = SPECIAL if special is None else special
        self.coding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.specials = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        size = max([*ranks.values(), *special.values()]) + 1
        self.bytes = [b""] * size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        for token, rank in special.items():
            self.bytes[rank] = token.encode()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.known: dict[str, _Chunk] = {}
        self.held = self.asked = self.encoded = self.grown = 0

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text without any reuse, special tokens as themselves."""
        parts = self.specials.split(text) if self.specials else [text]
        ids: list[int] = []
        for i, part in enumerate(parts):
            if i % 2:
                ids.append(self.special[part])
            elif part:
                ids += ordinary(self.coding, part)
        return np.array(ids, np.int32)

    def _chunk(self, text: str) -> _Chunk:
        self.asked += 1
        found = self.known.pop(text, None)
        if found is None:
            self.encoded += 1
            found = self._split(text)
            self.held += len(text)
        self.known[text] = found  # the last used come last
        while self.held > _CACHED_CHARS and len(self.known) > 1:
            oldest = next(iter(self.known))
            del self.known[oldest]
            self.held -= len(oldest)
        return found

    def _split(self, text: str) -> _Chunk:
        ids = self.plain(text)
        ends = np.cumsum(self.lengths[ids])

        def agreed(backwards: bool) -> Iterator[tuple[int, int]]:
            """Edges that are edges between two tokens of this encoding too."""
            for place in _edges(text, backwards):
                if backwards:
                    at = ends[-1] - len(text[place:].encode("utf-8", "surrogatepass"))
                else:
                    at = len(text[:place].encode("utf-8", "surrogatepass"))
                token = int(np.searchsorted(ends, at))
                if ends[token] == at:
                    yield place, token + 1

        return _Chunk(text, ids, list(islice(agreed(False), 2)), list(islice(agreed(True), 2)))

    def encode(self, text: str) -> np.ndarray:
        parts = [self._chunk(c) for c in chunks(text)]
        if len(parts) == 1:
            return parts[0].ids
        out: list[np.ndarray] = []
        pending, before = "", np.zeros(0, np.int32)  # text since the last taken edge, and the ids it must begin with
        for i, part in enumerate(parts):
            if not part.whole():  # too few edges: all of it joins the stretch
                pending += part.text
                continue
            (_, outer), (place, inner) = part.heads
            first = 0
            if i:
                joint, after = self.plain(pending + part.text[:place]), part.ids[outer:inner]
                if not _meets(joint, before, after):
                    pending += part.text
                    continue
                out.append(joint)
                first = inner
            (_, outer), (place, inner) = part.tails
            out.append(part.ids[first:inner])
            pending, before = part.text[place:], part.ids[inner:outer]
        if pending:
            joint = self.plain(pending)
            if not _meets(joint, before, joint[:0]):
                self.grown += 1
                return self.plain(text)
            out.append(joint)
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


def _meets(joint: np.ndarray, before: np.ndarray, after: np.ndarray) -> bool:
    """Whether a stretch begins and ends with the ids that its neighbours have there."""
    if len(joint) < len(before) + len(after):
        return False
    return np.array_equal(joint[: len(before)], before) and np.array_equal(joint[len(joint) - len(after) :], after)


def _gathered(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add the lowest chunk hash of each text."""
    for batch in batches:
        lowest = [
            min((xxhash.xxh3_64_intdigest(c.encode("utf-8", "surrogatepass")) for c in chunks(t or "")), default=0) >> 1
            for t in batch["_text"]
        ]
        yield batch.assign(_chunk=np.array(lowest, np.int64))


def coded(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and ``decoded``, the text that the ids decode to.

    ``vocabulary_path`` is a file of ranks on the driver; the vocabulary is bounded and goes
    to the workers with the function. Whole texts are encoded, special tokens in a text as
    themselves. NULL texts count as empty: no tokens. Rows that repeat a key stay repeated.
    """
    with open(vocabulary_path, encoding="ascii") as lines:
        ranks = docs.sparkSession.sparkContext.broadcast(vocabulary(lines))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(ranks.value)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                ids = [coder.encode(t or "") for t in part["_text"]]
                decoded = [coder.decode(found.tolist()) for found in ids]
                yield pd.DataFrame({"_key": part["_key"].array, "n_tokens": [len(found) for found in ids], "ids": ids, "decoded": decoded})

    source = docs.selectExpr(f"cast(`{key}` as bigint) AS _key", f"`{text}` AS _text")
    near = source.mapInPandas(_gathered, "_key bigint, _text string, _chunk bigint").hint("rebalance", "_chunk")
    return near.mapInPandas(run, "_key bigint, n_tokens bigint, ids array<int>, decoded string").withColumnRenamed("_key", key)


def digested(found: DataFrame) -> DataFrame:
    """Rows of ``coded`` with ``ids_sha256`` (of decimal ids joined by commas) and ``decoded_sha256`` instead of ``decoded``."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.withColumn("ids_sha256", F.sha2(listed, 256)).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")
