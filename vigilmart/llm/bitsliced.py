"""Ranked lexical search with bit-sliced Bloom signatures.

Documents of about the same size form blocks. A block's signature is a Bloom filter turned on
its side: one row of bits per slot, one bit per document, so the rows of a term's slots, and-ed,
mark every document that may hold the term (and some that don't). A term that occurs more often
is entered again for each step of ``STEPS`` it reaches, which bounds its frequency from above.
The weighted sums of these marks bound each document's score; with the exact scores of the
documents of the highest bounds as a threshold, every document that is not provably outside the
best is scored again from its text. False marks cost time, never a result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilmart.llm import texts
from vigilmart.sources.workspace import settle

TOP = 20
STEPS = (1, 2, 3, 4, 6, 9, 14, 22, 36, 64, 128, 512)
BITS_PER_ENTRY = 10
PROBES = 5
BLOCK = 512
SPREAD = 1.25
MOST_ITEMS = 2048  # items that one pass over the signatures answers
MOST_SENT = 500_000  # texts' digests that are sent to all tasks
_HELD = 4 * BLOCK

# A-Z become lower case; of ASCII only letters and digits are part of a term.
_FOLDED = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    """Terms in the order of the text, as UTF-8."""
    return [t for t in (text or "").encode().translate(_FOLDED).split(b" ") if t]


def hashed(found: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64)


def slots(keys: np.ndarray, step: int, size: int) -> np.ndarray:
    """The ``PROBES`` slots of each key at a step of ``STEPS``: shape (keys, PROBES)."""
    with np.errstate(over="ignore"):
        x = (keys + np.uint64(step)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * high[:, None]) % np.uint64(size)).astype(np.int64)


def signature(entries: list[list[np.ndarray]], size: int) -> np.ndarray:
    """Rows of bits, packed, for documents given as term hashes by step."""
    width = -(-len(entries) // 8) * 8
    bits = np.zeros((size, width), np.uint8)
    for place, by_step in enumerate(entries):
        for step, keys in enumerate(by_step):
            bits[slots(keys, step, size).ravel(), place] = 1
    return np.packbits(bits, axis=1)


def _blocks(held: list[tuple]) -> Iterator[dict]:
    """Blocks of documents of about one size; a document is digest, length, hashes by step."""
    held = sorted(held, key=lambda d: (sum(map(len, d[2])), d[0]))
    first = 0
    while first < len(held):
        least = sum(map(len, held[first][2]))
        last = first
        while last < len(held) and last - first < BLOCK and (most := sum(map(len, held[last][2]))) <= SPREAD * least + 16:
            size = most
            last += 1
        size = BITS_PER_ENTRY * size + 64
        block = held[first:last]
        rows = signature([d[2] for d in block], size)
        yield {"digests": [d[0] for d in block], "lengths": [d[1] for d in block], "size": size, "slices": rows.tobytes()}
        first = last


def _signed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    weight = 0
    for batch in batches:
        for of, text in zip(batch["_digest"], batch["_text"], strict=True):
            counts = Counter(terms(text))
            if not counts:
                continue
            times = np.fromiter(counts.values(), np.int64, len(counts))
            keys = hashed(counts)
            by_step = [keys[times >= step] for step in STEPS if step <= times.max()]
            held.append((of, int(times.sum()), by_step))
            weight += sum(map(len, by_step))
            if len(held) >= _HELD or weight >= 2_000_000:
                yield pd.DataFrame(list(_blocks(held)))
                held, weight = [], 0
    if held:
        yield pd.DataFrame(list(_blocks(held)))


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Blocks of documents with a term: ``digests`` and ``lengths`` in terms, ``size`` and ``slices``.

    A text may be in several blocks, once for each of its rows. A task holds ``_HELD`` texts'
    hashes at most, or one very long text and those before it.
    """
    source = docs.select(texts.digest(F.col(text)).alias("_digest"), F.col(text).alias("_text"))
    return source.mapInPandas(_signed, "digests array<binary>, lengths array<bigint>, size bigint, slices binary")


class Items:
    """Query items: terms with their repeats as rows of (item, term, repeats)."""

    def __init__(self, rows: list[tuple]):
        self.rows = rows
        counts = [Counter(terms(t)) for _, t in rows]
        self.words = sorted(set().union(*counts)) if counts else []
        place = {w: i for i, w in enumerate(self.words)}
        self.terms = [np.array([place[w] for w in c], np.int64) for c in counts]
        self.repeats = [np.fromiter(c.values(), np.int64, len(c)) for c in counts]

    def weigh(self, n_docs: int, df: np.ndarray) -> list[np.ndarray]:
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        return [weight[t] * r for t, r in zip(self.terms, self.repeats, strict=True)]


def saturation(times, m):
    """What an occurrence count is worth in a document of relative length ``m``, per unit of weight."""
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


class Bounds:
    """Upper bounds of the scores of all documents of a block, for all items."""

    def __init__(self, items: Items, weights: list[np.ndarray], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.keys = hashed(items.words)
        self.asked = [i for i, t in enumerate(items.terms) if len(t)]
        self.flat = np.concatenate([items.terms[i] for i in self.asked]) if self.asked else np.zeros(0, np.int64)
        self.weight = np.concatenate([weights[i] for i in self.asked]) if self.asked else np.zeros(0, np.int64)
        self.starts = np.cumsum([0, *[len(items.terms[i]) for i in self.asked]])[:-1]

    def of(self, lengths: np.ndarray, size: int, slices: bytes) -> np.ndarray:
        """Shape (asked items, documents), whole numbers."""
        rows = np.frombuffer(slices, np.uint8).reshape(size, -1)
        m = 75 + (25 * lengths * self.n_docs) // self.n_terms
        total = np.zeros((len(self.asked), len(lengths)), np.int64)
        below = np.zeros(len(lengths), np.int64)
        alive = np.arange(len(self.keys))
        for step in range(len(STEPS)):
            marks = np.bitwise_and.reduce(rows[slots(self.keys[alive], step, size)], axis=1)
            some = marks.any(axis=1)
            alive, marks = alive[some], marks[some]
            if not len(alive):
                break
            # The highest frequency below the next step; beyond the last there is no limit but 10^6.
            most = saturation(STEPS[step + 1] - 1, m) if step + 1 < len(STEPS) else np.full(len(lengths), 1_000_000)
            row_of = np.full(len(self.keys), -1)
            row_of[alive] = np.arange(len(alive))
            at = row_of[self.flat]
            used = at >= 0
            if used.any():
                bits = np.unpackbits(marks, axis=1, count=len(lengths)).astype(np.int64)
                weighted = bits[at[used]] * self.weight[used, None]
                owner = np.searchsorted(self.starts, np.flatnonzero(used), "right") - 1
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                total[owner[first]] += np.add.reduceat(weighted, first, axis=0) * (most - below)
            below = most
        return total


def _highest(bounds: Bounds, top: int):
    """For each item the ``top`` texts of the highest bounds in the task."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [(np.zeros(0, np.int64), np.zeros(0, object)) for _ in bounds.asked]
        for batch in batches:
            for row in batch.itertuples():
                found = bounds.of(np.asarray(row.lengths, np.int64), row.size_, row.slices)
                digests = np.array([bytes(d) for d in row.digests], object)
                for i, values in enumerate(found):
                    held, names = best[i]
                    floor = held.min() if len(held) >= top else 0
                    new = np.flatnonzero(values > floor)
                    if len(new):
                        held, names = np.concatenate([held, values[new]]), np.concatenate([names, digests[new]])
                        keep = np.argsort(-held, kind="stable")[:top]
                        best[i] = held[keep], names[keep]
        for i, (held, names) in zip(bounds.asked, best, strict=True):
            if len(held):
                yield pd.DataFrame({"_item": i, "_digest": names, "_bound": held})

    return run


def _possible(bounds: Bounds, floor: np.ndarray):
    """Pairs of item and text whose bound reaches the item's threshold."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = floor[bounds.asked][:, None]
        for batch in batches:
            for row in batch.itertuples():
                item, place = np.nonzero(bounds.of(np.asarray(row.lengths, np.int64), row.size_, row.slices) >= least)
                if len(item):
                    digests = np.array([bytes(d) for d in row.digests], object)
                    yield pd.DataFrame({"_item": np.array(bounds.asked)[item], "_digest": digests[place]})

    return run


def _scored(items: Items, weights: list[np.ndarray], n_docs: int, n_terms: int):
    """Exact scores of a text for its items."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {w: i for i, w in enumerate(items.words)}
        for batch in batches:
            out = []
            for of, text, asked in zip(batch["_digest"], batch["_text"], batch["_items"], strict=True):
                found = terms(text)
                times = np.zeros(len(items.words), np.int64)
                for word, n in Counter(w for w in found if w in place).items():
                    times[place[word]] = n
                m = 75 + (25 * len(found) * n_docs) // n_terms
                worth = saturation(times, m)
                out += [(i, of, int((weights[i] * worth[items.terms[i]]).sum())) for i in asked]
            yield pd.DataFrame(out, columns=["_item", "_digest", "_score"])

    return run


def _exact(source: DataFrame, pairs: DataFrame, scored) -> DataFrame:
    """``_item``, ``_digest``, ``_score`` of pairs, from one row of each text."""
    asked = settle(pairs.groupBy("_digest").agg(F.collect_set("_item").alias("_items")), "asked")
    if asked.count() <= MOST_SENT:
        found = source.join(F.broadcast(asked.select("_digest")), "_digest", "left_semi").groupBy("_digest").agg(F.first("_text").alias("_text"))
    else:  # one row of every text first, so that copies of one text never meet in a task
        found = source.groupBy("_digest").agg(F.first("_text").alias("_text"))
    return settle(found.join(asked, "_digest").mapInPandas(scored, "_item int, _digest binary, _score bigint"), "scores").where("_score > 0")


def statistics(docs: DataFrame, signed: DataFrame, words: list[bytes], text: str = "text") -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and for each of ``words`` the documents that hold it."""
    size = signed.select(F.inline(F.arrays_zip("lengths"))).agg(F.count("*"), F.sum("lengths")).first()

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, found = set(words), Counter()
        for batch in batches:
            for t in batch["_text"]:
                found.update(asked.intersection(terms(t)))
        yield pd.DataFrame({"_word": list(found.keys()), "_n": list(found.values())})

    counted = docs.select(F.col(text).alias("_text")).mapInPandas(run, "_word binary, _n bigint")
    df = {bytes(r["_word"]): r["_n"] for r in counted.groupBy("_word").agg(F.sum("_n").alias("_n")).collect()}
    return size[0], size[1] or 0, np.array([df.get(w, 0) for w in words], np.int64)


def ranked(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text", top: int = TOP
) -> DataFrame:
    """``item``, ``rank``, ``key`` and ``score`` of each item's ``top`` best documents.

    Scores are whole numbers as ``Items.weigh`` and ``saturation`` define them; documents of
    equal score come by ascending key, those without a key last, and rows that repeat a key
    count each. NULL, empty and term-less texts are in no ranking and not counted; items
    without terms have no rows; rows that repeat item and text are one item.

    The items are the stated query set: they are answered in passes of ``MOST_ITEMS``, and only
    a pass's items (by hash, so about that many), their terms' counts and their thresholds are
    known to all tasks.
    """
    spark = docs.sparkSession
    source = docs.select(texts.digest(F.col(text)).alias("_digest"), F.col(text).alias("_text"))
    ids = settle(texts.keyed(docs, key, text), "keys")
    signed = settle(signatures(docs, text), "signatures").withColumnRenamed("size", "size_")
    asked = items.select(F.col(item).alias("_id"), F.col(query).alias("_query")).distinct()
    passes = max(1, math.ceil(asked.count() / MOST_ITEMS))
    out = None
    for i in range(passes):
        part = asked.where(F.pmod(F.xxhash64("_id", "_query"), F.lit(passes)) == i)
        rows = sorted(part.collect(), key=lambda r: (r["_id"] is None, r["_id"], r["_query"] or ""))
        found = _answered(docs, source, ids, signed, Items([tuple(r) for r in rows]), text, top)
        names = spark.createDataFrame([(k, r["_id"]) for k, r in enumerate(rows)], f"_item int, `{item}` {items.schema[item].dataType.simpleString()}")
        found = found.join(F.broadcast(names), "_item").select(item, "rank", F.col("_key").alias(key), "score")
        out = found if out is None else out.unionByName(found)
    return out


def _answered(docs: DataFrame, source: DataFrame, ids: DataFrame, signed: DataFrame, items: Items, text: str, top: int) -> DataFrame:
    n_docs, n_terms, df = statistics(docs, signed, items.words, text)
    weights = items.weigh(n_docs, df)
    bounds = Bounds(items, weights, n_docs, max(n_terms, 1))
    scored = _scored(items, weights, n_docs, max(n_terms, 1))
    by_item = Window.partitionBy("_item")
    seeds = signed.mapInPandas(_highest(bounds, top), "_item int, _digest binary, _bound bigint")
    seeds = seeds.withColumn("_place", F.row_number().over(by_item.orderBy(F.desc("_bound"), "_digest"))).where(F.col("_place") <= top)
    seeds = settle(seeds.select("_item", "_digest"), "seeds")
    # Each row of the signatures is a document, so a text counts as often as it is a seed.
    known = seeds.join(_exact(source, seeds, scored), ["_item", "_digest"])
    floor = np.ones(len(items.rows), np.int64)
    for row in known.groupBy("_item").agg(F.count("*").alias("n"), F.min("_score").alias("least")).where(F.col("n") >= top).collect():
        floor[row["_item"]] = row["least"]
    pairs = settle(signed.mapInPandas(_possible(bounds, floor), "_item int, _digest binary").distinct(), "possible")
    scores = _exact(source, pairs, scored)
    # No text can fill more than all places, so its first keys are enough.
    first = Window.partitionBy("_digest").orderBy(F.col("_key").asc_nulls_last())
    holders = ids.join(scores.select("_digest").distinct(), "_digest", "left_semi")
    holders = holders.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= top).drop("_place")
    places = F.row_number().over(by_item.orderBy(F.desc("_score"), F.col("_key").asc_nulls_last()))
    best = scores.join(holders, "_digest").withColumn("rank", places).where(F.col("rank") <= top)
    return best.select("_item", "rank", "_key", F.col("_score").alias("score"))
