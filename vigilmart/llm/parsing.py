"""Document fingerprints by locally consistent parsing.

A text is a row of symbols, at first its code points. A level groups the symbols into phrases
of one to about eight symbols and names each phrase by a hash of its symbols. Where phrases
begin depends on a few symbols around alone, so equal passages are cut alike wherever they
stand, but for their edges:

- a run of one symbol is first named as a symbol and a count;
- deterministic coin tossing replaces each symbol by twice the lowest bit in which it differs
  from the one before, plus that bit; after four rounds the labels are below six and
  neighbours still differ;
- phrases begin at local maxima of the labels.

The fingerprint is a MinHash over the names of all levels but the lowest, where each name
stands for the stretch of text under it: long phrases enter more often than short ones, and a
phrase that recurs enters as often as it does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 128
DIGITS = 4  # hex digits of a slot
ROUNDS = 4
FIRST_LEVEL = 2
_PIECE = 1 << 16  # code points that are parsed together
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_OWNER = np.uint64(52)  # bits of a name's hash beside the number of its text
_MOST_TEXTS = 1 << 12
_STEPS = _M1 * np.arange(64, dtype=np.uint64)
_SEEDS = np.random.default_rng(7).integers(1, 2**63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _fold(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One name per phrase: an order-dependent hash of the values from each start to the next."""
    place = np.arange(len(values), dtype=np.uint64) - np.repeat(starts, np.diff(np.append(starts, len(values)))).astype(np.uint64)
    return _mix(np.add.reduceat(_mix(values + (place + np.uint64(1)) * _M1), starts) + _M2)


def level(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, owners (the text each belongs to) and starts of the next level's phrases."""
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    runs = np.flatnonzero(fresh)
    counts = np.diff(np.append(runs, len(names))).astype(np.uint64)
    symbols = _mix(names[runs] ^ (counts * _M1))
    of = owner[runs]
    opening = np.ones(len(runs), bool)
    opening[1:] = of[1:] != of[:-1]
    labels = symbols
    for _ in range(ROUNDS):
        one = labels.dtype.type(1)
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[opening] = ~labels[opening]
        differing = labels ^ before
        bit = np.bitwise_count((differing & (~differing + one)) - one)
        labels = ((bit << 1) | ((labels >> bit.astype(labels.dtype)) & one).astype(np.uint8)).astype(np.uint8)
    start = opening.copy()
    if len(labels) > 2:
        peak = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
        start[1:-1] |= peak & ~opening[2:]
    starts = np.flatnonzero(start)
    return _fold(symbols, starts), of[starts], runs[starts]


def _parsed(points: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Names, owners and lengths in code points, level by level; a text ends as one phrase."""
    names, lengths, depth = points.astype(np.uint64), np.ones(len(points), np.int64), 0
    while len(names):
        names, owner, starts = level(names, owner)
        lengths = np.add.reduceat(lengths, starts)
        depth += 1
        edge = np.ones(len(owner) + 1, bool)
        edge[1:-1] = owner[1:] != owner[:-1]
        alone = edge[:-1] & edge[1:]
        shown = alone if depth < FIRST_LEVEL else np.ones(len(names), bool)
        yield names[shown], owner[shown], lengths[shown]
        names, owner, lengths = names[~alone], owner[~alone], lengths[~alone]


def sketches(texts: list[str]) -> np.ndarray:
    """SLOTS minima of 16 bits for each text; none of the texts is empty."""
    out = np.full((len(texts), SLOTS), np.iinfo(np.uint64).max, np.uint64)
    first = 0
    while first < len(texts):
        last, size = first + 1, len(texts[first])
        while last < len(texts) and size + len(texts[last]) <= _PIECE and last - first < _MOST_TEXTS:
            size += len(texts[last])
            last += 1
        part = texts[first:last]
        joined = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(part)), [len(t) for t in part])
        values, whose = [], []
        for names, of, lengths in _parsed(joined, owner):
            # A phrase of 2^k code points and more enters k - 1 times, under as many names.
            values.append(names)
            whose.append(of)
            for k in range(3, int(lengths.max(initial=0)).bit_length()):
                long = lengths >> k > 0
                values.append(names[long] ^ _STEPS[k])
                whose.append(of[long])
        # Sorted by text and name; a name's second and later occurrences are names of their own.
        held = (np.concatenate(whose).astype(np.uint64) << _OWNER) | (_mix(np.concatenate(values)) >> (np.uint64(64) - _OWNER))
        held.sort()
        at = np.arange(len(held))
        fresh = np.ones(len(held), bool)
        fresh[1:] = held[1:] != held[:-1]
        nth = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
        drawn = _mix((held << (np.uint64(64) - _OWNER)) + nth * _M1)
        starts = np.searchsorted(held >> _OWNER, np.arange(len(part), dtype=np.uint64))
        for i in range(SLOTS):
            out[first:last, i] = np.minimum.reduceat(drawn * _SEEDS[i], starts)
        first = last
    return _mix(out) >> np.uint64(64 - 4 * DIGITS)


def fingerprints(texts: list[str | None]) -> list[str]:
    """A hex string per text, SLOTS times DIGITS long; empty for NULL and empty texts."""
    full = [i for i, t in enumerate(texts) if t]
    out = [""] * len(texts)
    for i, row in zip(full, sketches([texts[i] for i in full]), strict=True):
        out[i] = row.astype(">u2").tobytes().hex()
    return out


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the text under common names, 0 to 1; 1 for two empty texts.

    The share of equal slots estimates the common names over all names of both texts; twice
    the common over the sum of both sides is 2 J / (1 + J).
    """
    places = F.sequence(F.lit(0), F.lit(SLOTS - 1))

    def slot(c: Column, i: Column) -> Column:
        return F.substr(c, i * DIGITS + 1, F.lit(DIGITS))

    equal = F.size(F.filter(places, lambda i: slot(a, i) == slot(b, i))) / SLOTS
    return (
        F.when((a == "") & (b == ""), F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .otherwise(2 * equal / (1 + equal))
    )


def _likeness(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    left, right = np.frombuffer(bytes.fromhex(a), ">u2"), np.frombuffer(bytes.fromhex(b), ">u2")
    equal = float((left == right).mean())
    return 2 * equal / (1 + equal)


def fingerprinted(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each row's whole text; equal texts have equal fingerprints."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(list(texts)), dtype=object)

    return docs.withColumn(name, of(F.col(text)))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of another text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


@dataclass
class _Row:
    key: int | None
    text: str
    halo: bool


def _against_next(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by stretch and falling key; a stretch ends with the next one's first row."""
    waiting: list[_Row] = []
    stretch = None
    last_print: str | None = None  # of waiting[0], where known

    def flush(final: bool) -> pd.DataFrame | None:
        """Finish all rows of the block whose next row is known."""
        nonlocal waiting, last_print
        if len(waiting) < 2:
            return None
        own, after = waiting[:-1], waiting[1:]
        changed = [edited(a.text, b.text) for a, b in zip(own, after, strict=True)]
        todo = [r.text for r in (waiting if last_print is None else waiting[1:])]
        prints = fingerprints(todo + changed)
        base = prints[: len(todo)] if last_print is None else [last_print, *prints[: len(todo)]]
        new = prints[len(todo) :]
        out = pd.DataFrame(
            {
                "_key": pd.array([r.key for r in own], dtype="Int64"),
                "n_chars": [len(r.text) for r in own],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
                "fingerprint": base[:-1],
                "edited_fingerprint": new,
                "near_edited": [_likeness(a, b) for a, b in zip(base[:-1], new, strict=True)],
                "near_next": [_likeness(a, b) for a, b in zip(base[:-1], base[1:], strict=True)],
            }
        )
        waiting, last_print = ([], None) if final else ([waiting[-1]], base[-1])
        return out

    for batch in batches:
        for at, key, text, halo in zip(batch["_stretch"], batch["_key"], batch["_text"], batch["_halo"], strict=True):
            if at != stretch:
                done = flush(True)
                if done is not None:
                    yield done
                waiting, last_print, stretch = [], None, at
            waiting.append(_Row(None if pd.isna(key) else int(key), text or "", bool(halo)))
            if sum(len(r.text) for r in waiting[-1:]) > _PIECE or len(waiting) >= 256:
                done = flush(False)
                if done is not None:
                    yield done
    done = flush(True)
    if done is not None:
        yield done


def against_next(docs: DataFrame, key: str = "doc_id", text: str = "text", rows_per_stretch: int = 4000) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next text, with likenesses.

    Next is by falling ``key``, then falling text, rows without a key last; after the last row
    comes the first. A table of one row follows itself. The keys are cut into stretches of
    about ``rows_per_stretch`` rows, the first row of a stretch is also given to the stretch
    before it, and each stretch is walked by one task: the texts move once and no task holds
    more than a stretch. NULL texts count as empty. Columns: ``key``, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    keys = rows.select("_key")
    total = keys.count()
    n = max(1, -(-total // rows_per_stretch))
    # The first key of each stretch, one number a stretch; stretch 0 has the smallest keys.
    known = keys.where("_key is not null")
    cuts = known.approxQuantile("_key", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    limits = np.unique(np.array(cuts, dtype=np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def stretch_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, keys.to_numpy(np.int64), "right").astype(np.int32))

    place = F.when(F.col("_key").isNull(), F.lit(-1)).otherwise(stretch_of(F.coalesce("_key", F.lit(0))))
    placed = rows.withColumn("_stretch", place)
    tops = placed.groupBy("_stretch").agg(F.max("_key").alias("_top"), F.count("*").alias("_rows"))
    order = {r["_stretch"]: r["_top"] for r in tops.collect()}
    if not order:
        return rows.limit(0).mapInPandas(_against_next, _columns()).withColumnRenamed("_key", key)
    falling = sorted(order, reverse=True)
    # The first row of each stretch goes to the stretch that comes before it, the very first to the last.
    target = {s: falling[i - 1] for i, s in enumerate(falling)}
    heads = placed.join(
        F.broadcast(docs.sparkSession.createDataFrame(
            [(s, order[s], t) for s, t in target.items()], "_stretch int, _top bigint, _to int"
        )),
        "_stretch",
    ).where(F.col("_key").eqNullSafe(F.col("_top")))
    heads = heads.groupBy("_to").agg(F.max(F.struct("_key", "_text")).alias("_row"))
    halos = heads.select(F.col("_row._key").alias("_key"), F.col("_row._text").alias("_text"), F.col("_to").alias("_stretch"), F.lit(True).alias("_halo"))
    walked = (
        placed.withColumn("_halo", F.lit(False))
        .unionByName(halos)
        .repartition("_stretch")
        .sortWithinPartitions("_stretch", "_halo", F.desc_nulls_last("_key"), F.desc("_text"))
    )
    return walked.mapInPandas(_against_next, _columns()).withColumnRenamed("_key", key)


def _columns() -> str:
    return (
        "_key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
