"""Near-duplicate texts: banded MinHash, odd sketches, and a check on full sets.

1. One pass over the texts gives each its set of word shingles as 64-bit hashes, the set's
   digest, 256 MinHash samples, 32 band values of four samples each, and the odd sketch: a
   1024-bit map in which every sample flips one bit. Two sketches differ in about
   512 (1 - exp(-m / 512)) bits where m samples lie in one of the two sets of samples only.
2. Texts with equal sets form a class, by a grouping; only classes are compared.
3. Classes that share a band value meet. No bucket is expanded into all pairs: members meet
   the bucket's smallest member where their sketches differ in no more bits than two sets at
   the threshold would (4 standard deviations), and are confirmed on the full sets. What is
   linked is joined to components. Only members outside a bucket's largest component then look
   for the others of the bucket: in blocks, by the hashes of their shingles themselves (of
   large sets a sample), and what may be alike is again confirmed on the full sets.

A pair at similarity 0.8 shares none of the 32 bands with probability 5e-8.
The samples of the last round fall short of SLACK for at most 2e-8 of such pairs of sets of
over 512 shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilmart.llm import graph
from vigilmart.sources.workspace import settle

SAMPLES, BANDS, ROWS = 256, 32, 4
SKETCH_BITS = 1024
_LANES = SKETCH_BITS // 64
SIMILARITY = 80  # per cent
MOST_FLIPPED = 140  # of sketch bits, for a pair that may reach SIMILARITY
SAMPLE_BITS = 9  # sets of up to 2^9 shingles are compared whole in the last round
SLACK = 6.0
_LOWEST = -(2**63)
BLOCK = 2048
_PIECE = 1 << 15  # shingles hashed at once, so they stay in the cache
_seeds = np.random.default_rng(20240229)
_FACTORS = _seeds.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _seeds.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


class Shingler:
    """Word shingles of texts as sorted arrays of different 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > 500_000:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter((known[w] for w in words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            mixed = (mixed ^ codes[k : len(words) - width + 1 + k]) * _A
            mixed ^= mixed >> np.uint64(29)
            mixed = mixed * _B + _C
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SAMPLES minima per set; none of the sets is empty."""
    out = np.empty((len(sets), SAMPLES), np.uint64)
    first = 0
    while first < len(sets):
        last, size = first + 1, len(sets[first])
        while last < len(sets) and size + len(sets[last]) <= _PIECE:
            size += len(sets[last])
            last += 1
        joined = np.concatenate(sets[first:last])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[first : last - 1]])]).astype(np.intp)
        best = np.full((last - first, SAMPLES), np.iinfo(np.uint64).max, np.uint64)
        if last - first == 1:  # a large set, in pieces
            for at in range(0, len(joined), _PIECE):
                piece = joined[at : at + _PIECE]
                for i in range(SAMPLES):
                    best[0, i] = min(best[0, i], (piece * _FACTORS[i]).min())
        else:
            hashed = np.empty_like(joined)
            for i in range(SAMPLES):
                np.multiply(joined, _FACTORS[i], out=hashed)
                best[:, i] = np.minimum.reduceat(hashed, starts)
        out[first:last] = best
        first = last
    return out


def band_values(samples: np.ndarray) -> np.ndarray:
    """BANDS hashes per row of samples; equal values mean an equal band at the same place."""
    parts = samples[:, : BANDS * ROWS].reshape(len(samples), BANDS, ROWS)
    mixed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]) * _C
    for k in range(ROWS):
        mixed = (mixed ^ parts[:, :, k]) * _A
        mixed ^= mixed >> np.uint64(31)
        mixed = mixed * _B
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Fold samples into parity bitmaps of SKETCH_BITS, as 64-bit lanes."""
    bit = ((samples ^ (samples >> np.uint64(33))) * _PLACES) >> np.uint64(54)
    lanes = np.zeros((len(samples), _LANES), np.uint64)
    one = np.uint64(1) << (bit & np.uint64(63))
    row = np.broadcast_to(np.arange(len(samples))[:, None], bit.shape)
    np.bitwise_xor.at(lanes, (row.ravel(), (bit >> np.uint64(6)).astype(np.intp).ravel()), one.ravel())
    return lanes.view(np.int64)


def _signed(width: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(width)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                sets = [shingles(t) for t in part["_text"]]
                full = [i for i, s in enumerate(sets) if len(s)]
                samples = minhashes([sets[i] for i in full])
                bands, lanes = band_values(samples), odd_sketches(samples)
                band_of: list = [None] * len(sets)
                lane_of: list = [None] * len(sets)
                for k, i in enumerate(full):
                    band_of[i], lane_of[i] = bands[k], lanes[k]
                yield pd.DataFrame(
                    {
                        "_id": part["_id"].array,
                        "_row": part["_row"].array,
                        "_n": [len(s) for s in sets],
                        "_digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                        "_bands": band_of,
                        "_sketch": lane_of,
                    }
                )

    return run


def _confirmed(width: int, similarity: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(width)
        last: tuple = (None, None)
        for batch in batches:
            kept = []
            for a, b, left, right in zip(batch["a"], batch["b"], batch["_left"], batch["_right"], strict=True):
                if last[0] != b:
                    last = (b, shingles(right))
                one, other = shingles(left), last[1]
                common = len(np.intersect1d(one, other, assume_unique=True))
                kept.append(100 * common >= similarity * (len(one) + len(other) - common) and common > 0)
            yield batch.loc[kept, ["a", "b"]]

    return run


def _alike(left: str, right: str, similarity: int) -> Column:
    """Sizes and sketches of the two sides allow the similarity."""
    flipped = sum(
        (F.bit_count(F.col(f"{left}_sketch")[i].bitwiseXOR(F.col(f"{right}_sketch")[i])) for i in range(1, _LANES)),
        F.bit_count(F.col(f"{left}_sketch")[0].bitwiseXOR(F.col(f"{right}_sketch")[0])),
    )
    small, large = (f(F.col(f"{left}_n"), F.col(f"{right}_n")) for f in (F.least, F.greatest))
    return (100 * small >= similarity * large) & (flipped <= MOST_FLIPPED)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, similarity: int = SIMILARITY
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    Texts are linked where 100 * common >= ``similarity`` * united shingles of ``width`` words
    (a shorter text is one shingle); ``similarity`` is 80 or more. Component: the smallest key
    reachable by links. NULL and empty texts have no shingle and link with nothing. Rows that repeat
    a key are one document and stay together, whatever their texts. Rows without a key are kept, linked with
    nothing and have no component.
    """
    columns = "_id bigint, _row bigint, _n bigint, _digest binary, _bands array<bigint>, _sketch array<bigint>"
    source = docs.select(F.col(key).cast("bigint").alias("_id"), F.col(text).alias("_text")).withColumn("_row", F.xxhash64("_text"))
    signed = settle(source.mapInPandas(_signed(width), columns), "signed")
    known = signed.where("_id is not null and _digest is not null")
    classes = known.groupBy("_digest").agg(
        F.min(F.struct("_id", "_row")).alias("_of"), F.first("_n").alias("_n"), F.first("_bands").alias("_bands"), F.first("_sketch").alias("_sketch")
    )
    classes = classes.select("_digest", "_of.*", "_n", "_bands", "_sketch", _node(F.col("_of._id"), F.col("_digest")).alias("_node"))
    classes = settle(classes, "classes")
    cards = classes.select("_node", "_n", "_sketch")
    members = classes.select("_node", F.explode("_bands").alias("_bucket"))
    leaders = members.groupBy("_bucket").agg(F.min("_node").alias("_leader"), F.count("*").alias("_size"))
    crowded = settle(members.join(leaders.where("_size > 1"), "_bucket"), "crowded")
    met = crowded.where("_node <> _leader").select(F.col("_node").alias("a"), F.col("_leader").alias("b"))
    met = settle(_sketched(met.distinct(), cards, similarity), "alike")
    # Whatever shares a bucket may have to be confirmed: a text of each such class is written once.
    chosen = classes.select("_node", "_id", "_row").join(crowded.select("_node").distinct(), "_node", "left_semi")
    texts = source.join(chosen, ["_id", "_row"]).groupBy("_id", "_row")
    texts = settle(texts.agg(F.min("_node").alias("_node"), F.min("_text").alias("_text")).select("_node", "_text"), "texts")
    # Each member first tries the leader whose sketch is nearest, then the others.
    nearest = met.groupBy("a").agg(F.min_by("b", F.struct("_flipped", "b")).alias("b"))
    links = _links(nearest, texts, width, similarity).unionByName(_repeated(known, classes))
    comps = graph.components(links)
    links = links.unionByName(_links(_apart(met.select("a", "b"), comps), texts, width, similarity))
    comps = graph.components(links)
    links = links.unionByName(_links(_unmet(crowded, texts, comps, width, similarity), texts, width, similarity))
    comps = graph.components(links)
    of_class = classes.join(comps, F.col("_node") == F.col("node"), "left").select(
        "_digest", _least_id(F.coalesce("component", "_node")).alias("_component")
    )
    rows = signed.select("_id", "_n", "_digest").join(of_class, "_digest", "left")
    # A row without shingles stands with the rows that repeat its key.
    bare = signed.where("_id is not null and _digest is null").select("_id").distinct()
    of_bare = (
        known.select("_id", "_digest").join(bare, "_id", "left_semi").join(of_class, "_digest").groupBy("_id").agg(F.min("_component").alias("_beside"))
    )
    rows = rows.join(of_bare, "_id", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_component", "_beside", "_id"))
    return rows.select(
        F.col("_id").alias(key),
        F.col("_n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"),
    )


def _node(least: Column, digest: Column) -> Column:
    """A class by its smallest key and its digest, in the order of the keys."""
    return F.concat(F.unhex(F.lpad(F.hex(least.bitwiseXOR(F.lit(_LOWEST))), 16, "0")), digest)


def _least_id(node: Column) -> Column:
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("bigint").bitwiseXOR(F.lit(_LOWEST))


def _repeated(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that share a key."""
    several = known.groupBy("_id").agg(F.min(F.hex("_digest")).alias("_first"), F.max(F.hex("_digest")).alias("_last"))
    several = several.where("_first <> _last").select("_id", F.unhex("_first").alias("_first"))
    pairs = known.select("_id", "_digest").join(several, "_id").where("_digest <> _first").select("_digest", "_first").distinct()
    a, b = (classes.select(F.col("_digest").alias(d), F.col("_node").alias(n)) for d, n in (("_digest", "a"), ("_first", "b")))
    return settle(pairs.join(a, "_digest").join(b, "_first").select("a", "b"), "links")


def _sketched(pairs: DataFrame, cards: DataFrame, similarity: int) -> DataFrame:
    """Pairs that sizes and sketches let through, with the number of differing bits."""

    def side(name: str) -> DataFrame:
        return cards.select(F.col("_node").alias(name), F.col("_n").alias(f"{name}_n"), F.col("_sketch").alias(f"{name}_sketch"))

    flipped = sum(F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(_LANES))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(_alike("a", "b", similarity))
        .select("a", "b", flipped.alias("_flipped"))
    )


def _links(pairs: DataFrame, texts: DataFrame, width: int, similarity: int) -> DataFrame:
    """The pairs that hold on the full sets."""
    sided = (
        pairs.join(texts.select(F.col("_node").alias("a"), F.col("_text").alias("_left")), "a")
        .join(texts.select(F.col("_node").alias("b"), F.col("_text").alias("_right")), "b")
        .select("a", "b", "_left", "_right")
    )
    return settle(sided.mapInPandas(_confirmed(width, similarity), "a binary, b binary"), "links")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends aren't in one component yet."""
    of_a = comps.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    of_b = comps.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    apart = F.coalesce("_ca", "a") != F.coalesce("_cb", "b")
    return pairs.join(of_a, "a", "left").join(of_b, "b", "left").where(apart).select("a", "b")


def _samples(width: int):
    """Sorted 32-bit hashes of a text's shingles; of large sets those below a limit.

    The limit halves as the size doubles, so some hundreds of hashes stand for any set, and
    two sets are compared by what both have below the lower of their limits.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(width)
        for batch in batches:
            held, limits, sizes = [], [], []
            for text in batch["_text"]:
                found = shingles(text)
                limit = 32 - max(0, (len(found) - 1).bit_length() - SAMPLE_BITS)
                short = found >> np.uint64(32)
                held.append(np.unique(short[short < np.uint64(1 << limit)]).astype(np.uint32).tobytes())
                limits.append(limit)
                sizes.append(len(found))
            yield pd.DataFrame({"_node": batch["_node"].array, "_held": held, "_limit": limits, "_n": sizes})

    return run


def _outsiders(similarity: int):
    """Pairs of one bucket that lie in two components and may reach the similarity.

    Rows come sorted by bucket and block; those of side 0 look for the others. Sampled sets
    that fall short by over ``SLACK`` standard deviations are dropped; whole sets must reach it.
    """
    least = similarity / 100

    def pairs(block: pd.DataFrame) -> Iterator[tuple[int, int]]:
        side = block["_side"].to_numpy()
        nodes, comps = block["_node"].to_numpy(), pd.factorize(block["_component"])[0]
        limits, sizes = block["_limit"].to_numpy(), block["_n"].to_numpy()
        held = [np.frombuffer(h, np.uint32) for h in block["_held"]]
        lookers, others = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(lookers) or not len(others):
            return
        tokens = np.concatenate([held[i] for i in others])
        place = np.repeat(np.arange(len(others)), [len(held[i]) for i in others])
        order = np.argsort(tokens, kind="stable")
        tokens, place = tokens[order], place[order]
        for i in lookers:
            fits = (comps[others] != comps[i]) & (100 * np.minimum(sizes[others], sizes[i]) >= similarity * np.maximum(sizes[others], sizes[i]))
            if not fits.any():
                continue
            own = held[i]
            first, last = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            spans = [place[f:t] for f, t in zip(first, last, strict=True)]
            for limit in np.unique(limits[others[fits]]):
                lower = min(int(limit), int(limits[i]))
                n_own = int(np.searchsorted(own, np.uint64(1 << lower)))
                same = fits & (limits[others] == limit)
                common = np.bincount(np.concatenate(spans[:n_own] or [place[:0]]), minlength=len(others))[same]
                theirs = np.array([np.searchsorted(held[o], np.uint64(1 << lower)) for o in others[same]])
                union = np.maximum(n_own + theirs - common, 1)
                slack = SLACK * np.sqrt(least * (1 - least) / union) if lower < 32 else 0.0
                for o in others[same][common / union >= least - slack]:
                    yield max(nodes[i], nodes[o]), min(nodes[i], nodes[o])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            edges = np.flatnonzero((rows[["_bucket", "_i", "_j"]].diff().fillna(1) != 0).any(axis=1).to_numpy())
            found = [p for f, t in zip(edges[:-1], edges[1:], strict=True) for p in pairs(rows.iloc[f:t])]
            yield pd.DataFrame(found, columns=["a", "b"], dtype=object)
            rest = rows.iloc[edges[-1] :] if len(edges) else None
        if rest is not None:
            yield pd.DataFrame(list(pairs(rest)), columns=["a", "b"], dtype=object)

    return run


def _unmet(crowded: DataFrame, texts: DataFrame, comps: DataFrame, width: int, similarity: int) -> DataFrame:
    """All pairs within a bucket that two components still separate and that may be alike.

    Only members outside a bucket's largest component look for the others, block by block, so
    a bucket whose members are nearly all linked costs its few outsiders times its size.
    """
    placed = crowded.join(comps.withColumnRenamed("node", "_node"), "_node", "left").select(
        "_bucket", "_node", F.coalesce("component", "_node").alias("_component")
    )
    counted = placed.groupBy("_bucket", "_component").agg(F.count("*").alias("_size"))
    split = (
        counted.groupBy("_bucket")
        .agg(
            F.count("*").alias("_parts"),
            F.max(F.struct("_size", "_component")).alias("_largest"),
            F.sum("_size").alias("_all"),
        )
        .where("_parts > 1")
        .select(
            "_bucket",
            F.col("_largest._component").alias("_main"),
            F.ceil(F.col("_all") / BLOCK).cast("int").alias("_blocks"),
            F.ceil((F.col("_all") - F.col("_largest._size")) / BLOCK).cast("int").alias("_rows"),
        )
    )
    placed = settle(placed.join(split, "_bucket"), "open")
    nodes = placed.select("_node").distinct()
    cards = texts.join(nodes, "_node", "left_semi").mapInPandas(
        _samples(width), "_node binary, _held binary, _limit int, _n bigint"
    )
    cards = settle(cards, "samples")
    own = F.pmod(F.xxhash64("_node"), "_rows").cast("int")
    looking = placed.where("_component <> _main").select(
        "_bucket", "_node", "_component", F.lit(0).alias("_side"), own.alias("_i"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_j")
    )
    there = placed.select(
        "_bucket",
        "_node",
        "_component",
        F.lit(1).alias("_side"),
        F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("_i"),
        F.pmod(F.xxhash64("_node"), "_blocks").cast("int").alias("_j"),
    )
    return (
        looking.unionByName(there)
        .join(cards, "_node")
        .repartition("_bucket", "_i", "_j")
        .sortWithinPartitions("_bucket", "_i", "_j")
        .mapInPandas(_outsiders(similarity), "a binary, b binary")
        .distinct()
    )
