"""Repeated substrings by common-prefix interval trees over enhanced suffix arrays.

A window is a string of ``LENGTH`` bytes. The least hash among a window's grams depends on the
window alone, so equal windows, wherever they lie, have the same least hash: their anchor.
Each text is cut into runs of neighbouring windows with one anchor; a run's content is all the
bytes of its windows. Runs are grouped by anchor in a shuffle, equal contents counted before
they move. Then, by the number of different contents of an anchor:

* one content that occurs more than once: all its windows repeat;
* some, or one whose anchor occurs again inside it: their suffixes are sorted, common prefixes
  measured, and a stack scan of these builds the tree of common-prefix intervals. Intervals
  that are left diverse (their suffixes are preceded by different bytes, or start a content)
  are the maximal repeats;
* more than ``MOST_CONTENTS``: the contents are texts of their own, cut anew with longer grams,
  hence into shorter runs that share more; with grams of a whole window a run is one window.

So a passage that a third of all texts hold is compared by one task at most where contents are
few, whatever stands around it. A repeat longer than a content comes out as overlapping groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilmart.llm import texts
from vigilmart.sources.workspace import settle

LENGTH = 400
MOST_CONTENTS = 256
_BATCH = 400_000

_BYTE_HASHES = np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64)


def _grams(length: int) -> list[int]:
    """Lengths of the grams of each level: short ones, most of a window, a whole window."""
    short = min(16, length)
    return sorted({short, max(short, length - 32), length})


def _over_powers(values: np.ndarray, width: int, join) -> np.ndarray:
    """``join`` of the values at each ``width`` neighbouring places, by doubling."""
    step = 1
    while 2 * step <= width:
        values = join(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return join(values[:-rest], values[rest:]) if rest else values


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def runs(data: np.ndarray, ends: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor, and whether it occurs again inside, of each run.

    ``data`` holds several stretches, which end at ``ends``; no window crosses an end. A run
    has no more windows than a window has grams.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    most = length - gram + 1
    hashes = _over_powers(_BYTE_HASHES[data], gram, _mixed)
    least = _over_powers(hashes, most, np.minimum)
    stretch = np.searchsorted(ends, np.arange(n), "right")
    inside = np.arange(n) + length <= ends[stretch]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (stretch[1:] != stretch[:-1])
    firsts = np.flatnonzero(new & inside)
    lasts = np.minimum(np.append(firsts[1:], n), ends[stretch[firsts]] - length + 1)
    parts = -(-(lasts - firsts) // most)
    origin = np.repeat(np.arange(len(firsts)), parts)
    nth = np.arange(len(origin)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = firsts[origin] + nth * most
    windows = np.minimum(lasts[origin] - starts, most)
    # Grams that are the least of some window; a window repeats inside a run only if its anchor does.
    around = np.concatenate([np.zeros(most - 1, np.uint64), least, np.zeros(most - 1, np.uint64)])
    marked = np.flatnonzero(hashes == _over_powers(around, most, np.maximum))
    low, high = np.searchsorted(marked, starts), np.searchsorted(marked, starts + windows + length - gram)
    of = np.repeat(np.arange(len(starts)), high - low)
    at = marked[np.arange(len(of)) - np.repeat(np.cumsum(high - low) - high, high - low)]
    again = np.bincount(of[hashes[at] == least[starts[of]]], minlength=len(starts)) > 1
    return starts, windows, least[starts].view(np.int64), again


def _stretches(batches: Iterable[pd.DataFrame], length: int) -> Iterator[list[tuple[bytes, int, int, bytes]]]:
    """Batches of (unit, copies, offset, bytes) of about ``_BATCH`` bytes; longer texts in overlapping stretches."""
    held, size = [], 0
    for batch in batches:
        for unit, copies, body in zip(batch["_unit"], batch["copies"], batch["_body"], strict=True):
            data = body.encode() if isinstance(body, str) else bytes(body)
            for at in range(0, max(len(data) - length + 1, 0), _BATCH):
                part = data[at : at + _BATCH + length - 1]
                held.append((bytes(unit), copies, at, part))
                size += len(part)
                if size >= _BATCH:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _cut(gram: int, length: int):
    """Runs of each text: start, windows, anchor and digest of the content."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in _stretches(batches, length):
            whole = b"".join(part for *_, part in held)
            ends = np.cumsum([len(part) for *_, part in held])
            starts, windows, anchors, again = runs(np.frombuffer(whole, np.uint8), ends, gram, length)
            view = memoryview(whole)
            contents = [
                xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(starts.tolist(), (starts + windows + length - 1).tolist(), strict=True)
            ]
            bounds = np.searchsorted(starts, np.append(0, ends))
            rows = []
            for i, (unit, copies, offset, part) in enumerate(held):
                of = slice(bounds[i], bounds[i + 1])
                rows.append((unit, copies, starts[of] - (ends[i] - len(part)) + offset, windows[of], anchors[of], contents[of], again[of]))
            yield pd.DataFrame(rows, columns=["_unit", "copies", "starts", "windows", "anchors", "contents", "again"])

    return run


_CUT = "_unit binary, copies bigint, starts array<bigint>, windows array<int>, anchors array<bigint>, contents array<binary>, again array<boolean>"


class Suffixes:
    """The parts of an enhanced suffix array that can hold maximal repeats of ``least`` bytes.

    Suffixes that share their first ``least`` bytes are neighbours in the suffix array. They
    are found by a hash of these bytes; where all are preceded by the same byte, none of them
    begins a maximal repeat, and the part is left out. The others are sorted and their common
    prefixes measured. Strings of different groups have nothing in common.
    """

    def __init__(self, strings: list[bytes], groups: list[int], least: int):
        self.strings, self.least = strings, least
        lengths = np.array([len(s) for s in strings])
        self.begins = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(strings), np.uint8)
        n = len(data) - least + 1
        self.places = self.string = self.before = np.zeros(0, np.int64)
        self.firsts = self.lasts = self.places
        if n <= 0:
            return
        string = np.repeat(np.arange(len(strings)), lengths)[:n]
        hashes = _over_powers(_BYTE_HASHES[data], least, _mixed)
        hashes = _mixed(hashes, np.asarray(groups).astype(np.uint64)[string])
        places = np.flatnonzero(np.arange(n) + least <= (self.begins + lengths)[string])
        places = places[np.argsort(hashes[places], kind="stable")]
        opens = np.append(True, hashes[places[1:]] != hashes[places[:-1]])
        # A suffix that starts its string has a left neighbour of its own.
        string = string[places]
        before = np.where(places > self.begins[string], data[places - 1], 256 + string)
        firsts = np.flatnonzero(opens)
        if len(firsts):
            diverse = np.minimum.reduceat(before, firsts) != np.maximum.reduceat(before, firsts)
            kept = np.repeat(diverse, np.diff(np.append(firsts, len(places))))
            self.places, self.string, self.before = places[kept], string[kept], before[kept]
            self.firsts = np.flatnonzero(opens[kept])
            self.lasts = np.append(self.firsts, len(self.places))[1:] - 1
        self.offset = self.places - self.begins[self.string] if len(self.places) else self.places

    def sort(self, first: int, last: int) -> list[int]:
        """Put a part in order; the common prefixes of its neighbours."""
        ends = [self.strings[s][o:] for s, o in zip(self.string[first : last + 1], self.offset[first : last + 1], strict=True)]
        order = sorted(range(len(ends)), key=ends.__getitem__)
        for column in (self.places, self.string, self.before, self.offset):
            column[first : last + 1] = column[first : last + 1][order]
        ends = [ends[i] for i in order]
        return [_common(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def interval_tree(common: list[int], before: list[int], least: int) -> list[tuple[int, int, int]]:
    """Left-diverse intervals (first, last, length) of common prefixes >= ``least``.

    ``common[i]`` is shared by suffixes i and i + 1; ``before`` is each suffix's left neighbour.
    Children come before the intervals that hold them.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[list] = []  # length, first suffix, left neighbour or None where they differ
    for i, own in enumerate(before):
        shared = common[i] if i < len(common) else 0
        first = i
        while stack and stack[-1][0] > shared:
            length, first, of = stack.pop()
            own = own if own == of else None
            if own is None:
                found.append((first, i, length))
        if shared >= least:
            if stack and stack[-1][0] == shared:
                stack[-1][2] = own if own == stack[-1][2] else None
            else:
                stack.append([shared, first, own])
    return found


def maximal(suffixes: Suffixes) -> list[tuple[int, int, int]]:
    """Maximal repeats as (first, last, length) over the suffixes."""
    found: list[tuple[int, int, int]] = []
    for first, last in zip(suffixes.firsts.tolist(), suffixes.lasts.tolist(), strict=True):
        common = suffixes.sort(first, last)
        tree = interval_tree(common, suffixes.before[first : last + 1].tolist(), suffixes.least)
        found += [(first + a, first + b, length) for a, b, length in tree]
    return found


def _trees(length: int):
    """One row per anchor: its maximal repeats over its suffixes, all of them in suffix order.

    ``firsts``, ``lasts``, ``lengths``: the repeats; ``contents``, ``offsets``: the suffixes
    that belong to any; ``longest``: the longest repeat that holds the suffix. Contents that
    occur more than once are repeats as a whole.
    """

    def grown(held: list[tuple]) -> pd.DataFrame:
        anchors = list(dict.fromkeys(anchor for anchor, *_ in held))
        number = {anchor: i for i, anchor in enumerate(anchors)}
        suffixes = Suffixes([body for *_, body in held], [number[anchor] for anchor, *_ in held], length)
        found = maximal(suffixes)
        longest = np.zeros(len(suffixes.places), np.int64)
        for first, last, size in reversed(found):  # parents first: what is deeper is longer
            longest[first : last + 1] = size
        out = {anchor: ([], [], [], [], [], []) for anchor in anchors}
        place: dict[int, int] = {}
        for i in np.flatnonzero(longest > 0).tolist():
            anchor, content, _, _ = held[suffixes.string[i]]
            row = out[anchor]
            place[i] = len(row[0])
            row[0].append(content)
            row[1].append(int(suffixes.offset[i]))
            row[2].append(int(longest[i]))
        for first, last, size in found:
            row = out[held[suffixes.string[first]][0]]
            for column, value in zip(row[3:], (place[first], place[last], size), strict=True):
                column.append(value)
        for anchor, content, times, body in held:
            if times > 1:
                row = out[anchor]
                for column, value in zip(row[3:], (len(row[0]), len(row[0]), len(body)), strict=True):
                    column.append(value)
                for column, value in zip(row[:3], (content, 0, len(body)), strict=True):
                    column.append(value)
        rows = [(anchor, *row) for anchor, row in out.items() if row[0]]
        return pd.DataFrame(rows, columns=["anchor", "contents", "offsets", "longest", "firsts", "lasts", "lengths"])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for anchor, content, times, body in zip(batch["anchor"], batch["content"], batch["times"], batch["_body"], strict=True):
                if size >= _BATCH and anchor != held[-1][0]:
                    yield grown(held)
                    held, size = [], 0
                held.append((anchor, bytes(content), times, bytes(body)))
                size += len(body)
        if held:
            yield grown(held)

    return run


_TREES = (
    "anchor bigint, contents array<binary>, offsets array<int>, longest array<int>, firsts array<int>, lasts array<int>, lengths array<int>"
)


def _pieces(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut wanted contents out of their texts."""
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.iloc[at : at + 256]
            rows = []
            for body, wanted in zip(part["_body"], part["_wanted"], strict=True):
                data = body.encode() if isinstance(body, str) else bytes(body)
                rows += [(w["anchor"], bytes(w["content"]), w["times"], data[w["start"] : w["start"] + w["size"]]) for w in wanted]
            yield pd.DataFrame(rows, columns=["anchor", "content", "times", "_body"])


def _bodies(contents: DataFrame, bodies) -> DataFrame:
    """``contents`` with their bytes, each from one text that holds it; ``bodies`` gives texts by unit,
    those wanted at least."""
    wanted = contents.select(
        F.col("_at._unit").alias("_unit"), F.struct("anchor", "content", "times", F.col("_at.start").alias("start"), "size").alias("_one")
    )
    wanted = settle(wanted.groupBy("_unit").agg(F.collect_list("_one").alias("_wanted")), "wanted")
    return bodies(wanted.select("_unit")).join(wanted, "_unit").select("_body", "_wanted").mapInPandas(
        _pieces, "anchor bigint, content binary, times bigint, _body binary"
    )


def _found(cut: DataFrame, bodies, level: int, length: int, every: bool, most_contents: int) -> DataFrame:
    """``_unit``, ``start``, ``length`` and ``repeat`` of repeats in the texts of ``cut``.

    Each repeat's every occurrence (``every``), or only the longest at each place (``repeat`` is
    NULL then). ``bodies`` gives the texts of wanted units.
    """
    rows = cut.select("_unit", "copies", F.inline(F.arrays_zip("starts", "windows", "anchors", "contents", "again")))
    rows = rows.withColumnsRenamed({"starts": "start", "anchors": "anchor", "contents": "content"})
    contents = rows.groupBy("anchor", "content").agg(
        F.sum("copies").alias("times"),
        F.count("*").alias("rows"),
        F.min(F.struct("_unit", "start")).alias("_at"),
        (F.max("windows") + length - 1).alias("size"),
        F.max("again").alias("again"),
    )
    contents = settle(contents.withColumn("_salt", F.pmod(F.xxhash64("content"), F.lit(64))), "contents")
    # An anchor's totals go to its contents by parts of the anchor, so no task takes all of a common one.
    parts = contents.groupBy("anchor", "_salt").agg(F.count("*").alias("different"), F.sum("times").alias("all"), F.max("again").alias("again"))
    totals = parts.groupBy("anchor").agg(
        F.sum("different").alias("different"), F.sum("all").alias("all"), F.max("again").alias("again"), F.collect_list("_salt").alias("_salts")
    )
    totals = totals.where("all > 1 or again").select("anchor", "different", F.explode("_salts").alias("_salt"))
    known = settle(contents.join(totals, ["anchor", "_salt"]).drop("_salt"), "repeated")
    last = level == len(_grams(length)) - 1
    crowded = F.lit(False) if last else F.col("different") > most_contents
    one = (F.col("different") == 1) & (F.col("times") > 1)
    whole = known.where(one).select(
        "anchor", "content", F.lit(0).alias("offset"), F.col("size").alias("length"), F.concat(F.hex("anchor"), F.lit("-"), F.hex("content")).alias("repeat")
    )
    some = _bodies(known.where(~one & ~crowded), bodies)
    trees = settle(some.repartition("anchor").sortWithinPartitions("anchor", "content").mapInPandas(_trees(length), _TREES), "trees")
    if every:
        groups = trees.select("anchor", "contents", "offsets", F.posexplode(F.arrays_zip("firsts", "lasts", "lengths")).alias("_n", "_g"))
        members = F.slice(F.arrays_zip("contents", "offsets"), F.col("_g.firsts") + 1, F.col("_g.lasts") - F.col("_g.firsts") + 1)
        grown = groups.select("anchor", F.col("_g.lengths").alias("length"), "_n", F.inline(members))
        grown = grown.select(
            "anchor", F.col("contents").alias("content"), F.col("offsets").alias("offset"), "length", F.concat(F.hex("anchor"), F.lit("-"), "_n").alias("repeat")
        )
    else:
        grown = trees.select("anchor", F.inline(F.arrays_zip("contents", "offsets", "longest")))
        grown = grown.select("anchor", F.col("contents").alias("content"), F.col("offsets").alias("offset"), F.col("longest").alias("length"), F.lit(None).cast("string").alias("repeat"))
        whole = whole.withColumn("repeat", F.lit(None).cast("string"))
    found = whole.unionByName(grown)
    many = known.where(crowded)
    if not last and not many.isEmpty():
        name = F.concat(F.unhex(F.lpad(F.hex("anchor"), 16, "0")), "content")
        units = settle(_bodies(many, bodies).select("anchor", "content", name.alias("_unit"), F.col("times").alias("copies"), "_body"), "crowded")
        below = settle(units.select("_unit", "copies", "_body").mapInPandas(_cut(_grams(length)[level + 1], length), _CUT), "cut")
        inner = _found(below, lambda wanted: units.select("_unit", "_body"), level + 1, length, every, most_contents)
        of_anchor = F.conv(F.hex(F.substring("_unit", 1, 8)), 16, -10).cast("bigint").alias("anchor")
        of_content = F.substring("_unit", 9, 16).alias("content")
        found = found.unionByName(inner.select(of_anchor, of_content, F.col("start").cast("int").alias("offset"), F.col("length").cast("int").alias("length"), "repeat"))
    spans = found.groupBy("anchor", "content").agg(F.collect_list(F.struct("offset", "length", "repeat")).alias("_spans"))
    spans = settle(spans.join(known.select("anchor", "content", "rows"), ["anchor", "content"]), "spans")
    placed = texts.carried(rows.select("_unit", "start", "anchor", "content"), spans, ["anchor", "content"], "rows")
    placed = placed.select("_unit", "start", F.explode("_spans").alias("_s"))
    placed = placed.select("_unit", (F.col("start") + F.col("_s.offset")).alias("start"), F.col("_s.length").cast("bigint").alias("length"), F.col("_s.repeat").alias("repeat"))
    return settle(placed, "placed")


def _repeats(docs: DataFrame, text: str, length: int, every: bool, most_contents: int) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit("")).alias("_body")
    source = docs.select(texts.digest(F.col(text)).alias("_unit"), F.lit(1).cast("bigint").alias("copies"), body)
    cut = source.where(F.octet_length("_body") >= length).mapInPandas(_cut(_grams(length)[0], length), _CUT)
    # Long texts come in stretches; copies of a text are the same stretches and counted as one.
    parts = ["starts", "windows", "anchors", "contents", "again"]
    cut = cut.withColumn("_first", F.element_at("starts", 1)).groupBy("_unit", "_first").agg(
        F.sum("copies").alias("copies"), F.first(F.struct(*parts)).alias("_cut")
    )
    cut = settle(cut.select("_unit", "copies", "_cut.*"), "cut")

    def bodies(wanted: DataFrame) -> DataFrame:
        found = texts.of_digests(docs, wanted.withColumnRenamed("_unit", "_digest"), text)
        return found.select(F.col("_digest").alias("_unit"), F.col("_text").alias("_body"))

    return _found(cut, bodies, 0, length, every, most_contents)


def maximal_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, most_contents: int = MOST_CONTENTS) -> DataFrame:
    """``repeat``, ``length``, ``_digest`` and ``start``: all occurrences of each maximal repeat.

    Texts stand for all rows that hold them (``texts.keyed`` gives their digests). A repeat is
    maximal inside the bytes of its anchor's windows; longer ones come as overlapping repeats.
    """
    found = _repeats(docs, text, length, True, most_contents)
    return found.select("repeat", "length", F.col("_unit").alias("_digest"), "start").distinct()


def _kept(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge each text's spans and take them out of its bytes."""
    for batch in batches:
        rows = []
        for of, body, spans in zip(batch["_digest"], batch["_text"], batch["_spans"], strict=True):
            data = body.encode()
            merged: list[list[int]] = []
            for first, last in sorted((s["start"], s["start"] + s["length"]) for s in spans):
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], last)
                else:
                    merged.append([first, last])
            gaps = [0, *[edge for span in merged for edge in span], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(gaps[::2], gaps[1::2], strict=True))
            rows.append((of, len(data) - len(kept), len(merged), kept, [tuple(m) for m in merged]))
        out = pd.DataFrame(rows, columns=["_digest", "n_removed", "n_spans", "kept", "spans"])
        out["kept_sha256"] = [hashlib.sha256(k).hexdigest() for k in out["kept"]]
        yield out


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, most_contents: int = MOST_CONTENTS
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` and ``kept_sha256`` of every row.

    Each byte is removed that a string of ``length`` bytes covers which also starts elsewhere,
    in another row or in the same; strings may overlap and are judged on the input. ``spans``:
    first byte and end of each removed run. NULL texts count as empty; rows that repeat a key
    or have none are documents of their own.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("bigint").alias("_key"), texts.digest(F.col(text)).alias("_digest"), F.octet_length(body).cast("bigint").alias("n_bytes"), F.sha2(body, 256).alias("_whole")
    )
    rows = settle(rows, "keys")
    spans = _repeats(docs, text, length, False, most_contents)
    spans = settle(spans.groupBy(F.col("_unit").alias("_digest")).agg(F.collect_list(F.struct("start", "length")).alias("_spans")), "spans")
    held = texts.of_digests(docs, spans, text).join(spans, "_digest")
    columns = "_digest binary, n_removed bigint, n_spans bigint, kept binary, spans array<struct<first: bigint, end: bigint>>, kept_sha256 string"
    done = held.mapInPandas(_kept, columns).drop("kept")
    copies = rows.groupBy("_digest").agg(F.count("*").alias("copies"))
    done = copies.join(done, "_digest", "left")
    found = texts.carried(rows, settle(done, "measures"))
    return found.select(
        F.col("_key").alias(key),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "_whole").alias("kept_sha256"),
        F.coalesce("spans", F.array()).alias("spans"),
    )
