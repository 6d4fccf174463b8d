"""Ranked search against scoring every document in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from vigilmart.llm import bitsliced

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def split(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def expected(rows, items, top=20):
    held = [(key, split(text)) for key, text in rows]
    held = [(key, len(f), Counter(f)) for key, f in held if f]
    n, length = len(held), sum(k for _, k, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    for item, query in sorted(set(items), key=repr):
        scores = []
        for key, size, counts in held:
            m = 75 + (25 * size * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t in split(query)
                if counts[t]
            )
            if score > 0:
                scores.append((-score, key is None, key, score))
        for rank, (_, _, key, score) in enumerate(sorted(scores, key=lambda s: s[:2] + (s[2] or 0,))[:top], 1):
            yield item, rank, key, score


def compare(spark, docs, rows, items, **options):
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = bitsliced.ranked(docs(*rows), asked, **options).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected(rows, items, options.get("top", 20)), key=repr)
    return got


def corpus(n, seed=3):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    pick = lambda k: " ".join(chance.choices(words, [1 / (i + 1) for i in range(200)], k=k))
    return [(i, pick(chance.choice([1, 5, 40, 200]))) for i in range(n)], pick


def test_ranking_equals_scoring_every_document(spark, docs):
    rows, pick = corpus(1500)
    rows += [(5000 + i, rows[7][1]) for i in range(300)]  # a group of copies
    rows.append((9000, pick(20000)))
    items = [(i, pick(12)) for i in range(25)] + [(30, rows[7][1]), (31, "w1 w1 w1 W1 absent"), (32, "absent"), (33, "..."), (34, None)]
    assert compare(spark, docs, rows, items)


def test_odd_rows(spark, docs):
    rows = [(1, "Ärger Ä ä a-b_C d\x00e"), (1, "ärger again"), (None, "ärger"), (None, "b c"), (4, None), (5, ""), (6, "?!"), (7, "b " * 3000)]
    items = [(1, "ÄRGER ärger Ä"), (2, "b C c"), (2, "b C c"), (2, "e"), (3, "d ")]
    assert compare(spark, docs, rows, items)


def test_equal_scores_come_by_id(spark, docs):
    rows = [(i, "same words here") for i in range(60, 0, -1)] + [(i, "others") for i in range(100, 300)]
    got = compare(spark, docs, rows, [(1, "same")])
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 21))


def test_passes_and_both_joins_agree(spark, docs, monkeypatch):
    rows, pick = corpus(400, 5)
    monkeypatch.setattr(bitsliced, "MOST_ITEMS", 4)
    monkeypatch.setattr(bitsliced, "MOST_SENT", 0)
    compare(spark, docs, rows, [(i, pick(6)) for i in range(10)], top=3)


def test_empty_tables_and_clashing_columns(spark, docs):
    rows = [(1, "a b"), (2, "c")]
    asked = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert bitsliced.ranked(docs(*rows).where("doc_id < 0"), asked).count() == 0
    assert bitsliced.ranked(docs(*rows), asked.where("item_id < 0")).count() == 0
    clashing = docs(*rows).selectExpr("*", "1 AS rank", "2 AS score", "3 AS item_id", "4 AS _item", "5 AS size")
    assert [tuple(r)[:3] for r in bitsliced.ranked(clashing, asked).collect()] == [(1, 1, 1)]


def test_bounds_never_fall_below_scores():
    rows, pick = corpus(300, 9)
    counts = [Counter(bitsliced.terms(t)) for _, t in rows]
    held = []
    for i, c in enumerate(counts):
        times = np.array(list(c.values()))
        keys = bitsliced.hashed(c)
        held.append((i.to_bytes(2, "big"), int(times.sum()), [keys[times >= s] for s in bitsliced.STEPS if s <= times.max()]))
    items = bitsliced.Items([(i, pick(8)) for i in range(10)])
    n, length = len(rows), sum(h[1] for h in held)
    df = np.array([sum(w in c for c in counts) for w in items.words])
    weights = items.weigh(n, df)
    bounds = bitsliced.Bounds(items, weights, n, length)
    seen = 0
    for block in bitsliced._blocks(held):
        found = bounds.of(np.array(block["lengths"]), block["size"], block["slices"])
        for place, name in enumerate(block["digests"]):
            c = counts[int.from_bytes(name, "big")]
            m = 75 + (25 * sum(c.values()) * n) // length
            for i in range(10):
                score = sum(int(w) * bitsliced.saturation(c[items.words[t]], m) for t, w in zip(items.terms[i], weights[i], strict=True))
                assert found[i, place] >= score
                seen += 1
    assert seen == 3000
