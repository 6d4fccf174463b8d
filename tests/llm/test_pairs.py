"""Near-duplicate texts and vectors against brute force; components of graphs."""

from __future__ import annotations

import contextlib
import os
import random
import re
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilmart.llm import cells, graph, oddsketch


def groups(nodes, links):
    of = {n: n for n in nodes}

    def top(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        of[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset((width, *words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows, width):
    sets = {i: shingles(t, width) for i, t in rows}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    return {i: (len(sets[i]), c, c == i) for i, c in groups(ids, links).items()}


def edited(chance, words, n):
    out = list(words)
    for _ in range(n):
        out[chance.randrange(len(out))] = f"x{chance.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("width", [2, 5])
def test_groups_equal_brute_force(spark, docs, width):
    chance = random.Random(3)
    rows = []
    for _ in range(12):
        base = [f"w{chance.randrange(500)}" for _ in range(chance.choice([3, 12, 60, 700]))]
        rows += [edited(chance, base, chance.randrange(1 + len(base) // 9)) for _ in range(12)]
    # One group of near copies of very different distance, many copies of one text, odd texts.
    base = [f"v{chance.randrange(900)}" for _ in range(150)]
    rows += [edited(chance, base, chance.randrange(24)) for _ in range(150)]
    rows += ["same same text here"] * 40 + ["SAME same\ttext  here", "", None, " \n", "one", "One", "one two", "é È", "é È"]
    table = list(enumerate(rows))
    chance.shuffle(table)
    found = oddsketch.near_duplicates(docs(*table), width=width).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == expected(table, width)


def test_rows_without_or_with_repeated_ids(spark, docs):
    rows = docs((None, "a b c"), (2, "a b c"), (2, "a b c"), (1, "a b c"), (3, None)).withColumn("kept", F.lit(0))
    found = sorted(tuple(r) for r in oddsketch.near_duplicates(rows, width=2).where("doc_id is not null").collect())
    assert found == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)]
    assert oddsketch.near_duplicates(rows).where("doc_id is null and kept and component_id is null").count() == 1
    assert oddsketch.near_duplicates(rows.where("false")).count() == 0


def test_ids_repeated_with_different_texts(spark, docs):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    a, b, c = (" ".join(f"{w}{k}" for w in words) for k in "abc")
    near = f"{c} more"
    rows = [(3, a), (5, a), (5, b), (5, None), (-7, c), (-7, b + " z"), (9, near), (9, "0 first of all texts"), (11, b), (12, "")]
    found = {(r["doc_id"], r["n_shingles"]): r for r in oddsketch.near_duplicates(docs(*rows)).collect()}
    # -7 and 5 share (nearly) b, 5 and 3 share a; 9 is near to -7 by a text that isn't its smallest.
    assert {k[0]: r["component_id"] for k, r in found.items()} == {3: -7, 5: -7, -7: -7, 9: -7, 11: -7, 12: 12}
    by_id = oddsketch.near_duplicates(docs(*rows)).groupBy("doc_id").agg(F.countDistinct("component_id").alias("n"))
    assert {r["n"] for r in by_id.collect()} == {1}


def test_odd_sketches_estimate_similarity():
    chance = np.random.default_rng(5)
    for share in (0.8, 0.9, 0.95):
        n = 2000
        both = int(2 * n * share / (1 + share))
        pool = chance.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
        left, right = np.sort(pool[:n]), np.sort(pool[n - both :])
        lanes = oddsketch.odd_sketches(oddsketch.minhashes([left, right])).view(np.uint64)
        flipped = int(np.bitwise_count(lanes[0] ^ lanes[1]).sum())
        m = -512 * np.log(1 - flipped / 512)
        assert 1 - m / (2 * oddsketch.SAMPLES) == pytest.approx(share, abs=0.09)
        assert flipped <= oddsketch.MOST_FLIPPED


def test_sampled_sets_drop_fewer_pairs_than_the_bands():
    from math import exp, lgamma, log, sqrt

    def short(n):  # chance that n samples of a pair at 0.8 fall below the limit
        limit = 0.8 * n - oddsketch.SLACK * sqrt(0.16 * n)
        return sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(0.8) + (n - k) * log(0.2)) for k in range(n) if k < limit)

    assert max(short(n) for n in range(200, 1200, 7)) < 5e-8


def test_large_sets_hash_alike_in_pieces():
    values = np.unique(np.random.default_rng(2).integers(0, 2**63, 80_000, dtype=np.uint64))
    alone = oddsketch.minhashes([values])
    assert (alone == oddsketch.minhashes([values[:5], values])[1]).all()


def test_components_of_chains_stars_and_loops(spark):
    chance = random.Random(9)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(200, 200), (300, 299), (299, 300)]
    links += [(chance.randrange(400, 600), chance.randrange(400, 600)) for _ in range(120)]
    chance.shuffle(links)
    found = graph.components(spark.createDataFrame([*links, (None, 1)], "a bigint, b bigint")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in found} == groups(nodes, [x for x in links if x[0] != x[1]])
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def close_pairs(chance, cosine, n, dim=64):
    """n pairs of unit vectors with the given cosine."""
    a = chance.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = chance.normal(size=(n, dim))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


def test_vectors_equal_brute_force_up_to_recall(spark):
    chance = np.random.default_rng(4)
    left, right = close_pairs(chance, 0.932, 300)
    hub = chance.normal(size=64)
    dense = hub / np.linalg.norm(hub) + 0.02 * chance.normal(size=(150, 64))
    vectors = np.concatenate([left, right, dense, np.repeat(left[:1], 20, 0), chance.normal(size=(2000, 64))])
    labels = np.where(np.arange(len(vectors)) % 600 < 599, 1, 2)
    frame = spark.createDataFrame(
        [(int(i), [float(x) for x in v], int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))],
        "vec_id bigint, embedding array<double>, label int",
    )
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    found = {r["vec_id"]: r for r in cells.near_duplicates(frame).collect()}
    counts = np.array([found[i]["n_links"] for i in range(len(vectors))])
    assert (counts <= linked.sum(1)).all()
    assert counts.sum() >= 0.97 * linked.sum()
    truth = groups(range(len(vectors)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked), strict=True) if a < b])
    assert all(truth[found[i]["component_id"]] == truth[i] for i in range(len(vectors)))
    assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in range(len(vectors)))


def test_unsound_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (2, [1.0, 0.0], 1),
        (3, [1.0, 0.0], None),
        (4, None, 1),
        (5, [], 1),
        (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1),
        (8, [inf, 1.0], 1),
        (9, [None, 1.0], 1),
        (10, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0], 1),
        (11, [1.0, 0.0], 2),
        (12, [1e300, 0.0], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in cells.near_duplicates(frame).collect()]
    assert len(found) == len(rows)
    linked = {1, 2, 12}
    for key, links, component, kept in found:
        if key in linked:
            assert (links, component, kept) == (3, 1, key == 1)
        else:
            assert (links, component, kept) == (0, key, True)
    assert cells.near_duplicates(frame.where("false")).count() == 0
    assert cells.near_duplicates(frame.where("vec_id = 4")).count() == 1


def linked_by_brute_force(vectors, labels):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    return linked


@pytest.fixture
def small_blocks(monkeypatch):
    """Labels of over 384 vectors are cut into cells, cells into blocks of 96."""
    monkeypatch.setattr(cells, "TILE", 96)
    monkeypatch.setattr(cells, "BLOCK_VALUES", 64)
    monkeypatch.setattr(cells, "VECTORS_PER_CELL", 150)
    monkeypatch.setattr(cells, "CHUNK_BYTES", 8192)


@pytest.mark.parametrize("element", ["float", "double"])
def test_vectors_equal_brute_force_in_cells_blocks_and_rounds(spark, small_blocks, element):
    chance = np.random.default_rng(8)
    left, right = close_pairs(chance, 0.935, 200)
    hub = chance.normal(size=64)
    dense = hub / np.linalg.norm(hub) + 0.02 * chance.normal(size=(400, 64))
    loose = hub / np.linalg.norm(hub) + 0.034 * chance.normal(size=(150, 64))
    vectors = np.concatenate([left, right, dense, loose, np.repeat(left[:1], 20, 0), chance.normal(size=(1800, 64))])
    vectors = vectors.astype(np.float32).astype(np.float64)
    labels = np.where(np.arange(len(vectors)) % 20 < 19, 1, 2 + np.arange(len(vectors)) % 3)
    frame = spark.createDataFrame(
        [(int(i), [float(x) for x in v], int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))],
        f"vec_id bigint, embedding array<{element}>, label int",
    )
    linked = linked_by_brute_force(vectors, labels)
    found = {r["vec_id"]: r for r in cells.near_duplicates(frame.repartition(5)).collect()}
    counts = np.array([found[i]["n_links"] for i in range(len(vectors))])
    assert (counts <= linked.sum(1)).all()  # no pair counts twice where several cells see it
    assert counts.sum() >= 0.999 * linked.sum()
    truth = groups(range(len(vectors)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked), strict=True) if a < b])
    assert all(truth[found[i]["component_id"]] == truth[i] for i in range(len(vectors)))
    assert sum(found[i]["component_id"] != truth[i] for i in range(len(vectors))) <= 2


def test_vectors_at_the_limit_are_told_in_double_precision(spark):
    turn = [np.arccos(0.93) + x for x in (-1e-9, 1e-9)]
    rows = [(0, [1.0, 0.0], 1), (1, [float(np.cos(turn[0])), float(np.sin(turn[0]))], 1), (2, [float(np.cos(turn[1])), -float(np.sin(turn[1]))], 1)]
    found = cells.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == {0: 1, 1: 1, 2: 0}


def test_vectors_take_little_disk(spark, monkeypatch, tmp_path):
    """At no time do shuffles and intermediate tables take four times the input."""
    monkeypatch.setattr(cells, "TILE", 256, raising=False)
    monkeypatch.setattr(cells, "BLOCK_VALUES", 64, raising=False)
    monkeypatch.setattr(cells, "VECTORS_PER_CELL", 200)
    vectors = np.random.default_rng(6).normal(size=(12_000, 64)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, label int")
    frame.repartition(4).write.parquet(path := f"{tmp_path}/embeddings.parquet")
    places = [str(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    places.append(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))

    def used(tops, kind):
        total = 0
        for top in tops:
            for at, _, names in os.walk(top):
                for name in names:
                    if re.search(kind, name):
                        with contextlib.suppress(OSError):  # a file may go meanwhile
                            total += os.lstat(f"{at}/{name}").st_size
        return total

    kind, over, most = r"^shuffle_.*data$|^part-", threading.Event(), 0
    before = used(places, kind)

    def watch():
        nonlocal most
        while not over.wait(0.02):
            most = max(most, used(places, kind) - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert cells.near_duplicates(spark.read.parquet(path)).where("n_links = 0").count() == len(vectors)
    finally:
        over.set()
        watcher.join()
    assert 0 < most < 4 * used([path], r"parquet$")
