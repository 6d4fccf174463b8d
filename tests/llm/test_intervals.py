"""Repeats against all substrings of small texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from vigilmart.llm import intervals, texts


def occurrences(strings, groups, least):
    """Every maximal repeat of ``least`` bytes or more with all its places."""
    places = defaultdict(list)
    for i, s in enumerate(strings):
        for a in range(len(s)):
            for b in range(a + least, len(s) + 1):
                places[groups[i], s[a:b]].append((i, a))
    for (_, word), found in places.items():
        before = {strings[i][a - 1] if a else (i, a) for i, a in found}
        after = {strings[i][a + len(word)] if a + len(word) < len(strings[i]) else (i, a) for i, a in found}
        if len(found) > 1 and len(before) > 1 and len(after) > 1:
            yield len(word), tuple(sorted(found))


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abc\x00\xff"])
def test_interval_tree_finds_all_maximal_repeats(letters):
    chance = random.Random(len(letters))
    for _ in range(120):
        strings = [bytes(chance.choices(letters, k=chance.randint(1, 45))) for _ in range(chance.randint(1, 5))]
        groups, least = sorted(chance.choices([0, 1], k=len(strings))), chance.choice([2, 3, 9])
        suffixes = intervals.Suffixes(strings, groups, least)
        found = {
            (length, tuple(sorted((int(suffixes.string[i]), int(suffixes.offset[i])) for i in range(first, last + 1))))
            for first, last, length in intervals.maximal(suffixes)
        }
        assert found == set(occurrences(strings, groups, least))


def expected(rows, length):
    bodies = [(key, (text or "").encode()) for key, text in rows]
    windows = Counter(b[a : a + length] for _, b in bodies for a in range(len(b) - length + 1))
    for key, body in bodies:
        gone = bytearray(len(body))
        for a in range(len(body) - length + 1):
            if windows[body[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        kept = bytes(x for x, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield key, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def compare(docs, rows, length, **options):
    got = intervals.without_repeats(docs(*rows), length=length, **options).drop("spans").collect()
    want = sorted(expected(rows, length), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    return want


def prose(chance, n):
    return " ".join(chance.choice(["alpha", "beta", "gamma", "delta", "épsilon", "zeta"]) for _ in range(n))


@pytest.mark.parametrize("most_contents", [256, 2])
def test_removal_equals_brute_force(docs, most_contents):
    chance = random.Random(5)
    passage = prose(chance, 30)
    rows = [(i, prose(chance, 20) + passage + prose(chance, 20)) for i in range(40)]
    near = list(prose(chance, 60))
    for i in range(40):  # near copies, each with an edit of its own
        place = chance.randrange(len(near))
        rows.append((100 + i, "".join(near[:place] + ["#"] + near[place:])))
    rows += [(200 + i, rows[3][1]) for i in range(20)]  # copies
    rows += [(300, "ab" * 300 + "x"), (301, "z" * 500), (302, "abcab" * 90), (303, prose(chance, 4000))]
    rows += [(None, passage), (None, None), (5, ""), (5, "short"), (5, rows[4][1])]
    want = compare(docs, rows, 60, most_contents=most_contents)
    assert any(r[2] for r in want) and any(not r[2] for r in want)


def test_windows_of_the_given_length(docs):
    chance = random.Random(8)
    shared = "".join(chance.choices("abcdefgh", k=399))
    rows = [(1, "1" + shared + "2"), (2, "3" + shared + "4"), (3, "5" + shared + "é"), (4, "6" + shared + "é")]
    want = compare(docs, rows, 400)
    # "é" adds two bytes, so only the last two share 400 bytes.
    assert [r[2] for r in want] == [0, 0, 401, 401]


def test_texts_longer_than_a_stretch(docs, monkeypatch):
    monkeypatch.setattr(intervals, "_BATCH", 1000)
    chance = random.Random(2)
    long = "".join(chance.choices("abcdef", k=7000))
    compare(docs, [(1, long), (2, "x" + long[2000:5000]), (3, long), (4, "".join(chance.choices("abcdef", k=900)))], 100)


def test_empty_table_and_clashing_columns(docs):
    assert intervals.without_repeats(docs((1, "a")).where("doc_id < 0")).count() == 0
    rows = docs((1, "abc" * 200), (2, "y")).selectExpr("*", "1 AS n_bytes", "2 AS copies", "3 AS start", "4 AS _unit")
    assert sorted((r["doc_id"], r["n_removed"]) for r in intervals.without_repeats(rows).collect()) == [(1, 600), (2, 0)]


def test_repeats_list_all_their_occurrences(spark, docs):
    chance = random.Random(4)
    shared = "".join(chance.choices("abcd", k=80))
    bodies = ["1" + shared + "2", "3" + shared[:70] + "4", "5" + shared + "6", "7" + shared[10:] + "8"]
    frame = docs(*enumerate(bodies))
    keys = {bytes(r["_digest"]): r["_key"] for r in texts.keyed(frame, "doc_id", "text").collect()}
    found = defaultdict(set)
    for row in intervals.maximal_repeats(frame, length=60).collect():
        found[row["repeat"], row["length"]].add((keys[bytes(row["_digest"])], row["start"]))
    words = defaultdict(set)
    for (_, length), places in found.items():
        spelled = {bodies[i][a : a + length] for i, a in places}
        assert len(spelled) == 1 and length >= 60
        words[spelled.pop()] |= places
    # Whatever the anchors, each listed string comes with every place where it lies.
    for word, places in words.items():
        assert places == {(i, a) for i, b in enumerate(bodies) for a in range(len(b)) if b.startswith(word, a)}
    covered = {(i, a + k) for word, places in words.items() for i, a in places for k in range(len(word))}
    assert covered == {(i, k) for i, n in enumerate([80, 70, 80, 70]) for k in range(1, n + 1)}
