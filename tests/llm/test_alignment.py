"""Alignment of two tokenizers against a plain version that walks both token lists."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigilmart.llm import alignment, coding, texts

RANKS, MODEL = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(RANKS, encoding="ascii") as lines:
        spelled = {i: t for t, i in coding.vocabulary(lines).items()}
    with open(MODEL, "rb") as file:
        pieces = coding.PieceCoder(file.read()).bytes
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL), spelled, pieces


def walk(library, text):
    """A ids, B ids, links and groups, or None."""
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = library[0].encode(" " + text, add_special_tokens=False).ids, library[1].encode(text)
    _, _, spelled, pieces = library
    if b"".join(spelled[i] for i in a) != whole or b"".join(pieces[i] for i in b) != whole:
        return None
    starts = [np.cumsum([0, *[len(t[i]) for i in ids]]).tolist() for t, ids in ((spelled, a), (pieces, b))]
    spans = [list(zip(s[:-1], s[1:], ids, strict=True)) for s, ids in zip(starts, (a, b), strict=True)]
    links = [(x, y) for f, l, x in spans[0] for g, m, y in spans[1] if max(f, g) < min(l, m)]
    cuts = sorted(set(starts[0]) & set(starts[1]))
    groups = []
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        groups.append("|".join(",".join(str(i) for f, l, i in s if f >= first and l <= last) for s in spans))
    return a, b, links, groups


def expected(library, rows):
    walked = {t: walk(library, t) for _, t in rows}
    counts = Counter(p for _, t in rows if walked[t] for p in walked[t][2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for key, text in rows:
        if walked[text] is None:
            yield key, 0, 0, 0, 0, 0, 0, ""
        else:
            a, b, links, groups = walked[text]
            best = sum(counts[p] == most[p[1]] for p in links)
            yield key, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()


ROWS = [
    (1, "The quick brown fox's <|endoftext|> jumps\n\tover  1234 lazy dogs."),
    (2, "The quick brown fox's <|endoftext|> jumps\n\tover  1234 lazy dogs."),
    (2, "Straße, naïve café — 東京 𝒳 \x00 <s> <0x0A>"),
    (None, "x"),
    (4, None),
    (5, ""),
    (6, "a▁b is not spelled by its pieces"),
    (7, " "),
    (8, "   \n\n   leading and trailing   "),
    (9, "The quick fox " * 40),
]


def by_value(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_measures_equal_a_plain_walk(spark, docs, library):
    got = alignment.aligned_documents(docs(*ROWS), RANKS, MODEL).collect()
    assert by_value(got) == by_value(expected(library, ROWS))


def test_rounds_change_nothing(spark, docs, library):
    got = alignment.aligned_documents(docs(*ROWS), RANKS, MODEL, most_sent=7).collect()
    assert by_value(got) == by_value(expected(library, ROWS))


def test_groups_and_pairs_are_real_outputs(spark, docs, library):
    text = "Tokenizers disagree inside words."
    distinct = docs((1, text)).select(texts.digest(F.col("text")).alias("_digest"), F.lit(3).cast("bigint").alias("copies"), F.col("text").alias("_text"))
    row = alignment.alignments(distinct, RANKS, MODEL).first()
    a, b, links, groups = walk(library, text)
    assert row["groups"] == ";".join(groups) and (row["n_a"], row["n_b"], row["copies"]) == (len(a), len(b), 3)
    assert {(p & 0xFFFFFFFF, p >> 32): n for p, n in zip(row["pairs"], row["times"], strict=True)} == Counter(links)


def test_empty_table_and_clashing_columns(spark, docs):
    assert alignment.aligned_documents(docs((1, "a")).where("doc_id < 0"), RANKS, MODEL).count() == 0
    clashing = docs((1, "a b"), (2, "a b")).selectExpr("*", "7 AS copies", "8 AS _text", "9 AS n_a", "10 AS pairs")
    assert {r["n_a"] for r in alignment.aligned_documents(clashing, RANKS, MODEL).collect()} == {2}


def test_a_text_that_most_rows_hold_is_aligned_once(spark, docs, library):
    rows = [(i, "hot text of many copies") for i in range(300)] + [(1000 + i, f"other {i}") for i in range(20)]
    got = alignment.aligned_documents(docs(*rows), RANKS, MODEL).collect()
    assert by_value(got) == by_value(expected(library, rows))


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 1_200_000, " \t　" * 400_000])
@pytest.mark.parametrize("around", [("", "x"), ("a", ""), ("a", " b"), ("a", "'s"), ("", "")])
def test_long_runs_of_white_space_encode_as_in_the_library(library, run, around):
    with open(RANKS, encoding="ascii") as lines:
        own = tiktoken.Encoding("own", pat_str=coding.PATTERN, mergeable_ranks=coding.vocabulary(lines), special_tokens={})
    text = around[0] + run + around[1]
    assert coding.ordinary(own, text) == library[0].encode(text, add_special_tokens=False).ids
