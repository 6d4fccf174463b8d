"""Fingerprints, byte-level BPE and main texts against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigilmart.llm import bpe, mincut, parsing

ODD = ["", None, "a", "ab", "aaaaaaaaaaaa", "é😀", " \n\t ", "x" * 40000, "word " * 9000, "\x00\x1f"]


def prose(chance, n):
    return " ".join("".join(chance.choices("abcdeéo", k=chance.randrange(1, 9))) for _ in range(n))


def test_fingerprints_do_not_depend_on_the_batch():
    chance = random.Random(1)
    texts = [*ODD, *(prose(chance, chance.randrange(1, 400)) for _ in range(60))]
    together = parsing.fingerprints(texts)
    assert together == [parsing.fingerprints([t])[0] for t in texts]
    assert together[0] == together[1] == ""
    assert all(len(f) == parsing.SLOTS * parsing.DIGITS for f in together[2:])


def test_equal_passages_are_parsed_alike_at_any_offset():
    chance = random.Random(2)
    passage = prose(chance, 400)
    inside = parsing.fingerprints([passage, prose(chance, 3) + passage, "z" * 17 + passage + prose(chance, 5)])
    assert parsing._likeness(inside[0], inside[1]) > 0.85
    assert parsing._likeness(inside[0], inside[2]) > 0.85


def test_edited_texts_stay_near_and_others_do_not():
    chance = random.Random(3)
    texts = [prose(chance, 300) for _ in range(30)]
    prints = parsing.fingerprints(texts)
    changed = parsing.fingerprints([parsing.edited(a, b) for a, b in itertools.pairwise(texts)])
    for i, edited in enumerate(changed):
        assert 0.45 < parsing._likeness(prints[i], edited) < 0.9
        assert parsing._likeness(prints[i], prints[i + 1]) < 0.2


def test_levels_cut_at_local_maxima_only():
    names = parsing._mix(np.array([ord(c) for c in "the quick brown fox jumps"], dtype=np.uint64))
    out, owner, starts = parsing.level(names, np.zeros(len(names), np.int64))
    assert starts[0] == 0 and (np.diff(starts) >= 1).all() and len(out) <= len(names) // 2 + 1


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        changed = parsing.edited(text, following)
        one, two, three = parsing.fingerprints([text, changed, following])
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = (round(parsing._likeness(one, two), 9), round(parsing._likeness(one, three), 9))
        out.append((key, len(text), digest, one, two, *near))
    return sorted(out, key=str)


def test_each_text_meets_its_next_one(spark, docs):
    chance = random.Random(4)
    rows = [(i * 3, prose(chance, chance.randrange(0, 60))) for i in range(97)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(9, "twice"), (9, "again"), (9, "again"), (None, "no id"), (None, None)]
    chance.shuffle(rows)
    found = parsing.against_next(docs(*rows), rows_per_stretch=13)
    got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in found.collect()]
    assert sorted(got, key=str) == brute_next(rows)


def test_one_row_follows_itself_and_no_row_gives_none(spark, docs):
    row = parsing.against_next(docs((1, "abc def ghi"))).first()
    assert row["near_next"] == 1.0
    assert parsing.against_next(docs((1, "a")).where("false")).count() == 0


def test_likeness_in_sql_equals_the_task_side(spark, docs):
    chance = random.Random(5)
    rows = [(1, prose(chance, 50)), (2, ""), (3, prose(chance, 50))]
    frame = parsing.fingerprinted(docs(*rows))
    pairs = frame.alias("a").join(frame.alias("b"), F.col("a.doc_id") <= F.col("b.doc_id"))
    a, b = F.col("a.fingerprint"), F.col("b.fingerprint")
    for left, right, near in pairs.select(a, b, parsing.likeness(a, b)).collect():
        assert near == pytest.approx(parsing._likeness(left, right))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), encoding="ascii") as lines:
        return bpe.vocabulary(lines)


PIECES = ["a", "the", " ", "  ", "\n", "'", "s", "ll", "<|endoftext|>", "<|", "endoftext", "|>", "é", "́", "1", "23"]
PIECES += ["!", "?", "\t", "\x85", "\x1c", "　", "😀", "٣", "-", " ", "᠎", "​", "A"]


def test_short_chunks_agree_with_the_library(library, ranks, monkeypatch):
    monkeypatch.setattr(bpe, "LEAST", 3)
    monkeypatch.setattr(bpe, "MOST", 30)
    monkeypatch.setattr(bpe, "CUT_BITS", 2)
    coder, chance = bpe.Coder(ranks), random.Random(6)
    for _ in range(1500):
        text = "".join(chance.choices(PIECES, k=chance.randrange(90)))
        coder.known.clear()
        ids = coder.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids) == text


def test_shared_chunks_are_encoded_once(ranks):
    chance = random.Random(7)
    shared = prose(chance, 3000)
    coder = bpe.Coder(ranks)
    for _ in range(10):
        coder.encode(prose(chance, 20) + shared)
    assert coder.encoded < coder.asked / 3
    assert "".join(bpe.chunks(shared)) == shared


def test_whole_texts_are_coded_as_by_the_library(spark, docs, library):
    chance = random.Random(8)
    texts = [*ODD, *(prose(chance, 2000) for _ in range(5)), " " * 20000 + "x", "\n " * 9000]
    rows = [*enumerate(texts), (0, ""), (None, "no id")]
    coded = bpe.coded(docs(*rows), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert {r["doc_id"]: r["decoded"] for r in coded.collect()}[5] == ODD[5]
    found = bpe.digested(coded).collect()
    assert len(found) == len(rows)
    expected = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((key, len(ids), ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted((tuple(r) for r in found), key=str) == sorted(expected, key=str)
    assert bpe.coded(docs((1, "a")).where("false"), public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == 0


@pytest.mark.parametrize("letter", [" ", "\n", "\u3000", "x", "é", "7", "!", " x", "\n\t", "'s", "<|endoftext|>"])
@pytest.mark.parametrize("around", [("", ""), ("a ", "b"), ("", " <|endoftext|>")])
def test_long_runs_are_coded_as_by_the_library(library, ranks, letter, around):
    coder = bpe.Coder(ranks)
    for length in (1, 999, 1001, 3_000_000 if letter.isspace() and around[0] else 200_000):
        text = around[0] + letter * (length // len(letter)) + around[1]
        ids = coder.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids) == text


class Sliding(bpe.Coder):
    """A coder whose tokens depend on the whole text: no joint can agree."""

    def plain(self, text):
        return np.array([len(text) % 256, *super().plain(text)], np.int32)


def test_joints_are_compared_and_grow_until_they_agree(ranks):
    chance = random.Random(9)
    text = prose(chance, 3000)
    coder = bpe.Coder(ranks)
    exact = coder.plain(text).tolist()
    assert coder.encode(text).tolist() == exact and len(bpe.chunks(text)) > 5 and not coder.grown
    # Spoil the inner word that a chunk shows its neighbour: the stretch takes the whole chunk in.
    for spoilt in bpe.chunks(text)[1:4]:
        chunk = coder.known[spoilt]
        chunk.ids = chunk.ids.copy()
        chunk.ids[chunk.heads[0][1] : chunk.heads[1][1]] += 1
    assert coder.encode(text).tolist() == exact
    sliding = Sliding(ranks)
    assert sliding.encode(text).tolist() == sliding.plain(text).tolist() and sliding.grown


def test_chunks_used_last_stay_known(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "_CACHED_CHARS", 5000)
    chance = random.Random(10)
    coder = bpe.Coder(ranks)
    for _ in range(30):
        text = prose(chance, 300)
        assert coder.encode(text).tolist() == coder.plain(text).tolist()
        assert coder.held == sum(map(len, coder.known)) <= 5000 + bpe.MOST


def cut_cost(scores, ties, kept):
    cost = sum(s for s, k in zip(scores, kept, strict=True) if s > 0 and not k)
    cost -= sum(s for s, k in zip(scores, kept, strict=True) if s < 0 and k)
    return cost + sum(c for a, b, c in ties if kept[a] != kept[b])


def test_cut_is_a_cheapest_labelling():
    chance = random.Random(10)
    for _ in range(150):
        n = chance.randrange(1, 9)
        scores = [chance.choice([0.0, chance.uniform(-5, 5)]) for _ in range(n)]
        ties = [(i - 1, i, chance.uniform(0, 3)) for i in range(1, n)]
        ties += [(a, b, chance.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if chance.random() < 0.3]
        best = min(cut_cost(scores, ties, kept) for kept in itertools.product([True, False], repeat=n))
        assert cut_cost(scores, ties, mincut.minimum_cut(scores, ties)) == pytest.approx(best, abs=1e-6)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1><p>We write about many things, every day of the week.</p></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></nav>
<div class="cookie-notice">This site uses cookies, as all sites do. Please accept them.</div>
<article><header><h1>Caf&eacute; &amp; bar</h1></header>
<p>First paragraph  with
several   words, a <a href=x>link</a> and <b>more</b>.<p>Short.<br>Line.
<form><label>Mail</label><input name=m><button>Send</button></form>
<ul><li>An item of the article's list</li><li>Another one</ul>
<aside>Read also: ten other stories that you may like.</aside>
<p>The last paragraph &lt;of the text&gt; is here.</p>
<section class="comments"><h3>Comments</h3><p>I do not agree with any of this, says a reader at length.</p></section>
</article><div class="ad">Buy this, it is the very best of all things.</div>
<footer>&copy; someone, all rights reserved.</footer></body></html>"""


def test_main_text_of_a_page_with_everything():
    assert mincut.main_text(PAGE) == "\n".join(
        [
            "Café & bar",
            "First paragraph with several words, a link and more.",
            "Short. Line.",
            "An item of the article's list",
            "Another one",
            "The last paragraph <of the text> is here.",
        ]
    )


LONG = "This sentence of the article goes on and on, " + "with ever more of its words, " * 7 + "until it ends."


@pytest.mark.parametrize(
    "wrapper",
    [
        'div style="overflow:hidden"',
        'div title="hidden gems"',
        "div title='display:none' data-hidden=1 aria-hidden=false",
        'div class="content has-sidebar"',
        'div class="content sidebar"',
        'div class="no-sidebar"',
        'div class="layout-sidebar"',
        'div class="with-left-sidebar"',
        'div id="cookie-layer"',
        'section class="post-header"',
    ],
)
@pytest.mark.parametrize("inner", ["article", "div"])
def test_wrappers_of_whole_articles_keep_them(wrapper, inner):
    page = f"<body><nav><a href=/>Home</a></nav><{wrapper}><{inner}>" + f"<p>{LONG}</p>" * 3 + f"</{inner}></{wrapper.split()[0]}></body>"
    assert mincut.main_text(page) == "\n".join([LONG] * 3)


@pytest.mark.parametrize("name", ["article-header", "page-header", "entry-header"])
def test_headline_named_header_stays(name):
    assert mincut.main_text(f'<h1 class="{name}">A fine headline</h1><p>{LONG}</p>') == f"A fine headline\n{LONG}"


@pytest.mark.parametrize(
    "wrapper",
    [
        "div hidden",
        "div style='color:red; display : none'",
        'div class="sidebar"',
        'div class="sidebar has-content-links"',
        'section class="post-comments"',
        'div class="content-sidebar"',
        'div class="content" role="navigation"',
    ],
)
@pytest.mark.parametrize("around", ["article", "div"])
def test_boilerplate_beside_the_article_still_goes(wrapper, around):
    article = f"<{around}>" + f"<p>{LONG}</p>" * 2 + f"</{around}>"
    page = f"{article}<{wrapper}>" + f"<p>{LONG.replace('article', 'rest')}</p>" * 2 + f"</{wrapper.split()[0]}>"
    assert mincut.main_text(page) == "\n".join([LONG] * 2)


def test_long_comments_do_not_become_the_article():
    comments = "".join(f'<article class="comment-body"><p>{LONG.replace("article", "comment")}</p></article>' for _ in range(30))
    page = f'<div class="post"><p>{LONG}</p><p>{LONG}</p></div><div class="comments-area">{comments}</div>'
    assert mincut.main_text(page) == "\n".join([LONG] * 2)


@pytest.mark.parametrize(
    "between",
    [
        '<svg class="i"/>',
        '<svg class="i"><path d="M0"/><title/><text>no</text></svg>',
        "<svg><foreignObject><div><p>no</p></div></foreignObject></svg>",
        "<svg><g>no<svg>no</svg>no</g></svg>",
        "<svg>",
        "<svg><path/></p>",
        "<math/>",
        "<math>",
        "<object data=x>",
        "<noscript>",
        "<noscript><img src=x>no</noscript>",
        "<select name=a>",
        "<select name=a><option>no</select>",
        "<select-box>",
    ],
)
@pytest.mark.parametrize("after", ["", "<svg>no</svg><select><option>no</select><noscript>no</noscript>"])
def test_embedded_elements_end_where_they_end(between, after):
    page = f"<article><p>One of the sentences.</p>{between}<p>Two of the sentences.</p>{after}<p>Three of them.</p></article>"
    assert mincut.main_text(page).split("\n") == ["One of the sentences.", "Two of the sentences.", "Three of them."]


def test_formulas_objects_and_drawings_within_a_paragraph():
    page = "<p>So <math><mi>x</mi><mspace/><mo>=</mo><mn>2</mn></math> holds, <svg><foreignObject><p>no</p></foreignObject></svg>and <object><param name=a>a plain text</object> stays as it is.</p>"
    assert mincut.main_text(page) == "So x=2 holds, and a plain text stays as it is."


def test_broken_markup_and_odd_pages(spark):
    long = "<article>" + "<p>Some words of a long page." * 5000
    pages = [None, "", "<p", "<<<>>>", "<!-- open", "<script>x", "plain text without any markup at all, but a sentence.", long, "<a href='x", "</p></div>"]
    frame = spark.createDataFrame([(i, p, "u", i) for i, p in enumerate(pages)], "page_id bigint, html string, url string, n_chars int")
    found = {r["page_id"]: r for r in mincut.extracted(frame).collect()}
    assert len(found) == len(pages)
    assert found[0]["text"] == found[1]["text"] == "" and found[0]["n_chars"] == 0
    assert found[6]["text"] == pages[6]
    assert found[7]["text"].count("\n") == 4999
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert mincut.extracted(frame.where("false")).count() == 0


def test_articles_of_the_pages_table(spark):
    import html
    import re

    rows = mincut.extracted(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    for row in rows:
        inner = re.search(r"<article>(.*)</article>", row["html"], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        lines = (" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts)
        assert row["text"] == "\n".join(x for x in lines if x)
