"""The whole pipeline against a plain version of its five stages."""

from __future__ import annotations

import hashlib
import random
import re

import corpus_pipeline
import duckdb
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from vigilmart.llm import secretscan
from vigilmart.llm.catalog import ORACLES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def without_copies(rows):
    """Rows whose id is the smallest of the texts they are linked with."""
    sets = {key: shingles(text) for key, text, _ in rows}
    smallest = {key: key for key in sets}
    moved = True
    while moved:
        moved = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= 80 * len(sets[a] | sets[b]) and smallest[b] < smallest[a]:
                    smallest[a], moved = smallest[b], True
    return [r for r in rows if smallest[r[0]] == r[0]]


def without_secrets(text):
    if not text:
        return text
    gone = [False] * len(text)
    for rule in secretscan.RULES:
        for m in re.finditer(rule.regex, text):
            if len(m[rule.group]) >= rule.least:
                gone[m.start() : m.end()] = [True] * (m.end() - m.start())
    out, at = [], 0
    while at < len(text):
        if gone[at]:
            out.append("[secret]")
            while at < len(text) and gone[at]:
                at += 1
        else:
            out.append(text[at])
            at += 1
    return "".join(out)


def corpus():
    chance = random.Random(12)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("tan", "ler", "mos", "vin", "dar")]
    prose = lambda n: " ".join(chance.choices(words, k=n)) + "."
    rows, toxic = [], set()
    for i in range(240):
        source = "hot" if i % 3 else chance.choice(["a", "b", None])
        text = prose(chance.randrange(8, 60))
        if i % 8 == 0:
            toxic.add(i)
            text = f"vileword {text} grimslur scumtalk"
        elif i % 8 == 1:
            text = rows[i - 6][1] if i > 10 and i - 6 not in toxic else text  # an exact copy
        elif i % 8 == 2 and i > 10:
            text = rows[i - 7][1] + " more"  # a near copy, if long enough
        elif i % 8 == 3:
            text += f' api_key = "{"".join(chance.choices("abcdef0123456789", k=40))}" and ' + prose(5) + " AKIA" + "A1" * 9
        rows.append((i, text, source))
    rows += [(500, "", "a"), (501, None, "b"), (502, "   \n", None), (503, "one", "a"), (504, "<|endoftext|> é 東京 " * 30, "b")]
    return rows, toxic


def test_run_equals_a_plain_version(spark, tmp_path):
    rows, toxic = corpus()
    table = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    table.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i, _, _ in rows], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    kept = without_copies([r for r in rows if r[0] not in toxic])
    assert 100 < len(kept) < 200
    clean = [(key, without_secrets(text), source) for key, text, source in kept]
    assert sum("[secret]" in (t or "") for _, t, _ in clean) > 10
    documents = pd.DataFrame(clean, columns=["doc_id", "text", "source"])
    with duckdb.connect() as con:
        con.register("documents", documents)
        taken = con.execute(f"SELECT doc_id, taken // greatest(size, 1) FROM ({ORACLES['op5_mixing']}) WHERE size > 0").fetchall()
    times = dict(taken)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, sizeless = [], {}
    for key, text, _ in clean:
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = (key, len(ids), ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        if key in times:
            expected += [row] * times[key]
        else:
            sizeless[key] = row

    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    got = [tuple(r) for r in found.collect()]
    assert sorted((r for r in got if r[0] in times), key=repr) == sorted(expected, key=repr)
    # What copies of a text without words the mix takes can't be told from its words.
    rest = [r for r in got if r[0] not in times]
    assert all(r == sizeless[r[0]] for r in rest) and all(rest.count(r) <= 2 for r in rest)
