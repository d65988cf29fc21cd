"""Spelling variants against every one-edit word of every word."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from martloom.llm import spelling
from martloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
NAMES = ("form", "root", "n", "n_near", "form_n")


def by_listing(rows):
    """The contract word for word."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            counts[w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    form, near = {}, {}
    for w in n:
        if len(w) < 100:
            pieces = [(w[:i], w[i:]) for i in range(len(w) + 1)]
            letters = {c for v in n for c in v}
            edits = {a + b[1:] for a, b in pieces} | {a + c + b[k:] for a, b in pieces for c in letters for k in (0, 1)}
        else:
            edits = {v for v in n if one_edit(w, v)}
        near[w] = sorted((v for v in edits if v in n and v != w), key=lambda v: (-n[v], v))
        form[w] = near[w][0] if near[w] and n[near[w][0]] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[same + 1 :] == b[same + 1 :] if len(a) == len(b) else a[same:] == b[same + 1 :])


def found(docs, crowd=spelling.CROWD):
    rows = spelling.spelling_variants(docs, crowd).collect()
    out = {r.word: tuple(r[c] for c in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("size", [1, 2, 5, 9])
def test_hashes_of_all_edits(size):
    rnd = np.random.default_rng(size)
    digits = rnd.integers(1, len(spelling.SYMBOLS) + 1, (7, size)).astype(np.uint64)

    def value(row):
        return sum(int(d) * pow(spelling.BASE, i, 1 << 64) for i, d in enumerate(row)) % (1 << 64)

    for row, hashes in zip(digits.tolist(), spelling.neighbourhood(digits).tolist(), strict=True):
        edits = [row] + [row[:i] + row[i + 1 :] for i in range(size)]
        for d in range(1, len(spelling.SYMBOLS) + 1):
            edits += [row[:i] + [d] + row[i + 1 :] for i in range(size)] + [row[:i] + [d] + row[i:] for i in range(size + 1)]
        assert set(hashes) == {value(e) for e in edits}


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.word: tuple(r[c] for c in NAMES) for r in QUERIES["op12_spelling_variants"](spark, SMALL).collect()}
    assert got == by_listing(rows) and any(v[0] for v in got.values())


@pytest.mark.parametrize("crowd", [0, 2, 1_000_000])
def test_crowded_places_and_odd_rows(spark, crowd):
    """Words of few letters: reduced words stand for many, edits stand at the ends and in the middle; long words among them."""
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abéÿÀ×") for _ in range(rnd.randint(4, 7))) for _ in range(300)]
    long = "".join(rnd.choice("ab") for _ in range(3_000))
    words += [long, long[1:], long[:1500] + "é" + long[1500:], long[:-1] + "ÿ", "z" + long]
    rows = [(i, " ".join(rnd.choices(words, k=20))) for i in range(300)]
    rows += [(i, f"{w}-{w.upper() if w.isascii() else w}_{w}9") for i, w in enumerate(words)]
    rows += [(None, None), (None, ""), (5, None), (None, "hello World hello hello worlds WORLDS worlds"), (3, "!"), (3, "!")]
    rows += [(900, "repeated rows"), (900, "repeated rows"), (900, "repeated rows"), (901, "ñ" * 9 + " " + "ñ" * 9 + "." + "ñ" * 9)]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, n int, word string")
    got = found(docs, crowd)
    assert got == by_listing(rows)
    assert long in got and got[long][3] >= 3


def test_forms_are_followed_to_the_end(spark):
    rows = [(i, " ".join(["abcdeg"] * 3 + ["abcdef"] * 6 + ["abcdefh"] * 12 + ["abcefh"] * 24 + ["abcefi"] * 48)) for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = found(docs), by_listing(rows)
    assert got == want and got["abcdeg"][1] == "abcefi"


def test_texts_longer_than_a_listing(spark, monkeypatch):
    rows = [(1, "alpha beta gamma alphas " * 50), (2, "alpha alphas Alpha")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = by_listing(rows)
    monkeypatch.setattr(spelling, "LONG", 10)
    direct = Counter()
    for r in rows:
        direct.update(spelling.runs_of(*r))
    assert {w: n for w, n in direct.items() if len(w) >= 5 and n >= 3} == {w: v[2] for w, v in want.items()}
    assert found(docs) == want
    assert found(docs.limit(0)) == {}


def test_a_run_loses_one_letter_only(spark):
    """A run that loses a letter and becomes another run of its text, which loses a letter too."""
    rnd = random.Random(5)

    def bent(doc_id, w):
        h = zlib.crc32(f"{doc_id}:{w}".encode())
        return w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]

    def chain():
        while True:
            doc_id, w = rnd.randrange(1000), "".join(rnd.choices("abcdefgh", k=7))
            if bent(doc_id, w) != w:
                for longer in (w[:i] + c + w[i:] for i in range(8) for c in "abcdefgh"):
                    if bent(doc_id, longer) == w:
                        return doc_id, longer, w

    chains = [chain() for _ in range(5)]
    rows = [(d, f"{a} {b} {a} {b} {a} {b} {a}") for d, a, b in chains] + [(d, f"{b} {a} {b} {b} {a} {a}") for d, a, b in chains]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(docs)
    assert got == by_listing(rows) and all(got[b][2] >= 7 for _, _, b in chains)
