"""Repeated passages against a count of every chunk, by hand."""

import random
from collections import defaultdict

import pytest

from martloom.llm import substring_dedup as dedup

SMALL = "/root/testdata/sf0.001"


def by_hand(rows, shortest, within):
    """Passages of (doc_id, text) rows with ids that are all different."""
    places = defaultdict(list)
    chunks = {}
    for i, text in ((i, t) for i, t in rows if t):
        s, e, d = dedup.chunks_of(text)
        chunks[i] = [(a, b, tuple(x)) for a, b, x in zip(s, e, d.tolist(), strict=True)]
        for a, _, x in chunks[i]:
            places[x].append((i, a))
    repeated = {x for x, at in places.items() if len(at) > 1 and (within or len({i for i, _ in at}) > 1)}
    out = []
    for i, own in chunks.items():
        stretch = []
        for a, b, x in [*own, (None, None, None)]:
            if x in repeated:
                stretch.append((a, b, x))
                continue
            if stretch and stretch[-1][1] - stretch[0][0] >= shortest:
                gone = [min(places[x]) != (i, a) for a, _, x in stretch]
                cut = [0, *(k for k in range(1, len(gone)) if gone[k] != gone[k - 1]), len(gone)]
                for k, m in zip(cut, cut[1:], strict=False):
                    part = stretch[k:m]
                    alone = sum(len({j for j, _ in places[x]}) == 1 for *_, x in part)
                    first = min(min(places[x])[0] for *_, x in part)
                    out.append((i, part[0][0], part[-1][1], m - k, sum(gone[k:m]), alone, first, not gone[k]))
            stretch = []
    return sorted(out)


@pytest.mark.parametrize("within", [False, True])
def test_every_passage(spark, within):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeéß日") for _ in range(rnd.randint(1, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    shared = [some(30) for _ in range(6)]
    texts = [" ".join(rnd.choice([rnd.choice(shared), some(15)]) for _ in range(rnd.randint(0, 8))) for _ in range(60)]
    rows = list(enumerate([*texts, shared[0] * 3, "x" * 900, None, "", texts[5], texts[5], "x" * 700 + some(9)]))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in dedup.repeated_passages(frame, shortest=40, within=within).collect())
    assert got == by_hand(rows, 40, within) and len(got) > 100


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in dedup.op5_substring_dedup(spark, SMALL).collect())
    assert got == by_hand(rows, dedup.SHORTEST, True) and any(r[5] == r[3] for r in got)
