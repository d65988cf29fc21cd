"""Contract columns that SQL has no short form for, word for word over a whole given table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from martloom.llm import langid, language_model
from martloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def answers(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SMALL).collect()}


@pytest.mark.parametrize("at_hand", [0, 50, 200_000])
def test_base_scores(spark, docs, monkeypatch, at_hand):
    """The same whether words are at hand or looked up."""
    monkeypatch.setattr(language_model, "FREQUENT", at_hand)
    words = {i: BLANK.findall((d.text or "").translate(LOWER)) for i, d in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    got = answers(spark, "op8_language_model")
    assert set(got) == set(docs)
    for i, r in got.items():
        tokens = [*words[i], None]
        base = math.fsum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0


def test_base_phrases(spark, docs):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    got = answers(spark, "op7_licenses")
    some = 0
    for i, d in docs.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (d.text or "").translate(LOWER))
        places = [(at, label) for p, label in phrases.items() for at in range(len(words)) if words[at : at + p.count(" ") + 1] == p.split()]
        starts, r = [a for a, _ in places], got[i]
        assert (r.n_words, r.n_base) == (len(words), len(starts))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        labels = sorted({x for _, x in places})
        assert r.base_labels == ",".join(labels) and set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        some += bool(starts)
    assert some


def test_fingerprints_and_components(spark, docs):
    prints = {}
    for i, d in docs.items():
        words = BLANK.findall((d.text or "").translate(LOWER))
        shingles = [" ".join(words[a : a + 3]) for a in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = answers(spark, "op10_simhash")
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{p:016x}", find(i)) for i, p in prints.items()}
    assert len({find(i) for i in prints}) < len(prints)


def test_base_secrets(spark, docs):
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    got = answers(spark, "op1_secrets")
    for i, d in docs.items():
        text, r = d.text or "", got[i]
        kinds = [
            [m.span() for m in assign.finditer(text) if len(m[2]) >= 8], [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16],
            [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32],
        ]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(len, kinds))
        base = sorted((a, k, b) for k, spans in enumerate(kinds) for a, b in spans)
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_languages_by_hand(spark):
    """Words first, then the mean of the longest known n-grams, from counts over the learning rows."""
    rnd = random.Random(8)
    letters = {"aa": "abcdé", "bb": "cdefg", "cc": "日本cg"}
    word = lambda lang: "".join(rnd.choice(letters[lang]) for _ in range(rnd.randint(1, 7)))
    rows = [(i, " ".join(word(lang) for _ in range(rnd.randint(1, 12))), lang) for i in range(120) for lang in [rnd.choice("aabbcc") * 2]]
    learn, ask = rows[:70], [*rows[70:], (900, None, "aa"), (901, "12 !", "bb"), (902, "zzz", "cc")]
    shape = "doc_id long, text string, lang string"
    got = langid.languages(spark.createDataFrame(ask, shape), spark.createDataFrame([*learn, (903, "x", None)], shape)).collect()
    counts = defaultdict(lambda: defaultdict(Counter))
    for _, text, lang in learn:
        for w in text.split():
            counts[0][w][lang] += 1
            for order in langid.ORDERS:
                framed = f"<{w}>" if order > 1 else w
                for a in range(len(framed) - order + 1):
                    counts[order][framed[a : a + order]][lang] += 1
    langs = sorted({lang for *_, lang in learn})
    totals = {o: {x: sum(c[x] + 0.5 for c in of.values()) for x in langs} for o, of in counts.items()}

    def evidence(w):
        if w in counts[0]:
            return {x: math.log((counts[0][w][x] + 0.5) / totals[0][x]) for x in langs}
        for order in langid.ORDERS:
            framed = f"<{w}>" if order > 1 else w
            known = [g for a in range(len(framed) - order + 1) if (g := framed[a : a + order]) in counts[order]]
            if known:
                logs = {x: [math.log((counts[order][g][x] + 0.5) / totals[order][x]) for g in known] for x in langs}
                return {x: sum(v) / len(v) * order / 5 for x, v in logs.items()}
        return dict.fromkeys(langs, 0.0)

    want = {}
    for i, text, _ in ask:
        words = re.findall(r"[^\W\d_]+", text or "")
        sums = {x: sum(evidence(w)[x] for w in words) for x in langs}
        best = max(langs, key=lambda x: (sums[x], [-ord(c) for c in x]))
        want[i] = (best, 1 / sum(math.exp(v - sums[best]) for v in sums.values())) if words else ("und", 0.0)
    assert {r.doc_id: r.lang_pred for r in got} == {i: w[0] for i, w in want.items()}
    assert all(abs(r.score - want[r.doc_id][1]) < 1e-9 for r in got)


def test_tables_are_shared_out(spark, monkeypatch):
    assert langid.fair_shares({"a": 5, "b": 50, "c": 60}, 200) == {"a": 5, "b": 50, "c": 60}
    assert langid.fair_shares({"a": 5, "b": 50, "c": 60}, 65) == {"a": 5, "b": 30, "c": 30}
    monkeypatch.setattr(langid, "WORDS", 30)
    rows = [(i, " ".join(f"{c}{'xyz'[i % 3]}{'pqrs'[i % 4]}{'uvw'[j]}" for j in range(3)), lang) for i in range(60) for lang, c in (("en", "a"), ("ja", "日"))]
    rows += [(99, "one two", "rare")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang", "doc_id")
    of = Counter("ja" if w.startswith("日") else "en" if w.startswith("a") else "rare" for w in model.rows[0])
    assert of == {"en": 14, "ja": 14, "rare": 2}
