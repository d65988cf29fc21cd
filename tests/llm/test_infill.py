"""Fill-in-the-middle against tokens cut by a regex, and back to the text."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.llm import infill

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LETTERS = st.text(st.sampled_from("ab \t\n\v\f\r\x08\x0e\x1f!\x00\x7f\x80\x85\xa0é日本😀 <PSM>"), max_size=60)


def by_regex(doc_id, text):
    """The contract word for word."""
    text, h = text or "", hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = TOKEN.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(LETTERS, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), max_size=12))
def test_cuts_of_batches(rows):
    body = [t.encode() for t, _, _ in rows]
    offsets = np.cumsum([0, *map(len, body)])
    h1, h2 = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
    got = list(zip(*(c.tolist() for c in infill.cuts(np.frombuffer(b"".join(body), np.uint8), offsets, h1, h2)), strict=True))
    want = []
    for text, one, two in rows:
        units = TOKEN.findall(text)
        a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
        want.append((len(units), len("".join(units[:a])), len("".join(units[a:b]))))
    assert got == want


def test_every_byte_is_told_from_a_space():
    data = np.arange(256, dtype=np.uint8)
    found = np.flatnonzero(infill.spaces(data.view("<u8")).view(np.uint8))
    assert found.tolist() == [9, 10, 11, 12, 13, 32]


ODD = [
    None, "", " ", "\t\r\n ", "a", " a", "a ", "日本 語😀 ", "x <P> y", "<S>", "a<M", "a < P>", "word " * 60_000, "é" * 100_001,
    " " * 70_000, "the same text", "the same text", "<<P", "S> <M",
]


def test_rows_against_the_contract(spark):
    rows = [(i, t, True, "x") for i, t in enumerate(ODD * 6)] + [(5, "a b c", True, "x"), (5, "a b c", True, "x"), (None, "a b c d", True, "x"), (None, None, True, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n boolean, output string")
    made = infill.infill(docs)
    assert made.columns == [*docs.columns, "infill"]
    c = F.col("infill")
    back = made.select("doc_id", "text", "n", "output", "infill.*", infill.restored(c.output, c.form).alias("back")).collect()
    assert sorted((r[0], r[1], r[2], r[3]) for r in back if r[0] is not None and r[1]) == sorted(r for r in rows if r[0] is not None and r[1])
    forms = set()
    for doc_id, text, _, _, n, form, prefix, middle, output, restored in back:
        assert (n, form, prefix, middle, output) == by_regex(doc_id, text)
        assert restored == (text or "")
        forms.add(form)
    assert forms == {"plain", "psm", "spm"} and len(back) == len(rows)
    assert infill.infill(docs.limit(0)).count() == 0


def test_shares_and_seed(spark):
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("one two three four five six").alias("text"))
    share = {r.form: r["count"] for r in infill.infill(docs).groupBy("infill.form").count().collect()}
    assert abs(share["plain"] - 2_000) < 200 and abs(share["spm"] - 1_600) < 200 and abs(share["psm"] - 400) < 120
    assert infill.infill(docs, transformed=0).filter("infill.form <> 'plain'").count() == 0
    assert infill.infill(docs, seed=1, transformed=100, suffix_first=0).filter("infill.form <> 'psm'").count() == 0
