"""Quality from positives and unlabelled documents: held-out accuracy, the class prior, features by hand, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import quality
from martloom.llm.queries import QUERIES


def auc(score, label):
    """Share of (good, bad) pairs in the right order; ties count half."""
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    for s in np.unique(score):
        order[score == s] = order[score == s].mean()
    good, bad = (label == 1).sum(), (label == 0).sum()
    return (order[label == 1].sum() - good * (good + 1) / 2) / (good * bad)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op13_quality"](spark, folder)
    known = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    got = rows.toPandas()
    assert len(got) == 10_000 and got.doc_id.is_unique and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(known.toPandas())
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.97
    assert held[held.quality == 1].predicted.mean() > 0.99 and held[held.quality == 0].predicted.mean() < 0.15


def test_bad_labels_are_not_needed(spark):
    """Labels of bad and of held-out documents can go, or be wrong, without a change of any score."""
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    other = labels.withColumn("quality", F.when(F.expr("crc32(string(doc_id)) % 5 = 0"), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = other.filter("quality = 1 OR crc32(string(doc_id)) % 5 = 0").withColumn("toxic", 1 - F.col("toxic"))
    score = lambda t: {r.doc_id: r.quality_score for r in quality.quality(docs, t).select("doc_id", "quality_score").collect()}
    first = score(labels)
    assert score(labels) == pytest.approx(first, abs=1e-9) and score(other) == pytest.approx(first, abs=1e-9)


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.85])
def test_prior_and_risk_on_known_mixtures(prior):
    rnd = np.random.default_rng(5)
    good = rnd.normal(0, 1, (3_000, 4))
    bad_share = rnd.random(6_000) > prior
    web = rnd.normal(0, 1, (6_000, 4)) + bad_share[:, None] * np.array([4, 0, 0, 0])
    assert abs(quality.class_prior(good, web) - prior) < 0.06
    p = quality.unbiased(good, web, prior).scores(web)
    assert abs(p.mean() - prior) < 0.05 and ((p >= 0.5) == ~bad_share).mean() > 0.95


def test_style_by_hand(monkeypatch):
    text = "Ab ab\nAB! 12"
    kinds = [int(quality.KIND_OF[b]) for b in text.encode()]
    want = np.zeros((quality.SORTS, quality.SORTS))
    for a, b in zip(kinds, kinds[1:], strict=False):
        want[a, b] += 1
    got = quality.style(text)
    assert np.allclose(got[:-4], np.sqrt(want.ravel() / want.sum()))
    assert np.allclose(got[-4:], [0, 1, np.log1p(9 / 4), np.log1p(4)])
    assert np.allclose(quality.style("a a b a")[-4:-2], [1 / 4, 2 / 4])
    assert not quality.style(None).any() and (quality.style("") == quality.style(None)).all()
    long = "Some words, again some words.\n" * 200 + "x" * 500
    whole = quality.style(long)
    monkeypatch.setattr(quality, "PIECE", 997)
    assert sum(map(len, quality.pieces(long))) == len(long) and "".join(quality.pieces(long)) == long
    assert np.allclose(quality.style(long), whole, atol=0.05)


LONG = "word " * 300_000
ODD = [
    (1, None), (2, ""), (3, "  \n"), (4, LONG), (5, "x" * 400_000), (6, "the same"), (6, "the same"), (7, "é日本😀"), (None, "no id"), (None, None),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 0.5, 1, "x") for r in ODD], "doc_id long, text string, quality_score double, quality int, style string")
    labels = spark.createDataFrame([(4, 1), (6, 1), (6, 1), (7, 1), (7, 0), (3, None), (None, 1), (99, 1)], "doc_id long, quality int")
    got = quality.quality(docs, labels)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = got.collect()
    assert len(rows) == len(ODD) and all(0 <= r.quality_score <= 1 for r in rows)
    same = {r.quality_score for r in rows if r.text in (None, "")}
    assert len(same) == 1 and len({r.quality_score for r in rows if r.doc_id == 6}) == 1
    assert {r.quality_score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(docs.limit(0), labels).count() == 0
    assert {r.quality_score for r in quality.quality(docs.filter("doc_id IS NULL"), labels).collect()} == {0.5}
