"""Text quality learned from positives only: trusted good documents against unlabelled ones, whose share of good is estimated.

Labels of bad documents are not used. The unlabelled documents are a mixture of good and bad; with the share of good ones
known, the risk on bad documents is what the unlabelled ones show less what the good ones among them account for. That
difference can't be negative, so training steps back where it becomes so (Kiryo et al., 2017).
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from martloom.llm.text import documents, remainder

POSITIVES = 6_000  # trusted good documents, at most
UNLABELLED = 12_000  # unlabelled documents, at most
PREDICTED = 0.3
WINDOW = 400  # words among which repeated ones are counted
PIECE = 1 << 22  # characters of a text looked at together
STEPS = 1_000
FOLD_STEPS = 150  # of the models that only rank, for the prior
RATE = 0.03
DECAY = 1e-4
FOLDS = 4
LEAST = 0.5  # of the positives, that a cut of the prior estimate keeps at least

# kinds of bytes: blanks, line ends, a-z, A-Z, digits, stops, shouts, quotes and brackets, other symbols, controls, two
# groups beyond ASCII; what follows what is the style of a text
KINDS = (b" ", b"\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"'\"()[]{}-", b"#$%&*+/<=>@\\^_`|~")
CONTROL, LATIN, BEYOND = len(KINDS), len(KINDS) + 1, len(KINDS) + 2
SORTS = BEYOND + 1
KIND_OF = np.full(256, CONTROL, np.uint8)
KIND_OF[0x80:], KIND_OF[[0xC2, 0xC3]] = BEYOND, LATIN
for _kind, _bytes in enumerate(KINDS):
    KIND_OF[list(_bytes)] = _kind
FEATURES = SORTS * SORTS + 4


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of PIECE characters, longer by the word that the cut would split."""
    at = 0
    while at < len(text):
        stop = text.find(" ", at + PIECE)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop]
        at = stop


def style(text: str | None) -> np.ndarray:
    """Roots of the shares of each pair of neighbouring byte kinds; then repetition and size of the words.

    Shares of words that are like the one before and that are new within WINDOW words, logarithms of mean word length and
    of the number of words. Null is as empty.
    """
    pairs, words, chars, same, new = np.zeros(SORTS * SORTS), 0, 0, 0, 0
    for piece in pieces(text or ""):
        kinds = KIND_OF[np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8)]
        pairs += np.bincount(kinds[:-1] * np.uint8(SORTS) + kinds[1:], minlength=SORTS * SORTS)
        found = piece.split()
        words += len(found)
        chars += sum(map(len, found))
        same += sum(map(eq, found, found[1:]))
        new += sum(len(set(found[i : i + WINDOW])) for i in range(0, len(found), WINDOW))
    n = max(words, 1)
    return np.concatenate([np.sqrt(pairs / max(pairs.sum(), 1)), [same / n, new / n, np.log1p(chars / n), np.log1p(words)]])


@F.pandas_udf(ArrayType(DoubleType()))
def styles(texts: pd.Series) -> pd.Series:
    return pd.Series([style(t) for t in texts])


class Linear:
    """A logistic score of scaled features."""

    def __init__(self, rows: np.ndarray) -> None:
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
        self.weights, self.bias = np.zeros(rows.shape[1]), 0.0

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -10, 10)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return self.scaled(rows) @ self.weights + self.bias

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -50, 50)))

    def fit(self, slope, rows: np.ndarray, steps: int) -> None:
        """Adam on whole samples; `slope` gives the derivative of the risk by each row's logit."""
        x = np.column_stack([self.scaled(rows), np.ones(len(rows))])
        w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
        for t in range(1, steps + 1):
            g = slope(x @ w) @ x + DECAY * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.weights, self.bias = w[:-1], w[-1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def apart(good: np.ndarray, web: np.ndarray) -> Linear:
    """What tells trusted documents from unlabelled ones, both counting alike."""
    model = Linear(np.concatenate([good, web]))
    y = np.repeat([1.0, 0.0], [len(good), len(web)])
    weight = np.repeat([0.5 / len(good), 0.5 / len(web)], [len(good), len(web)])
    model.fit(lambda z: weight * (sigmoid(z) - y), np.concatenate([good, web]), FOLD_STEPS)
    return model


def class_prior(good: np.ndarray, web: np.ndarray) -> float:
    """Share of good documents among unlabelled ones.

    In any part of the space the unlabelled share is at least the prior times the share of the good, and comes down to
    that where no bad ones are. Parts are cuts by the scores of `apart`, taken on folds it was not fitted to; the lowest
    ratio counts, of cuts that keep so many of the good that chance has little to take off.
    """
    folds = min(FOLDS, len(good), len(web))
    if folds < 2:
        return 0.5
    g, u = np.zeros(len(good)), np.zeros(len(web))
    for k in range(folds):
        a, b = np.arange(len(good)) % folds == k, np.arange(len(web)) % folds == k
        model = apart(good[~a], web[~b])
        g[a], u[b] = model.logits(good[a]), model.logits(web[b])
    cut = np.quantile(g, np.linspace(0, 1 - LEAST, 81))
    kept = 1 - np.searchsorted(np.sort(g), cut) / len(g)
    seen = 1 - np.searchsorted(np.sort(u), cut) / len(u)
    return float(np.clip((seen / kept).min(), 0.01, 0.99))


def unbiased(good: np.ndarray, web: np.ndarray, prior: float) -> Linear:
    """Least non-negative unbiased risk with the logistic loss, so that scores are shares of good documents."""
    model = Linear(np.concatenate([good, web]))
    n, m = len(good), len(web)

    def slope(z: np.ndarray) -> np.ndarray:
        p = sigmoid(z)
        as_bad = np.logaddexp(0, z)
        bad = np.concatenate([-prior * p[:n] / n, p[n:] / m])
        if as_bad[n:].mean() - prior * as_bad[:n].mean() < 0:
            return -bad  # fewer bad documents than none: step back
        return bad + np.concatenate([prior * (p[:n] - 1) / n, np.zeros(m)])

    model.fit(slope, np.concatenate([good, web]), STEPS)
    return model


class Constant:
    def __init__(self, share: float) -> None:
        self.share = share

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.full(len(rows), self.share)


def learning(ids: DataFrame) -> DataFrame:
    return ids.filter(F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0)).distinct()


def sample(docs: DataFrame, ids: DataFrame, size: int) -> np.ndarray:
    """Features of at most `size` of the ids, drawn by hash. Texts stay where they are; a row per id reaches the driver."""
    drawn = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size).withColumnRenamed("doc_id", "_id")
    rows = docs.join(F.broadcast(drawn), docs["doc_id"] == drawn["_id"]).select("_id", styles("text").alias("style"))
    found = rows.groupBy("_id").agg(F.min("style").alias("style")).orderBy(F.xxhash64("_id"), "_id").select("style").collect()
    return np.array([r[0] for r in found]).reshape(len(found), FEATURES)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[Linear | Constant, float]:
    """The model and the class prior it was fitted with."""
    known = labels.filter("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = sample(docs, learning(known.filter("quality = 1").select("doc_id")), positives)
    web = sample(docs, learning(docs.select("doc_id")), unlabelled)
    if not len(good) or not len(web):
        return Constant(0.5), 0.5
    prior = class_prior(good, web)
    return unbiased(good, web, prior), prior


def quality(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """`docs` with quality_score, from 0 to 1.

    Good documents are learned from labels of 1 whose crc32(doc_id as text) mod 5 is not 0, unlabelled ones from the same
    part of `docs`, labelled or not; both samples are bounded and drawn by hash. The score sees the text only. Null texts
    count as empty and get the score of what little they show. An id with labels 0 and 1 is not trusted; null labels and
    ids are skipped; rows that repeat an id enter the sample once. With no good documents every score is 0.5. An empty
    table gives an empty result; a column of `docs` named quality_score is replaced, others stay.
    """
    model, _ = train(docs.select("doc_id", "text"), labels, positives, unlabelled)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([style(t) for t in texts]).reshape(len(texts), FEATURES)
        return pd.Series(shared.value.scores(rows))

    return docs.withColumn("quality_score", score("text"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = F.col("quality_score")
    return found.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), score.alias("score"), (score >= PREDICTED).cast("int").alias("predicted")
    )
