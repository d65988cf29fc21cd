"""Toxicity by a small convolutional text classifier, trained in numpy on a bounded sample of labelled rows."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.text import WORD, documents, remainder

SAMPLE = 2_000  # labelled documents of each class, at most
APART = 5  # one in so many learning rows is kept out of training, for the thresholds
GRID = 1_000  # steps of the score at which thresholds are tried
BUCKETS = 1 << 18
PREFIXES = (4, 6)  # bytes; words that are bent or put together share a beginning
PARTS = 1 + len(PREFIXES)  # embeddings of a word: its own and those of its beginnings
SIZE = 6  # numbers of each embedding
WORD_SIZE = PARTS * SIZE
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 4
RATE = 0.05
PRIOR_DOCS = 3.0  # documents that smooth a bucket's starting weight
PREDICTED = 0.3
STEP = 64  # documents scored at a time
PIECE = 200_000  # words convolved at a time

_WORDS = re.compile(WORD.encode())


def buckets_of(text: str | None) -> np.ndarray:
    """Hash buckets of each word and of its beginnings, as rows; null has none."""
    words = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())
    n, crc = len(words), zlib.crc32
    parts = [np.fromiter(map(crc, words), np.uint32, n)]
    parts += [np.fromiter((crc(w[:k]) for w in words), np.uint32, n) for k in PREFIXES]
    return np.stack([(p >> np.uint32(3)) % BUCKETS + i * BUCKETS for i, p in enumerate(parts)], axis=1).astype(np.int64)


class Classifier:
    """Hashed embeddings, filters of several widths, the largest answer of each filter, a logistic output."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.embed = draw.normal(0, 0.05, (PARTS * BUCKETS + 1, SIZE)).astype(np.float32)
        self.embed[-1] = 0  # beyond a text's end
        self.filters = [draw.normal(0, 0.2, (w, WORD_SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[:, ::SIZE, :] += 0.5 / len(f)
        self.out = np.full(len(WIDTHS) * FILTERS, 0.3, np.float32)
        self.bias = np.float32(-2.0)
        self.shift = 0.0  # from the classes' shares in the sample to those of all training rows

    def start_from(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        """First number of each bucket: smoothed log ratio of its document frequencies in both classes."""
        seen = np.zeros((2, PARTS * BUCKETS + 1))
        for ids, y in zip(texts, labels):
            seen[int(y), np.unique(ids)] += 1
        toxic, clean = labels.sum(), len(labels) - labels.sum()
        ratio = np.log((seen[1] + PRIOR_DOCS) / (toxic + 2 * PRIOR_DOCS)) - np.log((seen[0] + PRIOR_DOCS) / (clean + 2 * PRIOR_DOCS))
        even = np.log(PRIOR_DOCS / (toxic + 2 * PRIOR_DOCS)) - np.log(PRIOR_DOCS / (clean + 2 * PRIOR_DOCS))
        self.embed[:-1, 0] += np.clip(ratio - even, -4, 4)[:-1].astype(np.float32) / 2

    def _windows(self, ids: np.ndarray) -> list[np.ndarray]:
        """Answers of the filters of each width at every word; windows may reach beyond the end, where all is 0."""
        n, reach = len(ids), max(WIDTHS) - 1
        x = np.zeros((n + reach, WORD_SIZE), np.float32)
        x[:n] = self.embed[ids].reshape(n, WORD_SIZE)
        return [sum(x[k : k + n] @ f[k] for k in range(len(f))) for f in self.filters]

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        """Largest answer of every filter over a text, in pieces that overlap by a window; zeros for no words."""
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        reach = max(WIDTHS) - 1
        for at in range(0, len(ids), PIECE):
            part = self._windows(ids[at : at + PIECE + reach])
            here = min(PIECE, len(ids) - at)
            best = np.maximum(best, np.concatenate([c[:here].max(axis=0) for c in part]))
        return best

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.out + self.bias + self.shift

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = self.logit(np.array([self.pooled(buckets_of(t)) for t in texts])).astype(float)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """Stochastic gradient with Adagrad; only the words of the largest windows receive a gradient."""
        draw = np.random.default_rng(seed)
        g_embed = np.full(self.embed.shape[0], 1e-2, np.float32)
        g_filters = [np.full(f.shape, 1e-2, np.float32) for f in self.filters]
        g_out, g_bias = np.full(self.out.shape, 1e-2, np.float32), 1e-2
        for _ in range(epochs):
            for i in draw.permutation(len(texts)):
                ids = texts[i]
                if not len(ids):
                    continue
                answers = self._windows(ids)
                tops = [c.argmax(axis=0) for c in answers]
                best = np.concatenate([c[t, np.arange(FILTERS)] for c, t in zip(answers, tops)])
                pooled = np.maximum(best, 0)
                z = float(pooled @ self.out + self.bias)
                miss = 1 / (1 + np.exp(-z)) - labels[i]
                back = miss * self.out * (best > 0)
                d_out = miss * pooled
                g_out += d_out**2
                g_bias += miss**2
                self.out -= RATE * d_out / np.sqrt(g_out)
                self.bias -= np.float32(RATE * miss / np.sqrt(g_bias))
                for w, (f, top) in enumerate(zip(self.filters, tops)):
                    d_top = back[w * FILTERS : (w + 1) * FILTERS]
                    for k in range(len(f)):
                        at = top + k
                        inside = at < len(ids)
                        if not inside.any():
                            continue
                        rows = ids[at[inside]]
                        words = self.embed[rows].reshape(-1, WORD_SIZE)
                        d_words = f[k][:, inside].T * d_top[inside, None]
                        d_filter = words.T * d_top[inside]
                        g_filters[w][k][:, inside] += d_filter**2
                        f[k][:, inside] -= RATE * d_filter / np.sqrt(g_filters[w][k][:, inside])
                        flat, d_flat = rows.ravel(), d_words.reshape(-1, SIZE)
                        np.add.at(g_embed, flat, (d_flat**2).mean(axis=1))
                        np.add.at(self.embed, flat, -RATE * d_flat / np.sqrt(g_embed[flat])[:, None])


class Constant:
    """What is left when the sample has one class or none: its share of toxic rows."""

    def __init__(self, share: float):
        self.share = share

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return np.full(len(texts), self.share)


def learning_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, apart) of all labelled ids but those held out; `apart` marks those kept for the thresholds."""
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.filter(remainder("doc_id", 4) != 2).withColumn("apart", remainder("doc_id", APART) == 0)


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[pd.DataFrame, float]:
    """At most `sample` labelled texts of each class, those with the smallest hash of their id, and the share of toxic rows.

    The ids of the sample are at most twice `sample` rows, which bounds what is broadcast to find their texts. Texts are
    taken whole, whatever their length.
    """
    known = learning_rows(labels)
    share = known.agg(F.avg("toxic")).first()[0]
    chosen = [known.filter(~F.col("apart") & (F.col("toxic") == y)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    ids = F.broadcast(chosen[0].union(chosen[1]).select(F.col("doc_id").alias("_id"), "toxic"))
    found = docs.join(ids, docs["doc_id"] == ids["_id"]).filter(F.col("text").isNotNull())
    rows = found.select("_id", "toxic", "text", "lang").orderBy(F.xxhash64("_id"), "_id", "text", "lang").limit(2 * sample)
    return pd.DataFrame([r.asDict() for r in rows.collect()], columns=["_id", "toxic", "text", "lang"]), share or 0.0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Classifier | Constant, dict[str | None, float]]:
    """The model, and for each language a threshold (a language without toxic rows among those kept apart has none)."""
    rows, share = labelled_sample(docs, labels, sample)
    y = rows.toxic.to_numpy(float)
    if len(set(y)) < 2:
        return Constant(share), {}
    texts = [buckets_of(t) for t in rows.text]
    model = Classifier()
    model.start_from(texts, y)
    model.fit(texts, y)
    model.shift = float(np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean())))
    return model, thresholds_of(model, docs, labels)


def thresholds_of(model: Classifier, docs: DataFrame, labels: DataFrame) -> dict[str | None, float]:
    """For each language the threshold with the best F1 on all learning rows kept out of training, in their own class shares.

    They are scored in Spark; what reaches the driver is a count for each language, class and step of the score.
    """
    apart = learning_rows(labels).filter("apart").select(F.col("doc_id").alias("_id"), "toxic")
    rows = docs.join(apart, docs["doc_id"] == apart["_id"]).select("lang", "toxic", scorer(docs.sparkSession, model)(F.col("text")).alias("score"))
    level = F.floor(F.col("score") * GRID).cast("int").alias("level")
    counts: dict[str | None, dict[int, list[int]]] = {}
    for r in rows.select("lang", "toxic", level).groupBy("lang", "toxic", "level").count().collect():
        counts.setdefault(r["lang"], {}).setdefault(r["level"], [0, 0])[r["toxic"]] += r["count"]
    return {lang: best_threshold(of) for lang, of in counts.items() if any(toxic for _, toxic in of.values())}


def best_threshold(counts: dict[int, list[int]]) -> float:
    """Midpoint below the step at which F1 is best, from (clean, toxic) counts of each step of the score."""
    levels = sorted(counts, reverse=True)
    n = np.array([counts[v] for v in levels])
    hits = np.cumsum(n[:, 1])
    at = int((2 * hits / (np.cumsum(n.sum(axis=1)) + hits[-1])).argmax())
    below = levels[at + 1] + 1 if at + 1 < len(levels) else 0
    return (levels[at] + below) / 2 / GRID


def scorer(spark: SparkSession, model: Classifier | Constant):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            whole = batch.tolist()
            yield pd.Series(np.concatenate([shared.value.scores(whole[i : i + STEP]) for i in range(0, len(whole), STEP)] or [np.zeros(0)]))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`docs` with score (0 to 1) and flagged, by the threshold of the row's language (0.3 where it has none).

    Thresholds come from learning rows that the model was not trained on.
    Labels are learned from rows whose crc32(doc_id as text) mod 4 is not 2; the score sees the text only. Null and
    empty texts get the score of no evidence. Repeated labels of an id count once, as toxic if any says so; null labels
    and ids are skipped; with no labels, or of one class only, every score is the share of toxic labels. Columns of
    `docs` named score or flagged are replaced; it needs doc_id, text and lang.
    """
    model, thresholds = train(docs.select("doc_id", "text", "lang"), labels, sample)
    limit = F.lit(PREDICTED)
    for lang, value in sorted(thresholds.items(), key=str):
        limit = F.when(F.col("lang").eqNullSafe(F.lit(lang)), F.lit(value)).otherwise(limit)
    scored = docs.withColumn("score", scorer(docs.sparkSession, model)(F.col("text")))
    return scored.withColumn("flagged", F.col("score") >= limit)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    predicted = (F.col("score") >= PREDICTED).cast("int").alias("predicted")
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", predicted, "flagged")
