"""Language identification: known words first, shorter and shorter character n-grams for the others."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.text import documents, remainder, saved

SAMPLE = 1_000  # training documents for each language, about
LANGUAGES = 1_000  # languages learned at most, the most frequent ones
WORDS = 200_000  # entries of the word table (word, language), shared out among the languages
GRAMS = 200_000  # entries of the n-gram table, likewise
ORDERS = (5, 4, 3, 2, 1)
LONGEST = 40  # characters of a word that is kept as a word; longer ones are read by their n-grams
STEP = 500  # documents scored at a time

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, order: int) -> list[str]:
    """n-grams of a word with its borders; single letters without."""
    if order == 1:
        return list(word)
    framed = f"<{word}>"
    return [framed[i : i + order] for i in range(len(framed) - order + 1)]


COUNTS = "order int, gram string, lang string, n long"


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words (order 0) and n-grams by language, combined for each batch of (text, lang)."""
    for batch in batches:
        words: dict[str, Counter] = {}
        for text, lang in zip(batch.text, batch.lang):
            words.setdefault(lang, Counter()).update(words_of(text))
        out = []
        for lang, seen in words.items():
            out += [(0, w, lang, n) for w, n in seen.items() if len(w) <= LONGEST]
            for order in ORDERS:
                grams: Counter = Counter()
                for w, n in seen.items():
                    for g in grams_of(w, order):
                        grams[g] += n
                out += [(order, g, lang, n) for g, n in grams.items()]
        yield pd.DataFrame(out, columns=["order", "gram", "lang", "n"])


class Model:
    """Log frequencies by language of words and n-grams, in one table; `rows` maps order and text to a row of it."""

    def __init__(self, counts: list[tuple[int, str, str, int]]):
        self.langs = sorted({lang for _, _, lang, _ in counts})
        column = {lang: i for i, lang in enumerate(self.langs)}
        self.rows: dict[int, dict[str, int]] = {o: {} for o in (0, *ORDERS)}
        seen = []
        for order, gram, lang, n in counts:
            at = self.rows[order].setdefault(gram, len(seen))
            if at == len(seen):
                seen.append((order, np.zeros(len(self.langs))))
            seen[at][1][column[lang]] += n
        orders = np.array([o for o, _ in seen], int)
        table = np.array([c for _, c in seen]).reshape(len(seen), len(self.langs)) + 0.5
        for order in set(orders.tolist()):
            of = orders == order
            table[of] = np.log(table[of] / table[of].sum(axis=0))
        self.table = table

    def vector(self, word: str) -> np.ndarray:
        """Evidence of one word: its own row, else the mean of its longest known n-grams, weighted by their length."""
        at = self.rows[0].get(word)
        if at is not None:
            return self.table[at]
        for order in ORDERS:
            known = self.rows[order]
            found = [known[g] for g in grams_of(word, order) if g in known]
            if found:
                return self.table[found].mean(axis=0) * (order / ORDERS[0])
        return np.zeros(len(self.langs))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, its posterior at equal priors) of each text; und and 0 without letters or languages."""
        index: dict[str, int] = {}
        ids: list[int] = []
        ends, lettered = [], []
        for text in texts:
            lettered.append(bool(self.langs) and text is not None and any(map(str.isalpha, text)))
            if lettered[-1]:
                ids += [index.setdefault(w, len(index)) for w in words_of(text)]
            ends.append(len(ids))
        if not any(lettered):
            return [("und", 0.0)] * len(texts)
        vectors = np.array([self.vector(w) for w in index]).reshape(len(index), len(self.langs))
        taken = vectors[np.array(ids, int)]
        sums = np.zeros((len(texts), len(self.langs)))
        full = [i for i in range(len(texts)) if ends[i] > (ends[i - 1] if i else 0)]
        if full:
            sums[full] = np.add.reduceat(taken, [ends[i - 1] if i else 0 for i in full], axis=0)
        best = sums.argmax(axis=1)
        scores = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        return [(self.langs[b], float(s)) if ok else ("und", 0.0) for ok, b, s in zip(lettered, best, scores)]


def fair_shares(sizes: dict[str, int], limit: int) -> dict[str, int]:
    """How many entries each language keeps: all of them while they fit; else the same number for each, and what small
    languages leave over goes to the others."""
    shares, left = {}, limit
    for i, (lang, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        shares[lang] = min(n, left // (len(sizes) - i))
        left -= shares[lang]
    return shares


def train(docs: DataFrame, text_col: str, lang_col: str, id_col: str, sample: int = SAMPLE) -> Model:
    """Fit on about `sample` documents for each language, chosen by a hash of the id; the tables are bounded by WORDS and GRAMS.

    What a table can't hold is cut language by language, the rarest entries first and equally rare ones by a hash, so
    neither a rare language nor a script that sorts late loses more than others. Of more than LANGUAGES languages the
    least frequent are not learned. `docs` holds the training rows only; null texts and languages are skipped.
    """
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    usable = usable.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"))
    sizes = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return Model([])
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, min(1.0, sample / r["count"]))])
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    chosen = usable.filter(place < F.try_element_at(share, F.col("lang"))).select("text", "lang")
    counts = chosen.mapInPandas(_counted, COUNTS).groupBy("order", "gram", "lang").agg(F.sum("n").alias("n"))
    counts = saved(counts.withColumn("is_word", F.col("order") == 0))
    found = counts.groupBy("is_word", "lang").count().collect()  # two rows a language
    shares = {kind: fair_shares({r.lang: r["count"] for r in found if r.is_word == kind}, limit) for kind, limit in ((True, WORDS), (False, GRAMS))}
    limits = {kind: F.create_map(*[F.lit(x) for pair in of.items() for x in pair]) for kind, of in shares.items() if of}
    rank = F.row_number().over(Window.partitionBy("is_word", "lang").orderBy(F.desc("n"), "order", F.xxhash64("gram"), "gram"))
    ranked = counts.withColumn("rank", rank)
    kept = [ranked.filter((F.col("is_word") == kind) & (F.col("rank") <= F.try_element_at(of, F.col("lang")))) for kind, of in limits.items()]
    return Model([(r.order, r.gram, r.lang, r.n) for part in kept for r in part.select("order", "gram", "lang", "n").collect()])


def predictor(spark: SparkSession, model: Model):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            whole = batch.tolist()
            out = [p for i in range(0, len(whole), STEP) for p in shared.value.predict(whole[i : i + STEP])]
            yield pd.DataFrame(out, columns=["lang", "score"])

    return predict


def languages(
    docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score; learned from the text and language of `training` alone.

    Null texts and texts without a letter are `und` with score 0, and so is everything when nothing could be learned.
    Equal evidence goes to the language that sorts first. Repeated rows are each predicted; other columns are ignored.
    """
    predict = predictor(docs.sparkSession, train(training, text_col, lang_col, id_col, sample))
    out = docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p"))
    return out.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = languages(docs.select("doc_id", "text"), docs.filter(remainder("doc_id", 4) != 2))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
