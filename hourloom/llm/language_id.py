"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies come from all training documents. The weights are trained on a bounded sample of them, by
follow-the-regularised-leader with elastic-net penalties, and a temperature fitted on a part kept back makes the
probabilities honest.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import bounded_batches, landed, whole_row

UNKNOWN = "und"
BITS = 15  # n-grams are hashed to 2^BITS features
ORDERS = 3
BLOCK = 1 << 20  # code points that one round of array work takes

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def gram_counts(text: str | None) -> np.ndarray | None:
    """How often each feature occurs: runs of 1 to 3 characters, lower case, all but letters as one blank. None without letters."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = None
    for i in range(0, len(points), BLOCK):
        x = points[max(0, i - ORDERS + 1) : i + BLOCK]
        is_letter = letters()[x]
        if not is_letter.any():
            continue
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]  # a letter, or the first of what stands between two words
        x = np.where(is_letter, x, 32)[keep].astype(np.uint64)
        h = np.zeros(len(x), dtype=np.uint64)
        for n in range(ORDERS):
            h = h[: len(x) - n] * np.uint64(0x100000001B3) + x[n:] + np.uint64(n + 1)
            c = np.bincount(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
            total = c if total is None else total + c
    return total


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # languages x (features + bias)
    temperature: float = 1.0

    def vector(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        v = (1 + np.log(count)) * self.idf[at]
        return v / np.sqrt(v @ v)

    def logits(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.weights[:, at] @ self.vector(at, count) + self.weights[:, -1]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0
        at = np.flatnonzero(counts)
        p = softmax(self.logits(at, counts[at]) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(min(1.0, p[k]))

    @property
    def nonzero(self) -> int:
        return int(np.count_nonzero(self.weights))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    model: Model, sample: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01
) -> Model:
    """Follow-the-regularised-leader, one pass over the sample in its order for each epoch."""
    shape = model.weights.shape
    z, n = np.zeros(shape), np.zeros(shape)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        w = -(z[:, at] - np.sign(z[:, at]) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2)
        return np.where(np.abs(z[:, at]) <= l1, 0.0, w)

    bias = shape[1] - 1
    for _ in range(epochs):
        for at, count, label in sample:
            at, v = np.append(at, bias), np.append(model.vector(at, count), 1.0)
            w = weights(at)
            miss = softmax(w @ v)
            miss[label] -= 1
            g = miss[:, None] * v
            square = n[:, at] + g * g
            z[:, at] += g - (np.sqrt(square) - np.sqrt(n[:, at])) / alpha * w
            n[:, at] = square
    return Model(model.languages, model.idf, weights(slice(None)))


def calibrate(model: Model, kept_back: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """The temperature with the least log loss on documents the weights haven't seen."""
    if not kept_back:
        return model
    z = np.stack([model.logits(at, count) for at, count, _ in kept_back])
    y = np.array([label for *_, label in kept_back])

    def loss(t: float) -> float:
        return float(-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean())

    grid = np.geomspace(0.05, 20, 121)
    best = min(grid, key=loss)
    return Model(model.languages, model.idf, model.weights, float(best))


def fold(id_: Column) -> Column:
    """Remainder of the id's checksum by 5; 0 for a null id, so that it is never learnt from."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5, F.lit(0))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 800, kept_back: float = 0.25) -> Model:
    """A model from the documents that have a language and aren't held out.

    The sample are the `per_language` documents with letters of each language that have the least hashes of id and text,
    so neither size nor order of the table tell which; rows of equal id and text count once. Its last `kept_back` part fits
    the temperature. Without any labelled text with letters the model knows no language.
    """
    bounded_batches(docs.sparkSession)
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(F.col(id_col)) != 0))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.length(text_col), F.crc32(text_col)).alias("h"))
    width = 1 << BITS

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Document frequencies of features, and of each language the least hashes of texts with letters."""
        df = np.zeros(width + 1, dtype=np.int64)
        least: dict[str, set[int]] = {}
        bound: dict[str, int] = {}
        for b in batches:
            for text, lang, h in zip(*(c.to_pylist() for c in b.columns), strict=True):
                counts = gram_counts(text)
                if counts is None:
                    continue
                df[:-1] += counts > 0
                df[-1] += 1
                if h < bound.get(lang, 1 << 63):
                    mine = least.setdefault(lang, set())
                    mine.add(h)
                    if len(mine) >= 2 * per_language:
                        least[lang] = set(sorted(mine)[:per_language])
                        bound[lang] = max(least[lang])
        at = np.flatnonzero(df)
        names = ["feature", "docs", "lang", "h"]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at]), pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.int64())], names=names)
        for lang, mine in least.items():
            h = sorted(mine)[:per_language]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.int64()), pa.array([lang] * len(h), pa.string()), pa.array(h, pa.int64())], names=names)

    seen = landed(known.select("text", "lang", "h").mapInArrow(learnt, "feature long, docs long, lang string, h long"), "language-features")
    rows = seen.filter("feature is not null").groupBy("feature").agg(F.sum("docs").alias("docs")).toPandas()
    df = np.zeros(width + 1)
    df[rows["feature"].to_numpy(np.int64)] = rows["docs"].to_numpy(np.float64)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    first = seen.filter("h is not null").select("lang", "h").distinct().withColumn("place", place).filter(F.col("place") <= per_language)
    most = {r["lang"]: r["most"] for r in first.groupBy("lang").agg(F.max("h").alias("most")).collect()}  # one row for each language
    if not most:
        return Model((), idf, np.zeros((0, width + 1)))
    picked = F.lit(False)
    for name, h in most.items():
        picked = picked | ((F.col("lang") == name) & (F.col("h") <= h))
    # equal rows are one; another hash gives the order, since the least hashes of a large language are less than those of a small one
    picked = known.filter(picked).groupBy("lang", "h").agg(F.min("text").alias("text")).sort(F.xxhash64("h"), "h", "lang").collect()
    names, sample = tuple(sorted(most)), []
    for r in picked:
        counts = gram_counts(r["text"])
        if counts is not None:
            at = np.flatnonzero(counts)
            sample.append((at, counts[at], names.index(r["lang"])))
    cut = len(sample) - int(len(sample) * kept_back)
    model = Model(names, idf, np.zeros((len(names), width + 1)))
    return calibrate(train(model, sample[:cut]), sample[cut:])


def predictor(spark, model: Model):
    """A function of a text column that gives a struct of lang and score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(None if x is None or x is pd.NA or x != x else x) for x in text], columns=["lang", "score"])

    return predict


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row for each row of `docs`: id, held_out, lang_pred, score.

    The prediction depends on the text alone. A null text or one without letters is `und` with score 0, and so is every
    text where nothing could be learnt. Equal rows get equal answers; an empty table gives an empty one; other columns
    are ignored. Nothing is shuffled but counts of features.
    """
    model = fit(docs, id_col, text_col, lang_col, **options)
    guess = predictor(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("id"), (fold(F.col(id_col)) == 0).alias("held_out"), guess(F.col(text_col)).alias("guess"))
    return rows.select(F.col("id").alias(id_col), "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"))


def keep_known(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of `docs` whose language is told with a score of at least `least`; `und` goes. All columns stay as they are."""
    guess = predictor(docs.sparkSession, fit(docs, id_col, text_col, lang_col, **options))
    rows = docs.select(whole_row(docs).alias("doc"), guess(F.col(text_col)).alias("guess"))
    return rows.filter((F.col("guess.lang") != UNKNOWN) & (F.col("guess.score") >= least)).select("doc.*")
