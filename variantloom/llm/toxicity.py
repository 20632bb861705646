"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Training.  At most ``MAX_LABELLED`` labelled documents (a parameter), those of the
smallest id hash, are used.  Tasks hash the 3- to 5-character windows of the lower-case
texts into ``BUCKETS`` buckets and count, for each bucket, the toxic and the other
documents that have it.  At most ``FEATURES`` buckets are kept,
those whose log-count ratio r is the most significant, by the likelihood-ratio test; a document's vector is r at the kept buckets it has.  A logistic
regression with ridge penalty is fitted to these vectors.

Scoring is one pass over all whole texts, window by window in arrays; a score depends
on the text alone.

Defined cases: null and empty texts score by the bias; documents with several labels
count as toxic if one label is, equal texts by the majority of their labels; null labels are no labels; without both classes among
the labelled rows every text scores their smoothed share.  Every row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 10_000
SIZES = (3, 4, 5)
BITS = 20
BUCKETS = 1 << BITS
FEATURES = 4096
LEAST_GAIN = 30.0  # of a test with one degree of freedom: chance in about one of 20 million buckets
RIDGE = 0.02
BATCH_CHARS = 500_000
_FACTOR, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def window_buckets(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all character windows, one pair of arrays for each window size."""
    lower = [t.lower() for t in texts]
    code = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lower), np.int64, len(lower)))
    rolled = code.copy()
    with np.errstate(over="ignore"):
        for size in range(2, max(SIZES) + 1):
            if len(code) < size:
                return
            rolled = rolled[: len(code) - size + 1] * _FACTOR + code[size - 1 :]
            if size in SIZES:
                inside = row[: len(rolled)] == row[size - 1 :]
                yield row[: len(rolled)][inside], (((rolled + np.uint64(size)) * _SPREAD) >> np.uint64(64 - BITS))[inside].astype(np.int64)


def slices(texts: list[str]) -> Iterator[slice]:
    """Runs of rows of about ``BATCH_CHARS`` characters."""
    begin = size = 0
    for row, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield slice(begin, row + 1)
            begin, size = row + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def present(texts: list[str], number_of: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature), each once, of the features that the texts have."""
    found = [np.zeros(0, np.int64)]
    for row, bucket in window_buckets(texts):
        feature = number_of[bucket]
        hit = feature >= 0
        found.append(np.unique(row[hit] * n_features + feature[hit]))
    pairs = np.unique(np.concatenate(found))
    return pairs // max(1, n_features), pairs % max(1, n_features)


@dataclass
class Model:
    """Kept buckets with their weights (log-count ratio times learned weight) and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def number_of(self) -> np.ndarray:
        table = np.full(BUCKETS, -1, np.int16)
        table[self.buckets] = np.arange(len(self.buckets))
        return table

    def score(self, texts: list[str], number_of: np.ndarray) -> np.ndarray:
        row, feature = present(texts, number_of, len(self.buckets))
        raw = self.bias + np.bincount(row, self.weights[feature], len(texts))
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, most: int, doc_id: str, text: str, label: str) -> DataFrame:
    """(body, toxic) of at most ``most`` labelled documents that ``usable`` (of ``labels``) allows."""
    own = labels.filter(usable & labels[label].isNotNull()).groupBy(labels[doc_id].alias("_id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    sample = own.orderBy(F.xxhash64("_id"), "_id").limit(most)
    # The sample has at most ``most`` rows of two numbers.
    bodies = docs.select(docs[doc_id].alias("id"), F.coalesce(docs[text], F.lit("")).alias("body"))
    found = bodies.join(F.broadcast(sample), F.col("id") == F.col("_id"))
    # Copies count once, with the label that most of them have.
    return found.groupBy("body").agg(F.min("id").alias("id"), F.round(F.avg("toxic")).cast("int").alias("toxic"))


def fit_logistic(row: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, n_features: int, steps: int = 250) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps over sparse (row, feature, value)."""
    w, bias = np.zeros(n_features), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    moment, spread = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        raw = bias + np.bincount(row, w[feature] * value, len(y))
        error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y) / len(y)
        gradient = np.append(np.bincount(feature, error[row] * value, n_features) + RIDGE / len(y) * w, error.sum())
        moment = 0.9 * moment + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        move = 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, usable: Column, most: int = MAX_LABELLED, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the documents whose label row ``usable`` accepts."""
    sample = labelled_sample(docs, labels, usable, most, doc_id, text, label)
    totals = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n, n_toxic = int(totals[0]), int(totals[1])
    bias = float(np.log((n_toxic + 1) / (n - n_toxic + 1)))
    if not 0 < n_toxic < n:
        return Model(np.zeros(0, np.int64), np.zeros(0), bias)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for body, toxic in zip(batch["body"], batch["toxic"], strict=True):
                for _, bucket in window_buckets([body]):
                    seen[toxic, np.unique(bucket)] += 1
        kept = np.flatnonzero(seen.any(0))
        yield pd.DataFrame({"bucket": kept, "clean": seen[0, kept], "toxic": seen[1, kept]})

    counts = sample.mapInPandas(count, "bucket bigint, clean bigint, toxic bigint").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p, q = F.col("toxic") + 1, F.col("clean") + 1
    ratio = F.log(p / F.lit(n_toxic + 2)) - F.log(q / F.lit(n - n_toxic + 2))
    # Twice the log-likelihood gained by letting the bucket depend on the class.
    cells = [(F.col("toxic"), n_toxic), (F.col("clean"), n - n_toxic)]
    both = F.col("toxic") + F.col("clean")
    gain = F.lit(0.0)
    for seen, of in cells:
        for part, share in ((seen, both / n), (F.lit(of) - seen, (F.lit(n) - both) / n)):
            gain = gain + F.when(part > 0, 2 * part * F.log(part / (share * of))).otherwise(0.0)
    ranked = counts.select("bucket", ratio.alias("ratio"), gain.alias("gain")).filter(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "bucket").limit(FEATURES).toPandas()
    buckets, ratios = ranked["bucket"].to_numpy(np.int64), ranked["ratio"].to_numpy(float)
    table = Model(buckets, ratios, 0.0).number_of()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["body"].tolist()
            for part in slices(texts):
                row, feature = present(texts[part], table, len(buckets))
                own = np.split(feature, np.searchsorted(row, np.arange(1, part.stop - part.start)))
                yield pd.DataFrame({"id": batch["id"].iloc[part], "features": own, "toxic": batch["toxic"].iloc[part]})

    kind = sample.schema["id"].dataType.simpleString()
    fitted = sample.mapInPandas(vectors, f"id {kind}, features array<int>, toxic int").orderBy("id").toPandas()
    length = fitted["features"].map(len).to_numpy(np.int64)
    feature = np.concatenate(fitted["features"].tolist()).astype(np.int64)
    row = np.repeat(np.arange(len(fitted)), length)
    w, bias = fit_logistic(row, feature, ratios[feature], fitted["toxic"].to_numpy(float), len(buckets))
    return Model(buckets, w * ratios, bias)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the probability that a reader would call the text toxic."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.number_of()
        for batch in batches:
            texts = [t or "" for t in batch]
            yield pd.Series(np.concatenate([np.zeros(0), *(model.score(texts[part], table) for part in slices(texts))]))

    return docs.withColumn(column, scored(docs[text]))
