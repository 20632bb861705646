"""Language identification by a byte convolutional network, trained here in numpy.

A text is lower-cased, written as UTF-8 and cut into windows of ``WINDOW`` bytes.  The
network embeds the bytes, runs filters of widths 2, 3 and 4 over them, takes each
filter's maximum over the window and ends in a softmax over the languages of the
training rows.  The text's language is that of the highest mean probability over all
windows of the whole text, each weighted by its bytes.

For use the embedding and filters are multiplied out into tables by byte pairs, so a
window costs three look-ups a byte.

Training takes at most ``DOCS_PER_LANGUAGE`` documents of each of at most
``MAX_LANGUAGES`` languages (the ones with the most rows), those of the smallest id
hash, and at most ``WINDOWS_PER_DOC`` windows of each; all are parameters.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without
training rows every text is ``und``; every row gives one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

WINDOW = 128
EMBED, FILTERS, WIDTHS = 8, 8, (2, 3, 4)
DOCS_PER_LANGUAGE, MAX_LANGUAGES, WINDOWS_PER_DOC = 400, 200, 6
STEPS, BATCH, RATE = 500, 128, 0.01
UNDETERMINED = "und"
BATCH_WINDOWS = 2048
_LETTER = re.compile(r"[^\W\d_]")


def windows_of(text: str) -> np.ndarray:
    """The text's bytes in rows of ``WINDOW``, the last filled up with zeros."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    full = np.zeros(-(-len(raw) // WINDOW) * WINDOW, np.uint8)
    full[: len(raw)] = raw
    return full.reshape(-1, WINDOW)


@dataclass
class Network:
    """Weights: byte embedding, one filter bank for each width, and the output layer."""

    languages: list[str]
    embed: np.ndarray
    banks: list[np.ndarray]  # width x EMBED by FILTERS
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        banks = [rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return cls(languages, rng.normal(0, 0.5, (256, EMBED)), banks, [np.zeros(FILTERS) for _ in WIDTHS], rng.normal(0, n**-0.5, (n, len(languages))), np.zeros(len(languages)))

    def params(self) -> list[np.ndarray]:
        return [self.embed, *self.banks, *self.biases, self.out, self.out_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss of windows x with labels y, and its gradient for every parameter."""
        e = self.embed[x]
        pooled, places = [], []
        for width, bank, bias in zip(WIDTHS, self.banks, self.biases, strict=True):
            n = WINDOW - width + 1
            unfolded = np.concatenate([e[:, j : j + n] for j in range(width)], 2)
            conv = unfolded @ bank + bias
            at = conv.argmax(1)
            places.append(at)
            pooled.append(np.take_along_axis(conv, at[:, None, :], 1)[:, 0])
        hidden = np.concatenate(pooled, 1)
        active = np.maximum(hidden, 0)
        p = softmax(active @ self.out + self.out_bias)
        loss = -np.log(p[np.arange(len(y)), y] + 1e-12).mean()
        d_logit = p
        d_logit[np.arange(len(y)), y] -= 1
        d_logit /= len(y)
        d_hidden = (d_logit @ self.out.T) * (hidden > 0)
        d_embed = np.zeros_like(self.embed)
        d_banks, d_biases = [], []
        row = np.arange(len(x))[:, None]
        for k, (width, bank, at) in enumerate(zip(WIDTHS, self.banks, places, strict=True)):
            d = d_hidden[:, k * FILTERS : (k + 1) * FILTERS]
            d_bank = np.zeros_like(bank)
            for j in range(width):
                rows = slice(j * EMBED, (j + 1) * EMBED)
                d_bank[rows] = np.einsum("nfe,nf->ef", e[row, at + j], d)
                np.add.at(d_embed, x[row, at + j], d[:, :, None] * bank[rows].T[None])
            d_banks.append(d_bank)
            d_biases.append(d.sum(0))
        return loss, [d_embed, *d_banks, *d_biases, active.T @ d_logit, d_logit.sum(0)]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Filter sums by byte pair at a place, by the byte and by the pair two places on; biases."""
        at = [[self.embed @ bank[j * EMBED : (j + 1) * EMBED] for j in range(width)] for width, bank in zip(WIDTHS, self.banks, strict=True)]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        near = np.concatenate([pair(t[0], t[1]) for t in at], 1)
        return tuple(np.ascontiguousarray(x, np.float32) for x in (near, at[1][2], pair(at[2][2], at[2][3]), np.concatenate(self.biases)))

    def predict(self, x: np.ndarray, tables: tuple[np.ndarray, ...]) -> np.ndarray:
        """Language probabilities of windows, through the tables of widths 2, 3 and 4."""
        near, third, far, bias = tables
        first = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        conv = near[first]
        pooled = [conv[:, :, :FILTERS].max(1)]
        conv[:, :-1, FILTERS : 2 * FILTERS] += third[x[:, 2:]]
        pooled.append(conv[:, :-1, FILTERS : 2 * FILTERS].max(1))
        conv[:, :-2, 2 * FILTERS :] += far[first[:, 2:]]
        pooled.append(conv[:, :-2, 2 * FILTERS :].max(1))
        return softmax(np.maximum(np.concatenate(pooled, 1) + bias, 0) @ self.out + self.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 11) -> Network:
    """Adam steps over balanced random batches of the windows."""
    net, rng = Network.fresh(languages, seed), np.random.default_rng(seed + 1)
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    moment, spread = ([np.zeros_like(p) for p in net.params()] for _ in range(2))
    for step in range(1, steps + 1):
        kind = rng.integers(0, len(languages), BATCH)
        pick = np.array([groups[k][rng.integers(0, len(groups[k]))] for k in kind])
        _, gradient = net.gradients(windows[pick], labels[pick])
        for p, g, m, s in zip(net.params(), gradient, moment, spread, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def train(docs: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """Fit on the rows that ``usable`` (of ``docs``) accepts and that have a language and a text."""
    own = docs.filter(usable & docs[lang].isNotNull() & docs[text].isNotNull())
    keyed = own.select(docs[doc_id].alias("_id"), docs[lang].alias("_lang"))
    common = keyed.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(MAX_LANGUAGES).select("_lang")
    place = F.row_number().over(W.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    # Both sides are bounded by the parameters above: numbers and language names.
    sample = keyed.join(F.broadcast(common), "_lang").withColumn("_place", place).filter(F.col("_place") <= DOCS_PER_LANGUAGE).select("_id").distinct()
    chosen = own.join(F.broadcast(sample), docs[doc_id] == sample["_id"]).select(docs[lang].alias("lang"), docs[text].alias("body"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for lang_value, body in zip(batch["lang"], batch["body"], strict=True):
                if _LETTER.search(body):
                    all_of = windows_of(body)
                    pick = np.unique(np.linspace(0, len(all_of) - 1, WINDOWS_PER_DOC).astype(int))
                    rows += [(lang_value, w.tobytes()) for w in all_of[pick]]
            yield pd.DataFrame(rows, columns=["lang", "window"])

    rows = chosen.mapInPandas(cut, "lang string, window binary").toPandas().sort_values(["lang", "window"])
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    windows = np.frombuffer(b"".join(rows["window"]), np.uint8).reshape(-1, WINDOW)
    return fit(windows, np.searchsorted(languages, rows["lang"].to_numpy(str)), languages)


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``language`` (lang, score)."""

    @F.pandas_udf("lang string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = network.tables() if network else None
        for batch in batches:
            texts = [t if t and network and _LETTER.search(t) else None for t in batch]
            yield pd.DataFrame(_languages(texts, network, tables), columns=["lang", "score"])

    return docs.withColumn("language", identified(docs[text]))


def _languages(texts: list[str | None], network: Network | None, tables) -> list[tuple[str, float]]:
    """Language and mean probability of each text; windows of many texts go through together."""
    out = [(UNDETERMINED, 0.0)] * len(texts)
    if network is None:
        return out
    sums = np.zeros((len(texts), len(network.languages)))
    held, owners = [], []

    def flush() -> None:
        if held:
            x, owner = np.concatenate(held), np.concatenate(owners)
            for a in range(0, len(x), BATCH_WINDOWS):
                part = x[a : a + BATCH_WINDOWS]
                weighted = network.predict(part, tables) * (part != 0).sum(1)[:, None]
                np.add.at(sums, owner[a : a + BATCH_WINDOWS], weighted)
            held.clear()
            owners.clear()

    waiting = 0
    for row, text in enumerate(texts):
        if text is None:
            continue
        held.append(windows_of(text))
        owners.append(np.full(len(held[-1]), row))
        waiting += len(held[-1])
        if waiting >= BATCH_WINDOWS:
            flush()
            waiting = 0
    flush()
    for row, text in enumerate(texts):
        if text is not None:
            share = sums[row] / sums[row].sum()
            out[row] = (network.languages[int(share.argmax())], float(min(1.0, share.max())))
    return out
