"""Language of whole texts: a byte convolutional network trained in numpy.

Filters of several widths slide over byte embeddings, each is max-pooled over a
window of ``WINDOW`` bytes, and a softmax over the learned languages follows. A text
is cut into such windows (the last one padded with zero bytes); its class
probabilities are those of its windows weighted by their length.

For application each filter is turned into tables over byte pairs, so a convolution
is a few table lookups per byte.

Training sees a bounded sample: ``PER_LANGUAGE`` windows of each language, taken at
hashed places of hashed documents. Null text, and text without any letter, gives
``und`` with score 0. Null languages are never learned. Without any labelled text
every prediction is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import BROADCAST_IDS, fold, small_batches

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Training windows of each language at most.
PER_LANGUAGE = 2000
PLACES = 4
STEPS, BATCH, RATE = 500, 64, 0.01
UNKNOWN = "und"
#: Known is a language at least as likely as all others together.
LEAST_SCORE = 0.5


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width: (offset, table over byte pairs) whose looked-up rows add up."""
        e = self.embed
        result = []
        for width, w, b in zip(WIDTHS, self.filters, self.bias):
            per_byte = [e @ w[k * EMBED : (k + 1) * EMBED] for k in range(width)]
            parts = []
            for k in range(0, width, 2):
                first = per_byte[k][:, None, :]
                second = per_byte[k + 1][None, :, :] if k + 1 < width else np.zeros((1, 256, FILTERS), np.float32)
                parts.append((k, (first + second + (b if k == 0 else 0)).reshape(65536, FILTERS).astype(np.float32)))
            result.append(parts)
        return result


def windows_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(windows, lengths): the whole text, the last window padded with zero bytes."""
    n = max(1, -(-len(text) // WINDOW))
    flat = np.frombuffer(text.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)
    lengths = np.full(n, WINDOW)
    lengths[-1] = max(1, len(text) - (n - 1) * WINDOW)
    return flat, lengths


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 1) -> Network:
    """Adam on the class-balanced cross entropy; a part of each batch is cut short."""
    rng = np.random.default_rng(seed)
    c = len(languages)
    p = {"e": rng.normal(0, 0.5, (256, EMBED)), "u": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, c)), "c": np.zeros(c)}
    for k, width in enumerate(WIDTHS):
        p[f"w{k}"] = rng.normal(0, 1 / np.sqrt(width * EMBED), (width * EMBED, FILTERS))
        p[f"b{k}"] = np.zeros(FILTERS)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    of_class = [np.flatnonzero(labels == k) for k in range(c)]
    for step in range(1, STEPS + 1):
        y = rng.integers(0, c, BATCH)
        x = windows[[of_class[k][rng.integers(len(of_class[k]))] for k in y]].copy()
        for row in range(0, BATCH, 3):
            x[row, int(rng.integers(6, WINDOW)) :] = 0
        emb = p["e"][x]
        pooled, at = [], []
        for k, width in enumerate(WIDTHS):
            span = np.lib.stride_tricks.sliding_window_view(emb, width, axis=1).transpose(0, 1, 3, 2)
            conv = span.reshape(BATCH, -1, width * EMBED) @ p[f"w{k}"] + p[f"b{k}"]
            at.append(conv.argmax(axis=1))
            pooled.append(np.maximum(conv.max(axis=1), 0))
        h = np.concatenate(pooled, axis=1)
        prob = _softmax(h @ p["u"] + p["c"])
        prob[np.arange(BATCH), y] -= 1
        prob /= BATCH
        g = {"u": h.T @ prob, "c": prob.sum(axis=0), "e": np.zeros_like(p["e"])}
        back = (prob @ p["u"].T) * (h > 0)
        rows = np.arange(BATCH)[:, None]
        for k, width in enumerate(WIDTHS):
            d = back[:, k * FILTERS : (k + 1) * FILTERS]
            spans = np.stack([emb[rows, at[k] + j] for j in range(width)], axis=2).reshape(BATCH, FILTERS, -1)
            g[f"w{k}"] = np.einsum("bfi,bf->if", spans, d)
            g[f"b{k}"] = d.sum(axis=0)
            into = (d[:, :, None] * p[f"w{k}"].T[None]).reshape(BATCH, FILTERS, width, EMBED)
            for j in range(width):
                np.add.at(g["e"], x[rows, at[k] + j], into[:, :, j])
        for key, grad in g.items():
            first[key] += 0.1 * (grad - first[key])
            second[key] += 0.001 * (grad * grad - second[key])
            p[key] -= RATE * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.999**step)) + 1e-8)
    n = range(len(WIDTHS))
    return Network(languages, p["e"], [p[f"w{k}"] for k in n], [p[f"b{k}"] for k in n], p["u"], p["c"])


def window_probabilities(network: Network, tables, windows: np.ndarray) -> np.ndarray:
    """Softmax over the languages for each window, 256 windows at a time."""
    out = np.empty((len(windows), len(network.languages)))
    for start in range(0, len(windows), 256):
        x = windows[start : start + 256].astype(np.int32)
        pairs = (x << 8) | np.concatenate([x[:, 1:], np.zeros((len(x), 1), np.int32)], axis=1)
        pooled = []
        for width, parts in zip(WIDTHS, tables):
            n = WINDOW - width + 1
            conv = None
            for k, rows in parts:
                found = rows[pairs[:, k : k + n]]
                conv = found if conv is None else np.add(conv, found, out=conv)
            pooled.append(np.maximum(conv.max(axis=1), 0))
        out[start : start + 256] = _softmax(np.concatenate(pooled, axis=1) @ network.out + network.out_bias)
    return out


def predict(network: Network, tables, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """(language, probability) of whole texts, in one pass over all their windows."""
    cut = [windows_of((t or "").encode()) for t in texts]
    windows, weights = (np.concatenate(x) for x in zip(*cut))
    starts = np.cumsum([0] + [len(w) for w, _ in cut[:-1]])
    p = window_probabilities(network, tables, windows) * weights[:, None]
    mean = np.add.reduceat(p, starts, axis=0) / np.add.reduceat(weights, starts)[:, None]
    best = mean.argmax(axis=1)
    return [network.languages[k] for k in best], mean[np.arange(len(best)), best]


def training_windows(docs: DataFrame) -> DataFrame:
    """(lang, piece): at most PER_LANGUAGE pieces of each language from training rows."""
    rows = docs.where(F.col("lang").isNotNull() & has_letter(F.col("text")) & (fold(3) != 1))
    place = F.pmod(F.xxhash64("doc_id", "k"), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))) + 1
    pieces = rows.select("doc_id", "lang", "text", F.explode(F.sequence(F.lit(1), F.lit(PLACES))).alias("k")).select(
        "lang", F.substr("text", place.cast("int"), F.lit(WINDOW)).alias("piece"),
        F.xxhash64("doc_id", "k", F.lit(3)).alias("h"),
    )
    # about twice the wanted pieces by their hash, so that no task ranks a whole language;
    # one row per language, broadcast behind a count, so that only those pieces are shuffled
    wanted = stored(rows.groupBy("lang").agg((2.0 * PER_LANGUAGE / PLACES / F.count("*")).alias("share")))
    pieces = pieces.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30) + 1)
    order = Window.partitionBy("lang").orderBy("h", "piece")
    return pieces.withColumn("n", F.row_number().over(order)).where(F.col("n") <= PER_LANGUAGE).select("lang", "piece")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(docs: DataFrame) -> Network | None:
    sample = training_windows(docs.select("doc_id", "text", "lang")).toPandas().sort_values(["lang", "piece"])
    if sample.empty:
        return None
    languages = sorted(sample["lang"].unique())
    windows = np.concatenate([windows_of(p.encode()[:WINDOW])[0] for p in sample["piece"]])
    return train(windows, sample["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(), languages)


def language_of(docs: DataFrame, network: Network | None) -> Column:
    """Struct (lang, score) of the column ``text``."""
    if network is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("lang string, score double")
    def applied(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = shared.value.tables()
        for texts in batches:
            lang, score = predict(shared.value, tables, texts.tolist()) if len(texts) else ([], [])
            yield pd.DataFrame({"lang": lang, "score": score})

    found = applied(F.col("text"))
    known = has_letter(F.col("text"))
    return F.when(known, found).otherwise(F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score")))


def predicted_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``."""
    network = learn(docs)
    rows = docs.select("doc_id", "text").withColumn("p", language_of(docs, network))
    return rows.select(
        "doc_id", (fold(3) == 1).alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").cast("double").alias("score")
    )


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """``docs`` without rows whose language has a score below ``LEAST_SCORE``, as null and letterless texts have.

    Where there is nothing to learn from, only null and letterless texts go.
    """
    network = learn(docs)
    if network is None:
        return docs.where(has_letter(F.col("text")))
    name = "_llm_language"
    return docs.withColumn(name, language_of(docs, network)).where(F.col(f"{name}.score") >= LEAST_SCORE).drop(name)
