"""Toxicity of whole texts: a weighted lexicon matched by one Aho-Corasick automaton.

Texts are lower-cased and folded first: look-alike letters of other scripts, accents,
digits standing for letters, and characters without width. Entries are whole words or
word beginnings (``stem*``). Their weights are log odds learned from labelled rows;
a short list of fixed words and of exception phrases stands beside them. An exception
phrase cancels the entries inside it; phrases are fixed or learned as well. ``$``,
``@`` and ``!`` between letters are read as the letters they stand for, but end a word
all the same where an entry ends.

The sum of matched weights, alone and per hundred words, goes through a logistic
function fitted to the labelled rows. Null and empty texts score 0.

Learning uses at most ``LABELLED`` labelled training rows, the first by a hash of the
id, and the smallest id of each group that shares the smallest hash of its shingles, so
that copies of a document don't make its words toxic. Of the words and beginnings that
qualify, the ``ENTRIES`` that most toxic rows hold are learned, and as many exception
phrases, those that most clean rows hold. Null labels and ids are not learned from; rows
that share an id are scored each by its own text.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import fold, only_ids, small_batches

LABELLED = 20_000
ENTRIES = 4000
STEMS = (4, 5, 6)
#: Distinct toxic texts behind a learned entry, at least, also as a share of all toxic ones.
SUPPORT, SUPPORT_SHARE = 8, 0.01
#: Log odds of a learned entry, at least.
LEAST_WEIGHT = 3.5
THRESHOLD = 0.7

#: Common insults and their weight before any label is seen.
SEED_WORDS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless", "dumb", "imbecile", "vermin")
SEED_WEIGHT = 5.0
#: Harmless phrases around such words.
SEED_EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "pathetic fallacy", "pond scum", "sore loser")
#: Letters that look alike, and digits used for letters.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ⅼ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = str.maketrans({"$": "s", "@": "a", "!": "i"})
INSIDE = re.compile(r"(?<=[^\W\d_])[$@!]+(?=[^\W\d_])")
NO_WIDTH = "​‌‍⁠﻿­"


def _folds() -> dict[str, str]:
    """The fixed pairs, accented Latin letters, and full-width letters by their code."""
    table = dict(LOOK_ALIKE) | DIGITS
    for cp in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(cp))[0]
        if base != chr(cp) and base.isascii():
            table[chr(cp).lower()] = base.lower()
    return table | {chr(0xFF41 + k): chr(97 + k) for k in range(26)}


FOLDS = _folds()


def folded(text: Column) -> Column:
    """Lower case, folded; one character stays one character or goes."""
    source, target = "".join(FOLDS), "".join(FOLDS.values())
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), source + NO_WIDTH, target)


def fold_text(text: str) -> str:
    """The same in Python, for entries."""
    return "".join(FOLDS.get(c, c) for c in text.lower() if c not in NO_WIDTH)


@dataclass
class Lexicon:
    words: dict[str, float]
    exceptions: list[str]
    coefficients: tuple[float, float, float] = (-3.0, 1.0, 0.5)

    def automaton(self) -> ahocorasick.Automaton:
        """Values: list of (entry without the star, is a stem, weight, is an exception)."""
        patterns: dict[str, list] = {}
        for word, weight in self.words.items():
            stem = word.endswith("*")
            body = word.rstrip("*")
            patterns.setdefault(body, []).append((len(body), stem, weight, False))
        for phrase in self.exceptions:
            patterns.setdefault(phrase, []).append((len(phrase), False, 0.0, True))
        automaton = ahocorasick.Automaton()
        for p, values in patterns.items():
            automaton.add_word(p, values)
        automaton.make_automaton()
        return automaton

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        a, b, c = self.coefficients
        z = a + b * np.log1p(total) + c * np.log1p(100 * total / np.maximum(words, 1))
        return np.where(total > 0, 1 / (1 + np.exp(-z)), 0.0)


def without_signs(text: str) -> str:
    """Signs between letters as the letters they stand for; places stay the same."""
    return INSIDE.sub(lambda m: m.group().translate(SIGNS), text)


def matched(automaton: ahocorasick.Automaton, text: str) -> float:
    """Summed weight of the entries in a folded text, outside exception phrases.

    Words end at signs as well, so their ends are looked for in the text as it came.
    Where several entries begin at one place the heaviest counts.
    """
    found: dict[int, float] = {}
    spared: dict[int, int] = {}
    for end, values in automaton.iter(without_signs(text)):
        for size, stem, weight, exception in values:
            start = end - size + 1
            if (start and text[start - 1].isalpha()) or (not stem and end + 1 < len(text) and text[end + 1].isalpha()):
                continue
            if exception:
                spared[start] = max(spared.get(start, 0), end)
            else:
                found[start] = max(found.get(start, 0.0), weight)
    starts, ends, far = sorted(spared), [], -1
    for a in starts:  # the farthest end of the phrases that begin so far
        far = max(far, spared[a])
        ends.append(far)
    kept = (w for at, w in found.items() if not starts or not (k := bisect_right(starts, at)) or ends[k - 1] < at)
    return sum(kept)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most LABELLED training rows, without near copies."""
    marks = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(fold(3) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = stored(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), folded(F.col("text")).alias("text"))
    rows = only_ids(rows, marks.select("doc_id"), ["doc_id"]).join(F.broadcast(marks), "doc_id")
    rows = rows.withColumn("words", F.split("text", r"[^\p{L}]+"))
    shingle = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))), lambda k: F.xxhash64(F.slice("words", k, 5)))
    rows = stored(rows.withColumn("first", F.array_min(shingle)))
    return rows.groupBy("first").agg(F.min(F.struct("doc_id", "text", "words", "toxic")).alias("one")).select("one.*")


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    small_batches(docs.sparkSession)
    lexicon = Lexicon({w: SEED_WEIGHT for w in SEED_WORDS}, list(SEED_EXCEPTIONS))
    rows = stored(labelled(docs, labels))
    toxic, clean = (rows.where(F.col("toxic") == k).count() for k in (1, 0))
    if not toxic or not clean:
        return lexicon
    words = F.array_distinct(F.filter("words", lambda w: F.length(w) > 2))
    stems = F.array_distinct(F.flatten(F.array(*(F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS))))  # noqa: B023
    least = max(SUPPORT, SUPPORT_SHARE * toxic)
    counts = rows.select("toxic", F.explode(F.concat(words, stems)).alias("entry")).groupBy("entry").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    weight = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    found = counts.where(F.col("bad") >= least).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    top = found.orderBy(F.desc("bad"), "entry").limit(ENTRIES).collect()
    lexicon.words |= _narrowed({r.entry: (int(r.bad), float(r.weight)) for r in top})
    _learn_exceptions(lexicon, rows)
    _fit(lexicon, rows)
    return lexicon


def _narrowed(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Without stems that one longer entry explains, and without words under a kept stem."""
    kept: dict[str, float] = {}
    for entry, (bad, weight) in sorted(found.items(), key=lambda x: (len(x[0]), x[0])):
        body = entry.rstrip("*")
        if any(body.startswith(k[:-1]) for k in kept if k.endswith("*")):
            continue
        if entry.endswith("*") and any(
            e != entry and len(e.rstrip("*")) > len(body) and e.startswith(body) and b >= 0.9 * bad for e, (b, _) in found.items()
        ):
            continue
        kept[entry] = weight
    return kept


def _learn_exceptions(lexicon: Lexicon, rows: DataFrame) -> None:
    """Pairs of words around an entry that clean texts use again and toxic ones never."""
    entries = F.array(*(F.lit(w) for w in sorted(w for w in lexicon.words if not w.endswith("*"))))
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 1, F.lit(1))), lambda k: F.slice("words", k, 2))
    near = rows.where(F.arrays_overlap("words", entries)).select("toxic", F.explode(F.array_distinct(pairs)).alias("pair"))
    near = near.where((F.size("pair") == 2) & F.arrays_overlap("pair", entries))
    counts = near.groupBy("pair").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    kept = counts.where(f"bad = 0 and good >= {SUPPORT}").orderBy(F.desc("good"), "pair").limit(ENTRIES)
    lexicon.exceptions += [" ".join(r.pair) for r in kept.collect()]


def totals(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``rows`` with ``total``, the summed weight in its folded column ``_folded``."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = shared.value.automaton()
        for texts in batches:
            yield pd.Series([matched(automaton, t) for t in texts], dtype="float64")

    return rows.withColumn("_total", match("_folded"))


def _fit(lexicon: Lexicon, rows: DataFrame) -> None:
    """Logistic regression on the matched rows, by a few Newton steps with a ridge."""
    sums = totals(rows.withColumn("_folded", F.col("text")), lexicon)
    data = sums.select("toxic", "_total", F.size("words").alias("n")).where("_total > 0").toPandas()
    total, y = data["_total"].to_numpy(), data["toxic"].to_numpy(float)
    x = np.stack([np.ones(len(y)), np.log1p(total), np.log1p(100 * total / np.maximum(data["n"].to_numpy(), 1))], axis=1)
    prior = np.array(lexicon.coefficients)
    b = prior.copy()
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + np.eye(3) * 2.0
        b += np.linalg.solve(hessian, x.T @ (y - p) - 2.0 * (b - prior))
    if np.all(np.isfinite(b)):
        lexicon.coefficients = tuple(float(v) for v in b)


def toxicity(docs: DataFrame, labels: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    lexicon = lexicon or learn(docs, labels)
    rows = docs.select("doc_id", folded(F.col("text")).alias("_folded"))
    rows = totals(rows, lexicon).withColumn("_words", F.greatest(F.regexp_count("_folded", F.lit(r"\S+")), F.lit(1)))
    a, b, c = lexicon.coefficients
    z = a + b * F.log1p("_total") + c * F.log1p(100 * F.col("_total") / F.col("_words"))
    score = F.when(F.col("_total") > 0, 1 / (1 + F.exp(-z))).otherwise(0.0)
    return rows.select("doc_id", (fold(3) == 1).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    )
