"""Phrases, filter audit and nearest vectors against brute-force versions."""

from __future__ import annotations

import functools
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import collocations, filter_audit, nearest, toxicity

DOCS = "doc_id long, text string, lang string, phrase string, n long, rank int"
WORDS = "of the a to in red blue fast slow cat dog sat ran Étude 日本 x1".split()


def sentences(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "]) for _ in range(n))


def documents() -> list[tuple]:
    rows = [(k, sentences(k % 30, 400 + k % 7), ["en", "fr", None][k % 3]) for k in range(90)]
    rows += [(200, None, "en"), (201, "", "en"), (202, " \t\n", None), (203, "of the " * 30_000, "en"), (204, "one", "de"), (204, "one", "de")]
    rows += [(None, "of the cat", "en"), (205, "of the cat sat", "und"), (206, ".,;", "xx")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], DOCS).repartition(7)


# ---- phrases


def phrase_counts(rows) -> tuple[dict, Counter]:
    f: dict = defaultdict(Counter)
    n: Counter = Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def phrases_by_hand(rows, least: int, best: int) -> list[tuple]:
    counts, n = phrase_counts(rows)
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        around: Counter = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i : i + m]] = max(around[p[i : i + m]], a)
        ranked = []
        for p, a in candidates.items():
            if around[p] * 100 < a * 80:
                score, _, left, rest = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), left, rest))
        for place, (score, a, phrase, left, rest) in enumerate(sorted(ranked)[:best], 1):
            out.append((lang, place, phrase.decode(), -a, left, rest, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("least", "best"), [(30, 2000), (3, 40)])
def test_collocations(spark, least, best):
    rows = documents()
    got = collocations.collocations(frame(spark, rows), least, best)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = phrases_by_hand(rows, least, best)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_hot_pairs_are_spread_and_counted_whole(spark):
    """'of the' is half of all words here: its pointers are routed by three words or four."""
    rows = [(k, "of the " + " of the ".join(random.Random(k).sample(WORDS, 8)), "en") for k in range(60)]
    rows += [(100 + k, "of the cat of the cat " * 9, "en") for k in range(20)]
    counts, _ = collocations.phrase_counts(frame(spark, rows), 30)
    want, _ = phrase_counts(rows)
    assert {(r["phrase"], r["n"]) for r in counts.collect()} == {(" ".join(p), a) for p, a in want["en"].items() if a >= 30}


def test_empty_tables_have_no_phrases(spark):
    assert collocations.collocations(frame(spark, [(1, "", "en")]).limit(0)).count() == 0
    assert collocations.collocations(frame(spark, [(1, "", "en"), (2, None, None)])).count() == 0


@pytest.mark.parametrize("routed", [2, 3, 4])
def test_partitions_are_counts(routed):
    rng = np.random.default_rng(routed)
    codes = rng.zipf(1.6, 4000).clip(0, 60)
    codes[rng.random(4000) < 0.1] = collocations.END
    keys = collocations.pointers(codes)
    keys = keys[keys[:, 1] != collocations.END]
    weights = rng.integers(1, 4, len(keys))
    want: Counter = Counter()
    for key, w in zip(keys.tolist(), weights.tolist()):
        for k in range(2, 5):
            if key[k - 1] != collocations.END:
                want[tuple(key[:k])] += w
    found = collocations.frequent_prefixes(keys, weights, 25, routed)
    got = {tuple(keys[row, :length].tolist()): n for row, length, n in found}
    assert len(got) == len(found)
    assert got == {p: n for p, n in want.items() if n >= 25 or len(p) < routed}


def test_words_are_cut_as_agreed():
    texts = pa.array(["A b\tÇ.d\x0be\x85f\xa0g", None, "", "x,y"])
    codes, own, names, spoken = collocations.words_of(texts, pa.array(["en", None, "en", "fr"]))
    said = [(spoken[o], names[c]) for c, o in zip(codes, own) if c != collocations.END]
    assert said == [("en", w) for w in ("a", "b", "Ç", "d", "e\x85f\xa0g")] + [("fr", "x"), ("fr", "y")]


# ---- filter audit


def audit_by_hand(rows, labels) -> list[tuple]:
    marks: dict = defaultdict(lambda: [0, 0])
    for i, quality, toxic in labels:
        if i is not None:
            marks[i] = [max(marks[i][0], int(quality == 1)), max(marks[i][1], int(toxic == 1))]
    smallest: dict = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    judged = []
    for i, text, lang in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": t in smallest and (i is None or i > smallest[t]),
        }
        judged.append((lang or "", {k for k, v in fails.items() if v}, *(marks[i] if i is not None else (0, 0))))
    out = []
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        steps, total = [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for s, own in enumerate(order):
                before = set(order[:s])
                removed = [j for j in mine if own in j[1] and not j[1] & before]
                total[own] += len(removed)
                steps.append((
                    part, order, s + 1, sum(not j[1] & (before | {own}) for j in mine), len(removed), sum(own in j[1] and bool(j[1] & before) for j in mine),
                    sum(j[1] == {own} for j in mine), sum(j[2] for j in removed), sum(j[3] for j in removed),
                ))
        out += [(*s, total[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def audit_rows() -> tuple[list, list]:
    rng = random.Random(5)
    long = [" ".join(f"w{rng.randrange(150)}" for _ in range(rng.randrange(60, 260))) for _ in range(25)]
    rows = [(k, rng.choice(long) + rng.choice(["", "", " $", " " + "ABCDEFGH" * 30]), rng.choice(["en", "fr", None, ""])) for k in range(80)]
    rows += [(100, None, "en"), (101, "", None), (102, "\x0b \t", "en"), (103, "word " * 40_000, "fr"), (104, "é" * 90 + "A" * 10, "en"), (105, "é" * 89 + "A" * 10, "en")]
    rows += [(None, long[0], "en"), (None, "alone", "en"), (None, "alone", "en"), (7, long[1], "fr"), (7, long[1], "fr"), (106, "a\xa0b c", "de")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 80, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def test_filter_audit(spark):
    rows, labels = audit_rows()
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(3)
    got = filter_audit.audited(frame(spark, rows).withColumn("good", filter_audit.F.lit("clash")), marked)
    want = audit_by_hand(rows, labels)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 4 * 600


def test_filter_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audited(frame(spark, [(1, "a", "en")]).limit(0), labels).count() == 0
    one = filter_audit.audited(frame(spark, [(1, "a", "en")]), labels)
    assert sorted(map(tuple, one.collect())) == audit_by_hand([(1, "a", "en")], [])


def test_one_text_in_most_rows(spark):
    rows = [(k, "the same text", "en" if k % 5 else None) for k in range(3000)] + [(5000 + k, f"other {k}", "en") for k in range(50)]
    got = filter_audit.audited(frame(spark, rows), spark.createDataFrame([(0, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == audit_by_hand(rows, [(0, 1, 1), (1, 1, 0)])


# ---- nearest vectors


def nearest_by_hand(rows, every: int, k: int) -> list[tuple]:
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in good:
        if q % every == 0:
            # plain additions in order: sum() would compensate for rounding
            scores = [(-functools.reduce(lambda t, ab: t + ab[0] * ab[1], zip(v, w), 0.0), i) for i, w in good if i != q and len(w) == len(v)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double").repartition(5)


def vector_rows() -> list[tuple]:
    rng = np.random.default_rng(3)
    near = lambda c: (c + rng.normal(0, 0.02, 12)).astype(np.float32).tolist()
    centre = rng.normal(0, 1, 12)
    rows = [(k, rng.normal(0, 1, 12).astype(np.float32).tolist()) for k in range(300)]
    rows += [(1000 + k, near(centre)) for k in range(150)]  # near copies
    rows += [(2000 + k, rows[20][1]) for k in range(90)]  # equal vectors
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None), (3020, []), (3040, [0.0] * 12), (3060, [nan] + [1.0] * 11), (3080, [inf] + [1.0] * 11), (3100, [None] + [1.0] * 11)]
    rows += [(4000, [1.0, 2.0]), (4001, [2.0, 1.0]), (None, rows[3][1]), (40, rows[40][1]), (60, rows[61][1])]
    return rows


@pytest.mark.parametrize("k", [20, 3])
def test_nearest(spark, k):
    rows = vector_rows()
    got = nearest.neighbours(vectors(spark, rows), 20, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == nearest_by_hand(rows, 20, k)


def test_nearest_of_little(spark):
    assert nearest.neighbours(vectors(spark, [(0, [1.0])]).limit(0)).count() == 0
    assert nearest.neighbours(vectors(spark, [(0, [1.0])])).count() == 0
    rows = [(0, [1.0, -0.0]), (20, [1.0, 0.0]), (3, [-5.0, 1e-30])]
    assert sorted(map(tuple, nearest.neighbours(vectors(spark, rows)).collect())) == nearest_by_hand(rows, 20, 20)


def test_blocks_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 40)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 6)
    rows = vector_rows()
    assert sorted(map(tuple, nearest.neighbours(vectors(spark, rows)).collect())) == nearest_by_hand(rows, 20, 20)


def test_estimates_are_unbiased_and_bounded():
    """Of 40,000 pairs, the mean error is near 0 and hardly any exceeds three standard deviations."""
    rng = np.random.default_rng(9)
    x, q = rng.normal(0, 1, (400, 48)), rng.normal(0, 1, (100, 48))
    centres, turn = nearest.fit_centres(x[:200]), nearest.rotation(48)
    assert np.allclose(turn.T @ turn, np.eye(48))
    codes, own, (slope, shift, spread, _) = nearest.encode(x, centres, turn)
    assert codes.shape == (400, 64)
    signs = np.unpackbits(codes, axis=1).astype(float) * 2 - 1
    estimate = q @ centres[own].T + slope * ((q @ turn.T) @ signs.T) + shift
    bound = np.sqrt(((q[:, None] - centres[own][None]) ** 2).sum(2)) * spread
    exact = q @ x.T
    sure = bound < 1e-9  # a vector that is a centre
    assert np.allclose(estimate[sure], exact[sure])
    error = (estimate - exact)[~sure] / bound[~sure]
    assert abs(error.mean()) < 0.05 and (np.abs(error) > nearest.SIGMAS).mean() < 0.005


# ---- toxicity


def matched_by_hand(lexicon: toxicity.Lexicon, text: str) -> float:
    """Every entry at every place of the text, letter by letter."""
    stands = {"$": "s", "@": "a", "!": "i"}
    plain = list(text)
    for k, c in enumerate(text):
        if c in stands:
            before = next((x for x in reversed(text[:k]) if x not in stands), " ")
            after = next((x for x in text[k + 1 :] if x not in stands), " ")
            if before.isalpha() and after.isalpha():
                plain[k] = stands[c]
    plain = "".join(plain)
    ended = lambda k: k >= len(text) or not text[k].isalpha()
    begun = lambda k: k == 0 or not text[k - 1].isalpha()
    inside = {
        p for phrase in lexicon.exceptions for k in range(len(text)) if plain.startswith(phrase, k) and begun(k) and ended(k + len(phrase))
        for p in range(k, k + len(phrase))
    }
    total = 0.0
    for k in range(len(text)):
        here = [
            w for entry, w in lexicon.words.items()
            if plain.startswith(entry.rstrip("*"), k) and begun(k) and (entry.endswith("*") or ended(k + len(entry)))
        ]
        total += max(here) if here and k not in inside else 0.0
    return total


def test_matches_equal_a_plain_search():
    lexicon = toxicity.Lexicon({"ass": 2.0, "assassin": 1.0, "idi*": 4.0, "idiot": 5.0, "classesassistance": 3.0, "sis": 1.5}, ["sis ass", "an idiot", "ass a"])
    automaton, rng = lexicon.automaton(), random.Random(6)
    pieces = ["ass", "a$$", "@ss", "idiot", "id!ot", "!", "$", "an", "a", "sis", "s!s", " ", " ", ".", "1", "é", "classesassistance", "cl@$$e$a$$!$t@nce", "assassin"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(4000)]
    texts += ["", "classe$assistance", "cl@$$e$a$$!$t@nce", "idiot!you", "id!ot!you", "idiot!!!", "a$$ a$$", "an idiot sis ass a"]
    for text in texts:
        assert toxicity.matched(automaton, text) == matched_by_hand(lexicon, text), text
    assert toxicity.matched(automaton, "cl@$$e$a$$!$t@nce") == 5.0 and toxicity.matched(automaton, "id!ot!you") == 5.0


def test_toxicity_of_odd_rows(spark):
    """Null, empty and very long texts, null and repeated ids, names that clash."""
    long = "fine words " * 60_000
    rows = [(1, None, "a"), (2, "", "b"), (3, long + "you stupid idiot", "c"), (None, "stupid idiot scum", "d"), (4, "a clown fish", "e"), (4, "stupid scum, idiot", "f"), (5, long, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _folded string").repartition(3)
    labels = spark.createDataFrame([(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.score > 0, r.predicted) for r in toxicity.toxicity(docs, labels).collect()))
    assert [g[:3] for g in got] == [(False, 1, False), (False, 2, False), (False, 3, True), (False, 4, False), (False, 4, True), (False, 5, False), (True, 0, True)]
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(docs, labels).collect())
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0
