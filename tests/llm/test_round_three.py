"""Operators that were made leaner: same results, with less work."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from footfall.llm import language_model, segmentation, token_files


def test_encoder_words():
    """Texts of common characters are split here, word by word as the library does; other texts go to the library."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = token_files.Encoder(path), Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rng = random.Random(7)
    common, odd = "ab Zé'tsrevmld09.,\n\t\r  -_—…’ΣяДぁ字한ÿ×÷", "²ªµ 　😀\x1c\x0b\x85́ǆ"
    texts = ["".join(rng.choice(common if rng.random() < 0.97 else odd) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["word word, word. (word) \"word's\" words'll\n\n word", "<|endoftext|> a", ""]
    for ids, text in zip(encoder.encode(texts), texts):
        assert np.frombuffer(ids, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids, text
    fresh = token_files.Encoder(path)
    fresh.encode(["a word, a word. a (word) a word"])
    # the word is asked for once without blank and once with it, whatever stands beside it
    assert sorted(fresh.words) == [" (", " a", " word", ")", ",", ".", "a", "word"] and not fresh.known


def test_language_model_steps_add_up_as_before():
    rng = np.random.default_rng(3)
    for rows in (50, 1 << 16, 200_000):  # sorted by digits or not
        at, values = rng.integers(0, rows, 5000), rng.normal(size=(5000, 3))
        at[0] = rows - 1
        got, sums, times = language_model._added(at, values)
        want, inverse, counts = np.unique(at, return_inverse=True, return_counts=True)
        by_hand = np.zeros((len(want), 3))
        np.add.at(by_hand, inverse, values)
        assert (got == want).all() and (times == counts).all() and np.allclose(sums, by_hand)
    words = [b"a", "\u00e9t\u00e9".encode(), b"x" * 100]
    assert language_model.word_hashes(words).tolist() == [language_model.word_hash(w) for w in words]
    assert language_model.word_hashes([]).dtype == np.int64
    model = language_model.Model.start(np.arange(40, 0, -1), 7)
    contexts = rng.integers(0, len(model.context), (9, language_model.BEFORE)).astype(np.int32)
    plain = sum(model.context[contexts[:, k]] * model.near[k] for k in range(language_model.BEFORE))
    assert np.allclose(model.query(contexts), plain)


def test_units_of_runs_are_those_of_whole_texts():
    words = segmentation.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng, units, parts = random.Random(9), segmentation.Units(words), [" ", " ", "\n", "\t", "ab", "c", ",", "'s", "_", "2", "²", "é", "日本", "▁", "\U0010ffff", "x" * 50]
    for _ in range(30):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(60)] + ["", " ", "  ", "a ", " a", "a  b", "a \n b  "]
        of_unit, cuts = units.cut(texts)
        name = list(units.number)
        for text, low, high in zip(texts, cuts, cuts[1:]):
            assert [name[n] for n in of_unit[low:high]] == (segmentation._UNIT.findall(" " + text) if text else []), text


def test_a_unit_enters_the_lattice_once(monkeypatch):
    """Segmentations are the same whether a task meets a unit again in its lattice, in a new one, or for the first time."""
    words = segmentation.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    built = []

    class Lattice(segmentation.Lattice):
        def __init__(self, units, words):
            built.append(list(units))
            super().__init__(units, words)

    monkeypatch.setattr(segmentation, "Lattice", Lattice)
    rng = random.Random(10)
    pool = ["".join(rng.choices("etaoinsé日", k=rng.randint(1, 9))) for _ in range(300)]
    batches = [[" ".join(rng.choices(pool, k=40)) for _ in range(20)] + ["", "  ", "a  b "] for _ in range(6)]
    said = lambda s: (s.doc, s.rank, s.ids.tolist(), round(s.log_prob, 6), round(s.perturbed, 6), round(s.inclusion, 6))

    def run(units):
        out = []
        for b, texts in enumerate(batches):
            out.append([said(s) for s in segmentation.sample([f"{b} {d}" for d in range(len(texts))], texts, words, 3, units)])
        return out

    apart = run(None)
    assert len(built) == len(batches)
    built.clear()
    units = segmentation.Units(words)
    assert run(units) == apart
    every = [u for units in built for u in units]
    assert len(every) == len(set(every)) == len(units.number)
    monkeypatch.setattr(segmentation, "ROOM", 2000)
    assert run(segmentation.Units(words)) == apart
    assert [segmentation.decode(ids, words) for d, _, ids, *_ in apart[0]] == [batches[0][d] for d, *_ in apart[0]]
