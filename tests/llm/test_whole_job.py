"""What the operators once left out."""

from __future__ import annotations

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from footfall.llm import common, decontamination, language, line_dedup, queries, segmentation, token_files

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def characters(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(n))


def with_edits(text: str, places: list[int], rng: random.Random) -> str:
    out = list(text)
    for p in sorted(places, reverse=True):
        out[p : p + 1] = rng.choice([[], ["#"], ["#", out[p]]])
    return "".join(out)


def found(item: str, texts: list[str]) -> set[int]:
    index = decontamination.Index.of([(0, item)])
    return {d for d, _, _ in decontamination.matches(index, texts)}


def by_hand(item: str, text: str) -> bool:
    """Whether any region of the item fits, aligned with the whole text."""
    length = min(len(item), decontamination.REGION)
    most, points = decontamination.needed(len(item))[0], decontamination.code_points(text)
    starts = range(len(item) - length + 1)
    return any(decontamination.banded_alignment(decontamination.code_points(item[s : s + length]), points, most) for s in starts)


def test_bands_hold_insertions_and_deletions_at_every_place():
    rng = random.Random(4)
    for n, edits in ((33, 1), (40, 2), (48, 3)):
        for before in range(24):
            item = characters(rng, n)
            for p in range(1, n - 1, 3):
                places = [p, *rng.sample([x for x in range(n) if x != p], edits - 1)]
                text = characters(rng, before) + with_edits(item, places, rng) + characters(rng, 9)
                own = found(item, [text])
                assert own == ({0} if by_hand(item, text) else set()) == {0}
                # the same whatever stands before it in the batch
                assert found(item, [characters(rng, 1 + p), text]) == {1}


def test_regions_are_aligned_within_their_whole_budget():
    rng = random.Random(5)
    kept = 0
    for k in range(60):
        item = characters(rng, 160 if k % 2 else 96)
        at = rng.randrange(len(item) - 95)
        # edits crowd into a third of the region, or lie anywhere
        room = range(at, at + 32) if k % 3 == 0 else range(at, at + 96)
        part = with_edits(item, rng.sample(room, 5 + k % 4), rng)[at : at + 96 + rng.randrange(3)]
        text = characters(rng, 30) + part + characters(rng, 30)
        want = by_hand(item, text)
        assert found(item, [text]) == ({0} if want else set())
        kept += want
    assert 10 < kept < 60


def test_encodings_are_returned_whole(spark):
    docs = common.table(spark, SF, "documents")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    words = segmentation.vocabulary(PIECES)
    for found in (queries.op5_sentencepiece(spark, SF), corpus_pipeline.encodings(spark, docs, SF)):
        rows = found.collect()
        assert {r.doc_id for r in rows} == set(text)
        assert all(len(r.ids) == r.n_pieces and segmentation.decode(list(r.ids), words) == text[r.doc_id] for r in rows)


def test_unlabelled_corpus_keeps_its_texts(spark):
    rows = [(k, f"some text {k}", None) for k in range(20)] + [(20, None, None), (21, "", None), (22, "12 !", None)]
    kept = language.keep_known_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))


def test_network_decides_on_texts_with_letters(spark):
    pools = {"en": "the and with thing", "de": "und der nicht schön", "fr": "été où leur français"}
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choices(pools[lang].split(), k=40)), lang) for k in range(300) for lang in [list(pools)[k % 3]]]
    rows += [(1000 + k, x, None) for k, x in enumerate("日本語 ЖЖЖЖ ωωω q zzzz अअअ QQ XJX".split())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    score = {r.doc_id: r.score for r in language.predicted_languages(frame).collect()}
    kept = {r.doc_id for r in language.keep_known_languages(frame).collect()}
    assert kept == {i for i, s in score.items() if s >= language.LEAST_SCORE}
    assert set(range(300)) <= kept and len(kept) < len(rows)


def test_special_tokens_get_their_own_ids(spark, tmp_path):
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(7)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y <|endoftext", "", "no token here"]
    texts += ["".join(rng.choices(["<|endoftext|>", " ", "\n", "a", "b'", "<|", "é"], k=8)) for _ in range(200)]
    tokenizer = Tokenizer.from_file(path)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    encoder = token_files.Encoder(path, special=True)
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == want
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    at, rows = 0, queries.op7_token_files(spark, str(tmp_path)).collect()
    for r, ids in zip(sorted(rows, key=lambda r: r.doc_id), want, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
        at += r.n_tokens


def test_short_passages_are_found_whatever_surrounds_them(spark):
    rng, rows, passages = random.Random(8), [], {}

    def line(n: int) -> str:
        return " ".join(characters(rng, rng.randrange(2, 8)) for _ in range(n))

    for n in range(1, 11):
        for k in range(4):
            passage = [line(x) for x in ([50 // n + 1 + rng.randrange(3) for _ in range(n)] if k % 2 else [50, *(rng.randrange(5, 12) for _ in range(n - 1))])]
            for copy in range(3):
                own = ([line(rng.randrange(1, 14)) for _ in range(rng.randrange(4))], [line(rng.randrange(1, 14)) for _ in range(rng.randrange(4))])
                passages[len(rows)] = (copy, passage, own)
                rows.append((len(rows), "\n".join([*own[0], *passage, *own[1]])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in line_dedup.without_repeats(frame).collect():
        copy, passage, (before, after) = passages[r.doc_id]
        assert r.text == "\n".join([*before, *([] if copy else passage), *after])
        assert r.lines_removed == (len(passage) if copy else 0)
