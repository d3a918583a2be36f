"""Each operator against a brute-force version, with nulls, empty texts, ties and clashing names."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import (
    common, decontamination, exact_dedup, language, language_model, line_dedup, near_dedup, queries, segmentation, token_files, toxicity, warc,
)

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def edited(text: str, seed: int, n: int) -> str:
    words, rng = text.split(), random.Random(seed)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts() -> list[tuple]:
    base = [prose(k, 120) for k in range(6)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, edited(base[k % 3], k, 1 + k % 4)) for k in range(40)]
    rows += [(200 + k, base[0]) for k in range(20)]
    rows += [(300, None), (301, ""), (302, "  \n"), (303, "one two"), (304, "ONE two"), (305, prose(9, 4000)), (None, base[1]), (306, "é 日本 🙂\n▂")]
    return rows + [(303, "one two")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), 1) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int").repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_exact(spark, docs, texts, empty):
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs, batches=3).collect())
    same: dict = {}
    for i, t in texts:
        same.setdefault(t or "", []).append(i)
    want = Counter()
    for i, t in texts:
        group = same[t or ""]
        keep = max((x for x in group if x is not None), default=None)
        want[(i, keep, len(group), i == keep, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert got == want
    assert exact_dedup.exact_duplicates(empty).count() == 0
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.selectExpr("coalesce(text, '') t").distinct().count() == len(same)


def test_exact_with_clashing_names_and_many_rows_without_id(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COMPARED", 7)
    rows = [(None, "hot", "a", 1)] * 60 + [(k, "hot", "b", k) for k in range(60)] + [(100 + k, f"t{k % 5}", "c", k) for k in range(15)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, _sha256 string, _llm_sha256 int").repartition(4)
    got = Counter((r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(frame).collect())
    assert got == {(59, 120, True): 1, (59, 120, False): 119, **{(110 + k, 3, True): 1 for k in range(5)}, **{(110 + k, 3, False): 2 for k in range(5)}}
    left = exact_dedup.drop_exact_duplicates(frame)
    assert left.columns == frame.columns and {r.doc_id for r in left.where("doc_id is not null").collect()} == {59, *range(110, 115)}
    assert {(r["_sha256"], r["_llm_sha256"]) for r in left.where("doc_id = 59").collect()} == {("b", 59)}


def test_binary_fuse_filter():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 20_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        built = exact_dedup.build_filter(keys)
        assert exact_dedup.may_hold(keys, *built).all()
        others = rng.integers(2**63, 2**64, 20_000, dtype=np.uint64)
        assert exact_dedup.may_hold(others, *built).mean() < 0.02


def components_by_hand(texts):
    sets = [(i, set(near_dedup.shingle_set(t).tolist())) for i, t in texts if i is not None]
    label = {i: i for i, _ in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = find(i), find(j)
            label[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}, {(i, len(s)) for i, s in sets}


def test_near(docs, texts, empty):
    rows = near_dedup.near_duplicates(docs).collect()
    want, sizes = components_by_hand(texts)
    assert len(rows) == len(texts)
    for r in rows:
        if r.doc_id is not None:
            assert (r.doc_id, r.n_shingles) in sizes
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
        else:
            assert r.component_id is None and r.kept
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_finds_links_between_members_that_miss_the_centre(spark, monkeypatch):
    base = prose(77, 200)
    rows, text = [], base
    for k in range(60):
        text = edited(base if k % 2 else text, k, 6)
        rows.append((k, text))
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want, _ = components_by_hand(rows)
    assert {r.doc_id: r.component_id for r in got.collect()} == want and len(set(want.values())) > 1


def test_components(spark):
    rng = random.Random(3)
    pairs = [(a, a + 1) for a in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = common.components(spark.createDataFrame(pairs, "u long, v long"))
    assert {r.id: r.component for r in got.collect()} == label


def test_language(spark, empty):
    rows = []
    for k in range(400):
        lang = ("en", "de", "fr")[k % 3]
        pool = {"en": "the and with thing", "de": "und der nicht schön", "fr": "été où leur français"}[lang].split()
        rng = random.Random(k)
        rows.append((k, " ".join(rng.choice(pool) for _ in range(rng.randrange(3, 200))), lang, "s", 0))
    rows += [(900, None, "en", "s", 0), (901, "", None, "s", 0), (902, "12 34 !!", "de", "s", 0), (903, "the thing " * 30_000, None, "s", 0)]
    frame = spark.createDataFrame(rows, empty.schema)
    got = {r.doc_id: r for r in language.predicted_languages(frame).collect()}
    held = [k for k in range(400) if got[k].held_out]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k in range(400))
    assert np.mean([got[k].lang_pred == rows[k][2] for k in held]) > 0.95
    assert [got[k].lang_pred for k in (900, 901, 902, 903)] == ["und", "und", "und", "en"] and got[900].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.predicted_languages(frame.withColumn("lang", frame.lang.cast("string")).where("lang is null")).collect()} == {"und"}
    assert language.predicted_languages(empty).count() == 0
    assert language.keep_known_languages(frame).count() == len(rows) - 3


def test_toxicity(spark, empty):
    rng, rows, marks = random.Random(5), [], []
    for k in range(300):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(5, 80))]
        if k % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(["zorgle", "blarfed"])
        rows.append((k, " ".join(words), "en", "s", 0))
        marks.append((k, 1, int(k % 4 == 0)))
    hidden = ["you 1di0t", "ІDІОТ you", "такой idıot", "stu​pid thing", "m0ron", "wasted in the trash can", "stupidity is", None, "", "idi0t " + "x " * 50_000]
    rows += [(1000 + k, t, "en", "s", 0) for k, t in enumerate(hidden)]
    labels = spark.createDataFrame(marks + [(None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(rows, empty.schema)
    got = {r.doc_id: r for r in toxicity.toxicity(frame, labels).collect()}
    held = [k for k in range(300) if got[k].held_out]
    assert np.mean([(got[k].score > 0) == (k % 4 == 0) for k in held]) > 0.95
    assert [got[1000 + k].score > 0 for k in range(10)] == [True, True, True, True, True, False, False, False, False, True]
    assert all(r.predicted == int(r.score >= 0.7) for r in got.values())
    assert toxicity.toxicity(frame, labels.limit(0)).count() == len(rows) and toxicity.toxicity(empty, labels).count() == 0


def repeats_by_hand(rows: list[tuple]) -> list[tuple]:
    """(text, lines removed) of each row, by texts instead of digests; ``rows`` in order."""
    cut = [line_dedup.pieces(t) for _, t in rows]
    first: dict = {}
    groups: dict = {}
    for r, (parts, _) in enumerate(cut):
        for at in line_dedup.anchors(parts):
            window = tuple(parts[at : at + 2])
            first.setdefault(window, (r, at))
            groups.setdefault(window, []).append((r, at))
    spans: dict = {}
    for window, places in groups.items():
        a, b = first[window]
        for r, at in places:
            if r != a or at >= b + 2:
                lines = [at, at + 1]
                if at and b and cut[r][0][at - 1] == cut[a][0][b - 1]:
                    lines.append(at - 1)
                if at + 2 < len(cut[r][0]) and b + 2 < len(cut[a][0]) and cut[r][0][at + 2] == cut[a][0][b + 2]:
                    lines.append(at + 2)
                spans.setdefault((r, a, b - at), set()).update(lines)
    relied = set()
    for window, (r, at) in first.items():
        if len(groups[window]) > 1 and not any(of == r and {at, at + 1} <= lines for (of, _, _), lines in spans.items()):
            relied |= {(r, at), (r, at + 1)}
    gone = {(r, k) for (r, _, _), lines in spans.items() for k in lines} - relied
    out = []
    for r, ((parts, line_of), (_, t)) in enumerate(zip(cut, rows)):
        whole = {k for k in set(line_of) if all((r, p) in gone for p, of in enumerate(line_of) if of == k)}
        kept = [x for k, x in enumerate((t or "").split("\n")) if k not in whole]
        out.append((None if t is None else "\n".join(kept), len(whole)))
    return out


def test_line_dedup(spark, docs, texts, empty):
    shared = "\n".join(prose(k, 6) for k in range(40))
    rng = random.Random(4)
    lines = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    rows = [(k, "\n".join([prose(500 + k, 4), shared, prose(900 + k, 5)]) if k % 2 else prose(k, 9)) for k in range(30)]
    rows += [(40, None), (41, ""), (42, "\n\n\n"), (43, "\n".join(lines)), (44, "\n".join(["x y"] * 9)), (45, "a\nb\na\nb\na\nb")]
    rows += [(50 + k, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 30)))) for k in range(60)]
    rows += [(200, prose(7, 5000)), (201, prose(8, 10) + "\n" + prose(7, 5000)), (202, prose(7, 5000) + " more"), (None, shared)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_chunks int").repartition(4)
    clean = line_dedup.without_repeats(frame)
    assert clean.columns == ["doc_id", "text", "n_chunks", "_n_chunks", "n_removed", "lines_removed"]
    got = {r.doc_id: (r.text, r.lines_removed) for r in clean.collect()}
    want = dict(zip((i for i, _ in rows), repeats_by_hand(rows)))
    assert got == want and sum(n for _, n in got.values()) > 700
    assert want[201][1] == 1 and want[202][1] == 0
    assert line_dedup.without_repeats(empty).count() == 0


def test_line_dedup_of_repeated_rows(spark):
    """Rows that share id and text are documents of their own: one of them keeps its lines."""
    t = "\n".join(prose(k, 7) for k in range(6))
    frame = spark.createDataFrame([(5, t, "p"), (5, t, "q"), (6, t, "r")], "doc_id long, text string, row string").repartition(3)
    rows = line_dedup.without_repeats(frame).collect()
    assert sorted((r.text, r.lines_removed) for r in rows) == [("", 6), ("", 6), (t, 0)] and {r.row for r in rows} == {"p", "q", "r"}
    assert [r.doc_id for r in rows if r.text] == [5]


def test_no_single_line_is_a_passage(spark):
    line = prose(1, 20)
    rows = [(k, "\n".join([prose(100 + k, 6), line, prose(300 + k, 6)])) for k in range(20)]
    got = line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == set(rows)


@pytest.mark.parametrize("words", [(2, 5), (9, 24)])
def test_recall_of_planted_passages(spark, words):
    """Of passages of 2 to 10 lines in texts of their own, nine of ten lines go; nothing else does."""
    rng, rows, planted = random.Random(12), [], {}
    line = lambda: " ".join(f"{rng.choice(WORDS)}{rng.randrange(10**6)}" for _ in range(rng.randint(*words)))
    for n in range(2, 11):
        for _ in range(12):
            passage = [line() for _ in range(n)]
            for copy in range(4):
                own = [[line() for _ in range(rng.randrange(1, 6))] for _ in range(2)]
                planted[len(rows)] = (copy, own, passage)
                rows.append((len(rows), "\n".join([*own[0], *passage, *own[1]])))
    got = line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    caught = sum(r.lines_removed for r in got)
    for r in got:
        copy, own, passage = planted[r.doc_id]
        left = r.text.split("\n")
        assert left[: len(own[0])] == own[0] and left[-len(own[1]) :] == own[1] and (copy or left == [*own[0], *passage, *own[1]])
    whole = sum(len(p) for copy, _, p in planted.values() if copy)
    assert caught >= 0.95 * whole


def test_decontamination(spark, empty):
    items = [(k, prose(2000 + k, 30)) for k in range(8)] + [(8, None), (9, ""), (10, "tiny"), (11, "short but exact words")]
    rows = [(k, prose(k, 50) + " " + (items[k][1] if k < 8 else "") + " " + prose(k + 70, 40)) for k in range(12)]
    rows += [(20, prose(3, 30) + "\n" + items[2][1].upper().replace(" ", " \n ") + " end"), (22, "SHORT but exact words here"), (23, None), (24, "")]
    words = items[4][1].split()
    words[12] = "ab" + words[12][2:]
    rows += [(21, "start " + " ".join(words) + " stop"), (None, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, bench).collect()}
    assert got == {(k, k) for k in range(8)} | {(20, 2), (21, 4), (22, 11), (None, 1)}
    assert decontamination.contaminated(empty, bench).count() == 0 and decontamination.contaminated(frame, bench.limit(0)).count() == 0
    left = decontamination.drop_contaminated(frame, bench)
    assert left.columns == frame.columns and left.count() == len(rows) - 11


def test_banded_alignment():
    rng = random.Random(8)
    for _ in range(60):
        a, b = ("".join(rng.choice("abc") for _ in range(n)) for n in (12, 20))
        best = 99
        row = [0] * (len(b) + 1)
        for k, c in enumerate(a, 1):
            new = [k]
            for j, d in enumerate(b, 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
            row = new
        best = min(row)
        hit = decontamination.banded_alignment(decontamination.code_points(a), decontamination.code_points(b), 99)
        assert hit[0] == best and row[hit[1]] == best


def all_segmentations(text: str, words: segmentation.Vocabulary) -> dict:
    pieces = {b.decode(): i for i, b in enumerate(words.bytes_of) if i > 258}
    out = []

    def extend(rest, ids, weight):
        if not rest:
            out.append((tuple(ids), weight))
        for n in range(1, min(16, len(rest)) + 1):
            if rest[:n] in pieces:
                extend(rest[n:], [*ids, pieces[rest[:n]]], weight * words.weight[pieces[rest[:n]]])

    extend(" " + text, [], 1.0)
    total = sum(w for _, w in out)
    return {ids: w / total for ids, w in out}


def test_sampling_without_replacement():
    words = segmentation.vocabulary(PIECES)
    want = all_segmentations("go on", words)
    n, first, estimate = 4000, Counter(), Counter()
    for s in segmentation.sample([str(k) for k in range(n)], ["go on"] * n, words, 3):
        ids = tuple(s.ids.tolist())
        assert math.isclose(want[ids], math.exp(s.log_prob), rel_tol=1e-6)
        first[ids] += s.rank == 0
        estimate[ids] += want[ids] / s.inclusion / n
    for ids, p in want.items():
        if p > 0.005:
            assert abs(first[ids] / n - p) < 5 * math.sqrt(p / n) and abs(estimate[ids] - p) < 0.02
    few = all_segmentations("a", words)
    assert len(list(segmentation.sample(["x"], ["a"], words, 50))) == len(few)


def test_encoding_round_trip(docs, texts, empty):
    rows = segmentation.sampled_segmentations(docs, PIECES, k=3).collect()
    assert all(r.decoded for r in rows)
    by: dict = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(tuple(r.ids))
    words = segmentation.vocabulary(PIECES)
    for i, t in texts:
        assert all(segmentation.decode(list(ids), words) == (t or "") for ids in by[i])
        assert i in (303, None) or len(set(by[i])) == len(by[i])
    again = segmentation.sampled_segmentations(docs.coalesce(1), PIECES, k=3).collect()
    said = lambda rows: Counter((r.doc_id, r["sample"], tuple(r.ids), round(r.log_prob, 4)) for r in rows)
    assert said(rows) == said(again)
    assert segmentation.sampled_segmentations(empty, PIECES).count() == 0


def test_token_files(spark, docs, texts, empty, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 3000)
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    rows = [(i, t) for i, t in texts if i is not None] + [(400, "a  b\t\tc \n\n d's <|endoftext|>   e\x1c f\xa0 g"), (401, "x" * 5000)]
    rows = list(dict(rows).items())
    files = token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), BPE)
    got = {r.doc_id: r for r in token_files.read_tokens(spark, files).collect()}
    at = 0
    for i, t in sorted(rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (at, len(ids), ids)
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_files.read_tokens(spark, token_files.write_tokens(empty, BPE)).count() == 0
    assert token_files.read_tokens(spark, token_files.write_tokens(docs, BPE)).count() == len(texts)


def test_pieces_have_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 500)
    encoder = token_files.Encoder(BPE)
    parts = [" ", " ", " ", "\n", "\t", "a", "b'", "'s", "1", "\u3000", "\xa0", "\x1c", "<|endoftext|>", "\r", ".", "\u200b", "\U0001f600"]
    choose = random.Random(7)
    for _ in range(20):
        texts = ["".join(choose.choices(parts, k=choose.randint(0, 14))) for _ in range(200)]
        want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == want


def test_blocks_decode_from_any_checkpoint_and_notice_damage():
    rng = np.random.default_rng(2)
    ids = rng.zipf(1.3, 300_000) % 50_000
    symbols, counts = np.unique(ids, return_counts=True)
    table = token_files.Table.of(symbols, counts)
    assert int(table.freq.sum()) == 1 << token_files.SCALE and table.freq.min() >= 1
    block, slots = token_files.encode_block(ids, table), table.by_slot()
    size = token_files.CHECKPOINT * token_files.LANES
    assert (token_files.decode_block(block, table, slots) == ids).all()
    for k in range(len(block.places)):
        assert (token_files.decode_block(block, table, slots, k) == ids[k * size : (k + 1) * size]).all()
    damaged = bytearray(block.payload)
    damaged[len(damaged) // 2] ^= 1
    block.payload = bytes(damaged)
    with pytest.raises(ValueError):
        token_files.decode_block(block, table, slots)


def test_warc(spark, monkeypatch):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
        body = "<p>" + "a" * 1200
        rows = [(1, "u", body), (2, "u\r\nX: 1", body), (3, None, body), (4, "u", None), (5, "u", "short"), (6, "u", "short"), (7, "u", fake * 30)]
        rows += [(8, "u", "WARC/1.1\r\n"), (9, "u", "\r\n\r\n" + fake + "é"), (None, "u", body), (11, "u", fake * 30), (12, "u", "z" * 200_000)]
        rows += [(100 + k, "v", "WARC/1.1\r\n" * (k % 3) + "y" * (k * 7)) for k in range(200)]
        got = {r.page_id: r for r in warc.archived(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, size int").coalesce(2)).collect()}
        assert len(got) == len(rows)
        for i, _, html in rows:
            data, same = (html or "").encode(), [x for x, _, h in rows if h == html and x is not None]
            refers = max(same) if len(data) >= 1000 and max(same) != i else None
            r = got[i]
            assert (r.payload_bytes, r.payload_digest, r.refers_to) == (len(data), hashlib.sha1(data).hexdigest(), refers)
            assert r.record_type == ("revisit" if refers is not None else "response")
        assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_language_model(spark, docs, texts, empty, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 100)
    got = language_model.scored(docs).collect()
    counts: Counter = Counter()
    for i, t in texts:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update(language_model.words_of(t) + [b"\n"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in texts:
        words = language_model.words_of(t) + [b"\n"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want[(i, len(words), sum(counts[w] > 0 for w in words), n, round(base, 4))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert language_model.scored(empty).count() == 0


def test_model_is_normalised():
    rng = np.random.default_rng(4)
    counts = rng.integers(1, 50, 71)
    model = language_model.Model.start(counts, 300)
    every = np.append(np.arange(71), language_model.OTHER)
    contexts = rng.integers(0, len(model.context), (1, language_model.BEFORE)).repeat(72, axis=0)
    assert math.isclose(np.exp(model.log_probabilities(contexts, every)).sum(), 1, rel_tol=1e-5)


def lm_docs(spark, n: int, text):
    return spark.createDataFrame([(k, text(k)) for k in range(n)], "doc_id long, text string").repartition(4)


def test_scores_sum_to_one_over_all_words_and_an_unseen_one(spark, monkeypatch):
    """One-word texts in place of each word: their probabilities, divided by the end's after them, add up to one."""
    monkeypatch.setattr(language_model, "OWN", 12)
    rng = random.Random(2)
    training = lm_docs(spark, 120, lambda k: " ".join(rng.choice(WORDS) for _ in range(12)))
    training = training.withColumn("lot", (training.doc_id % 16).cast("int"))
    counts, words = language_model.count_words(training)
    model = language_model.train(training, words)
    assert len(words.own_counts) == 12
    total = {r["h"]: r["c"] for r in counts.collect()}
    blank = model.own + language_model.SHARED
    every = [b"", *(w.encode() for w in WORDS)]
    _, _, numbers = words.look_up(every)
    numbers[0] = language_model.END
    logs = model.log_probabilities(np.full((len(every), language_model.BEFORE), blank), numbers)
    share = [
        1.0 if n != language_model.OTHER else (total[language_model.word_hash(w)] + 0.1) / words.other_mass for w, n in zip(every, numbers)
    ]
    unseen = math.exp(model.log_probabilities(np.full((1, language_model.BEFORE), blank), np.array([language_model.OTHER]))[0]) * 0.1 / words.other_mass
    assert math.isclose(sum(math.exp(p) * s for p, s in zip(logs, share)) + unseen, 1, rel_tol=1e-5)


def test_training_beats_its_start(spark):
    """Texts in one of two languages of their own: what came before tells the language."""
    rng = random.Random(3)
    two = [[f"{side}{k}" for k in range(40)] for side in "xy"]
    docs = lm_docs(spark, 400, lambda k: " ".join(rng.choice(two[k % 2]) for _ in range(30)))
    rows = [r for r in language_model.scored(docs).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    gain = sum(r.score - r.base_score for r in rows) / tokens
    assert len(rows) > 20 and 0.2 < gain < 0.36  # a word's language is worth log10(2) = 0.301, and the end's place is unknown


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, folder).collect()
    docs = common.table(spark, folder, "documents")
    kept = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = {i for i in kept if i == max(j for j in kept if text[j] == text[i])}
    label, _ = components_by_hand([(i, text[i]) for i in sorted(kept)])
    kept = {i for i in kept if label[i] == i}
    items = [decontamination.plain(r.text) for r in common.table(spark, folder, "benchmark").collect()]
    kept = {i for i in kept if not any(x in decontamination.plain(text[i]) for x in items)}
    assert {r.doc_id for r in rows} == kept and all(r.decoded for r in rows)
    assert set(queries.QUERIES) >= {"pipeline"}
