"""Phrases whose words keep together, counted by sorting suffix pointers.

A pointer stands for the words from its place on, up to ``LONGEST`` of them and not past
the end of their piece. Pointers are routed by their leading two words, and each task
sorts its own by multikey three-way quicksort: a pivot word splits every open partition
into smaller, equal and greater; the size of an equal partition is the count of the phrase
its pointers share, and it is split further by the next word. A partition that holds
fewer than ``least`` pointers can hold no frequent phrase and is abandoned, whichever of
the three it is. All open partitions of a task are split at once, in numpy.

Before that, words are counted. A word below ``least`` ends the phrases around it; words
that surely are so are told by a bitmap of 2^25 bits over the hashes of frequent words, of
which no more than 4 MB is sent around, however many words there are. Equal pointers of a
batch travel as one with their number. A leading pair that holds a large share of all
words is routed by three words instead, a triple by four; no more than ``4 / (3 * SHARE)``
of each can be that frequent, and each is sure to be seen in some batch.

Null text is empty and null language is ``und``; empty tables give no rows. Repeated rows
count as often as they occur; ids play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import small_batches

LONGEST = 4
#: A leading pair or triple with this share of all words is spread over more tasks.
SHARE = 1 / 512
CELL_BITS = 25
#: Pointers that a task gathers before it sends them on, and words a routed task shall hold.
GATHERED, TASK_WORDS = 1_000_000, 1_000_000
TEXT_BYTES = 8 << 20
END = -1


def cell(lang: str, word: str) -> int:
    return zlib.crc32(f"{lang} {word}".encode()) & ((1 << CELL_BITS) - 1)


def words_of(texts: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], list[str]]:
    """(word code, language code) of each word, pieces ended by ``END``, and what the codes stand for."""
    text = pc.fill_null(texts.cast(pa.large_string()), "")
    text = pc.replace_substring_regex(pc.ascii_lower(text), r"[.,;:!?\x0A-\x0D]+", " \n ")
    text = pc.replace_substring(text, "\t", " ")
    scalar = lambda s: pa.scalar(s, pa.large_string())
    text = pc.binary_join_element_wise(text, scalar("\n"), scalar(" "))
    parts = pc.split_pattern(text, " ")
    owner = pc.list_parent_indices(parts)
    flat = parts.flatten()
    real = pc.not_equal(flat, scalar(""))
    coded = flat.filter(real).dictionary_encode()
    names = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if "\n" in names:
        codes[codes == names.index("\n")] = END
    spoken = pc.fill_null(langs.cast(pa.string()), "und").dictionary_encode()
    own = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, own[owner.filter(real).to_numpy(zero_copy_only=False)], names, spoken.dictionary.to_pylist()


def pointers(codes: np.ndarray) -> np.ndarray:
    """Per place the ``LONGEST`` codes from it on, ``END`` from the end of its piece on."""
    out = np.full((len(codes), LONGEST), END, np.int64)
    out[:, 0] = codes
    for k in range(1, LONGEST):
        out[:-k, k] = np.where(out[:-k, k - 1] != END, codes[k:], END) if len(codes) > k else END
    return out


def merged(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``keys`` with their weights added."""
    if not len(keys):
        return keys, weights
    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    new = np.append(True, (keys[1:] != keys[:-1]).any(1))
    return keys[new], np.add.reduceat(weights[order], np.flatnonzero(new))


def frequent_prefixes(keys: np.ndarray, weights: np.ndarray, least: int, routed: int = 2) -> list[tuple[int, int, int]]:
    """(row, length, weight): one row for each run of 2 words or more that at least ``least`` pointers begin with.

    ``keys``: the words of each pointer, ``END`` where it has none. Runs shorter than
    ``routed`` words are only partly here: all of them are returned, whatever their weight.
    """
    out: list[np.ndarray] = []
    ptr = np.arange(len(keys))
    sizes, depth = np.array([len(keys)] if len(keys) else [], np.int64), np.zeros(min(1, len(keys)), np.int64)
    longest = keys.shape[1]
    while len(ptr):
        starts = np.cumsum(sizes) - sizes
        three = [keys[ptr[starts + (sizes - 1) * k // 2], depth] for k in range(3)]
        pivot = np.median(np.stack(three), axis=0).astype(np.int64)
        part = np.repeat(np.arange(len(sizes)), sizes)
        word, middle = keys[ptr, depth[part]], pivot[part]
        # below the routed length nothing is abandoned: the rest may be in other tasks
        floor = np.where(np.maximum(depth + 1, 2) >= routed, least, 1)
        kept_ptr, kept_sizes, kept_depth = [], [], []
        for side in (-1, 0, 1):
            at = np.flatnonzero(word < middle if side < 0 else word == middle if side == 0 else word > middle)
            size = np.bincount(part[at], minlength=len(sizes))
            weight = np.bincount(part[at], weights=weights[ptr[at]], minlength=len(sizes)).astype(np.int64)
            stays = weight >= floor
            if side == 0:
                stays &= pivot != END
                counted = np.flatnonzero(stays & (depth > 0))
                firsts = ptr[at][(np.cumsum(size) - size)[counted]]
                out.append(np.stack([firsts, depth[counted] + 1, weight[counted]], 1))
                stays &= depth + 1 < longest
            stays &= size > 0
            kept_ptr.append(ptr[at][stays[part[at]]])
            kept_sizes.append(size[stays])
            kept_depth.append(depth[stays] + (side == 0))
        ptr, sizes, depth = (np.concatenate(x) for x in (kept_ptr, kept_sizes, kept_depth))
    return [tuple(r) for r in np.concatenate(out).tolist()] if out else []


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(texts, languages) of about ``TEXT_BYTES``, over batches or parts of one; a whole text at least."""
    waiting: list[tuple[pa.Array, pa.Array]] = []
    held = 0
    for batch in batches:
        texts, langs = batch.column(0), batch.column(1)
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(texts):
            room = max(0, TEXT_BYTES - held) + (ends[a - 1] if a else 0)
            b = min(len(texts), max(a + 1, int(np.searchsorted(ends, room, "right"))))
            waiting.append((texts.slice(a, b - a), langs.slice(a, b - a)))
            held += int(ends[b - 1] - (ends[a - 1] if a else 0))
            a = b
            if held >= TEXT_BYTES or a < len(texts):
                yield tuple(pa.concat_arrays(c) for c in zip(*waiting))
                waiting, held = [], 0
    if waiting:
        yield tuple(pa.concat_arrays(c) for c in zip(*waiting))


COUNTED = "lang string, phrase string, n bigint"


def _rows(schema: str, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns], names=[f.split()[0] for f in schema.split(", ")])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word, each pair and triple that may be hot, and (as a null phrase) all words of a language."""
    for texts, langs in _slices(batches):
        codes, own, names, spoken = words_of(texts, langs)
        full = pointers(codes)
        real = codes != END
        for k, lang in enumerate(spoken):
            mine = full[real & (own == k)]
            counts = np.bincount(mine[:, 0], minlength=len(names))
            at = np.flatnonzero(counts)
            yield _rows(COUNTED, pa.array([lang] * (len(at) + 1)), pa.array([names[c] for c in at] + [None], pa.string()), np.append(counts[at], len(mine)))
            # of the whole slice, so that the sum over slices bounds the share of all words
            least = max(2, SHARE / 4 * real.sum())
            often = np.append(counts >= least, False)
            lead = mine[often[mine[:, 0]] & often[mine[:, 1]]]
            for length in (2, 3):
                lead = lead[lead[:, length - 1] != END]
                keys, n = merged(lead[:, :length], np.ones(len(lead), np.int64))
                hot = n >= least
                yield _rows(COUNTED, pa.array([lang] * int(hot.sum()), pa.string()), pa.array([" ".join(names[c] for c in key) for key in keys[hot]], pa.string()), n[hot])


POINTER = "lang string, words string, routed int, n bigint"


def _sender(bitmap: bytes, hot: dict[int, set[tuple[str, str]]]):
    bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in _slices(batches):
            codes, own, names, spoken = words_of(texts, langs)
            for k, lang in enumerate(spoken):
                mine = np.where(own == k, codes, END)
                met = np.unique(mine[mine != END])
                common = np.zeros(len(names) + 1, bool)
                common[met] = bits[[cell(lang, names[c]) for c in met]] == 1 if len(met) else False
                full = pointers(np.where(common[mine], mine, END))
                full = full[full[:, 1] != END]
                for a in range(0, max(1, len(full)), GATHERED):
                    keys, n = merged(full[a : a + GATHERED], np.ones(min(GATHERED, len(full) - a), np.int64))
                    if not len(keys):
                        continue
                    routed = np.full(len(keys), 2, np.int32)
                    for length in (2, 3):
                        place = {w: c for c, w in enumerate(names)}
                        leads = [[place.get(w, END - 1) for w in p.split(" ")] for spoken_in, p in hot[length] if spoken_in == lang]
                        for lead in leads:
                            first = np.searchsorted(keys[:, 0], lead[0]), np.searchsorted(keys[:, 0], lead[0], "right")
                            at = slice(*first)
                            routed[at][(keys[at, :length] == lead).all(1)] = length + 1
                    # no word has a blank, so joined words can be told apart again
                    word = pa.array([*names, None], pa.string())
                    columns = [word.take(pa.array(np.where(keys[:, j] == END, len(names), keys[:, j]))) for j in range(LONGEST)]
                    text = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
                    yield _rows(POINTER, pa.array([lang] * len(keys), pa.string()), text, routed, n)

    return send


def _sorter(least: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        parts = pc.split_pattern(table["words"].combine_chunks(), " ")
        coded = parts.flatten().dictionary_encode()
        names = coded.dictionary
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = np.full((len(sizes), LONGEST), END, np.int64)
        keys[row, place] = coded.indices.to_numpy(zero_copy_only=False)
        spoken = table["lang"].combine_chunks().dictionary_encode()
        own = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        plain = keys[:, 0].copy()
        keys[:, 0] += own * len(names)  # words of different languages are different words
        weights, routed = table["n"].to_numpy(), table["routed"].to_numpy()
        for depth in np.unique(routed).tolist():
            at = np.flatnonzero(routed == depth)
            found = np.array(frequent_prefixes(keys[at], weights[at], least, depth), np.int64).reshape(-1, 3)
            first, length, weight = at[found[:, 0]], found[:, 1], found[:, 2]
            spelled = np.concatenate([plain[first][:, None], keys[first, 1:]], 1)
            spelled[np.arange(LONGEST)[None] >= length[:, None]] = len(names)
            word = pa.array([*names.to_pylist(), None], pa.string())
            text = pc.binary_join_element_wise(*(word.take(pa.array(spelled[:, j])) for j in range(LONGEST)), " ", null_handling="skip")
            yield _rows(COUNTED, spoken.dictionary.take(pa.array(own[first])), text, weight)

    return sort


def _bitmap(words: DataFrame) -> bytes:
    """Bits of the cells of ``words``; at most 2^25 bits in at most 1,024 rows reach the driver."""
    at = F.pmod(F.crc32(F.concat_ws(" ", "lang", "phrase").cast("binary")), F.lit(1 << CELL_BITS))
    rows = words.select(at.alias("at")).groupBy((F.col("at") / 32768).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.col("at") % 32768).alias("bits")
    )
    out = bytearray(1 << (CELL_BITS - 3))
    for row in rows.collect():
        out[row["part"] * 4096 : row["part"] * 4096 + len(row["bits"])] = row["bits"]
    return bytes(out)


def phrase_counts(docs: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of 1 to ``LONGEST`` words with at least ``least`` occurrences,
    and (lang, n): the words of each language. ``docs``: text, lang."""
    small_batches(docs.sparkSession)
    docs = docs.select("text", F.col("lang").cast("string").alias("lang"))
    met = docs.mapInArrow(_count_words, COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    met = stored(met.where((F.col("n") >= least) | F.col("phrase").isNull()))
    totals = met.where("phrase is null").select("lang", "n")
    words = met.where("phrase is not null and not contains(phrase, ' ')")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    # at most 4 / (3 * SHARE) of each length, and each has at least 3/4 of SHARE in the batches that told of it
    heavy = met.where(F.contains("phrase", F.lit(" ")) & (F.col("n") >= SHARE * 3 / 4 * n_words)).select("lang", "phrase").collect()
    hot = {k: {(r["lang"], r["phrase"]) for r in heavy if r["phrase"].count(" ") == k - 1} for k in (2, 3)}
    sent = docs.mapInArrow(_sender(_bitmap(words), hot), POINTER)
    lead = F.expr("substring_index(words, ' ', routed)")
    tasks = max(1, -(-n_words // TASK_WORDS))
    sorted_here = sent.repartition(tasks, "lang", lead).mapInArrow(_sorter(least), COUNTED)
    phrases = sorted_here.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return stored(words.select("lang", "phrase", "n").union(phrases)), totals


def collocations(docs: DataFrame, least: int = 30, best: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases of 2 words or more."""
    counts, totals = phrase_counts(docs, least)
    size = F.size(F.split("phrase", " "))
    # 20 digits hold any count, 38 hold its products
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    found = stored(counts.withColumn("size", size).where("size > 1").withColumnRenamed("n", "a"))
    cuts = found.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumns({
        "first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - size)"),
    })
    part = counts.select("lang", "phrase", "n")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    inside = found.where("size > 2").select(
        "lang", F.col("a").alias("of"), F.split("phrase", " ").alias("words"), F.explode(F.expr("sequence(2, size - 1)")).alias("m"), "size"
    )
    inside = inside.select("lang", "of", "words", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
    inside = inside.select("lang", "of", F.array_join(F.expr("slice(words, at, m)"), " ").alias("phrase")).groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    swallowed: Column = F.coalesce(wide("of") * 100 >= wide("a") * 80, F.lit(False))
    free = lowest.join(inside, ["lang", "phrase"], "left").where(~swallowed)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase"))
    # the best of 16 parts of a language first, so that few rows meet in its one last window
    part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(F.desc("c.score"), F.desc("a"), "phrase"))
    few = free.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(16))).withColumn("place", part).where(F.col("place") <= best)
    top = few.select("lang", "phrase", "a", "c", rank.cast("bigint").alias("rank")).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
