"""Benchmark passages inside documents, by q-gram counting and banded alignment.

Texts are compared after lower-casing and with runs of white space as one blank. A
region of ``REGION`` characters of an item (a whole shorter item) that aligns with a
document within one edit per ``PER_EDIT`` characters shares at least
``length + 1 - Q * (edits + 1)`` q-grams with it, all within ``edits + 1``
neighbouring diagonals. Shared q-grams are counted in diagonal bands of twice that
width that overlap by half, so one band holds them all. In bands that meet the bound
every region of the item that holds as many of them is aligned, all regions at once.

The benchmark is read in slices of bounded size, one scan of the documents each, and
each slice's index is broadcast. Documents are never shuffled. Null and empty texts
match nothing; items shorter than ``SHORTEST`` characters are looked up whole
without edits, and one of exactly ``SHORTEST`` with one edit, as two leave no q-gram.
Items below ``Q`` characters match nothing. Rows without id appear with a null id; equal
rows appear once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import only_ids, small_batches

Q = 11
REGION = 96
PER_EDIT = 16
#: Items below this many characters allow no edit.
SHORTEST = 32
#: Cells of the regions that are aligned together.
CELLS = 1 << 20
#: Characters of benchmark text in one broadcast index.
SLICE_CHARS = 2_000_000
BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of all windows of ``q`` code points."""
    if len(points) < q:
        return np.empty(0, np.uint64)
    power = {1: points.astype(np.uint64) + np.uint64(1)}
    width = 1
    while width * 2 <= q:
        base = np.uint64(pow(int(_ODD), width, 2**64))
        power[width * 2] = power[width][:-width] * base + power[width][width:]
        width *= 2
    n, done, out = len(points) - q + 1, 0, np.zeros(len(points) - q + 1, np.uint64)
    for width in sorted(power, reverse=True):
        if q - done >= width:
            out = out * np.uint64(pow(int(_ODD), width, 2**64)) + power[width][done : done + n]
            done += width
    return out


def _spot(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(31))) * _ODD >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Index:
    ids: list
    points: list[np.ndarray]
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[object, str]]) -> Index:
        kept = [(i, t) for i, t in items if len(t) >= Q]
        points = [code_points(t) for _, t in kept]
        hashes = [gram_hashes(p, Q) for p in points]
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(kept)), [len(x) for x in hashes])
        offset = np.concatenate([np.arange(len(x)) for x in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        grams, first = np.unique(h[order], return_index=True)
        bits = np.zeros(1 << BITS, bool)
        bits[_spot(grams)] = True
        return cls([i for i, _ in kept], points, grams, np.append(first, len(h)), item[order], offset[order].astype(np.int64), bits)


def edits_allowed(length: int) -> int:
    return 0 if length < SHORTEST else length // PER_EDIT


def needed(length: int) -> tuple[int, int]:
    """(edits, shared q-grams) of the shortest region that counts for an item."""
    region = min(length, REGION)
    edits = edits_allowed(region)
    while region + 1 - Q * (edits + 1) < 1 and edits:
        edits -= 1
    return edits, max(1, region + 1 - Q * (edits + 1))


def banded_alignment(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int] | None:
    """(edits, end in text) of the best place of ``item`` in ``text`` within ``most``.

    Starting and ending in ``text`` are free. Each row is one vector operation; the
    running minimum from the left takes in insertions.
    """
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, c in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = k
        new[1:] = np.minimum(row[:-1] + (text != c), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
        if row.min() > most:
            return None
    end = int(row.argmin())
    return (int(row[end]), end) if row[end] <= most else None


def region_edits(item: np.ndarray, text: np.ndarray, starts: np.ndarray, length: int, low: int, high: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end in text) of the regions of ``length`` at ``starts``, over ``most`` where none fits.

    A cell is a diagonal, ``most`` beyond low..high on both sides as far as a path that
    meets low..high can stray; one step takes one character of every region.
    """
    width = high - low + 1 + 2 * most
    left, right = max(0, most - low), max(0, len(item) + high + most + 1 - len(text))
    padded = np.pad(text.astype(np.int64), (left, right), constant_values=-1)
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)
    cells = np.arange(width, dtype=np.int32)
    edits, ends = np.full(len(starts), most + 1), np.zeros(len(starts), np.int64)
    step = max(1, CELLS // width)
    for begin in range(0, len(starts), step):
        own = starts[begin : begin + step]
        cost = np.zeros((len(own), width), np.int32)
        for k in range(length):
            new = cost + (rows[own + (k + low - most + left)] != item[own + k][:, None])
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(new - cells, axis=1) + cells
            if k % 8 == 7 and cost.min() > most:
                break
        else:
            at = cost.argmin(axis=1)
            edits[begin : begin + step] = cost[np.arange(len(own)), at]
            ends[begin : begin + step] = np.clip(own + length + low - most + at, 0, len(text))
    return edits, ends


def verify(item: np.ndarray, text: np.ndarray, low: int, high: int, offsets: np.ndarray) -> tuple[int, int, int, int, int] | None:
    """Aligns an item's regions with a document where q-grams at ``offsets`` of the item lie on diagonals low..high.

    (item start, item end, text start, text end, edits) from the first to the last
    region that fits, or None.
    """
    length = min(len(item), REGION)
    most, least = needed(len(item))
    offsets, starts = np.sort(offsets), np.arange(len(item) - length + 1)
    shared = np.searchsorted(offsets, starts + length - Q, side="right") - np.searchsorted(offsets, starts)
    starts = starts[shared >= least]
    if not len(starts):
        return None
    edits, ends = region_edits(item, text, starts, length, low, high, most)
    fit = np.flatnonzero(edits <= most)
    if not len(fit):
        return None
    s, e = starts[fit], ends[fit]
    return int(s[0]), int(s[-1]) + length, max(0, int(e[0]) - length), int(e[-1]), int(edits[fit].max())


def matches(index: Index, texts: list[str]) -> Iterator[tuple[int, int, tuple[int, int, int, int, int]]]:
    """(text number, item number, aligned region) for prepared texts."""
    if not len(index.grams) or not texts:
        return
    points = [code_points(t) for t in texts]
    gap = np.zeros(Q, "<u4")
    flat = np.concatenate([x for p in points for x in (p, gap)])
    starts = np.cumsum([0] + [len(p) + Q for p in points])
    h = gram_hashes(flat, Q)
    at = np.flatnonzero(index.bits[_spot(h)])
    place = np.searchsorted(index.grams, h[at])
    place[place == len(index.grams)] = 0
    ok = index.grams[place] == h[at]
    at, place = at[ok], place[ok]
    many = index.first[place + 1] - index.first[place]
    hits = np.repeat(at, many)
    if not len(hits):
        return
    within = np.arange(len(hits)) - np.repeat(np.cumsum(many) - many, many)
    entry = np.repeat(index.first[place], many) + within
    item, diagonal = index.item[entry], hits - index.offset[entry]
    doc = np.searchsorted(starts, hits, side="right") - 1
    edits, least = np.array([needed(len(p)) for p in index.points]).T
    # positions within the document: bands are the same whatever stands beside it
    diagonal, offset = diagonal - starts[doc], index.offset[entry]
    half = edits[item] + 1
    # every hit counts in two bands, so any ``half`` neighbouring diagonals share one
    band = diagonal // half
    band, hit = np.concatenate([band, band - 1]), np.tile(np.arange(len(hits)), 2)
    order = np.lexsort((band, item[hit], doc[hit]))
    band, hit = band[order], hit[order]
    key = np.stack([doc[hit], item[hit], band])
    begin = np.append(0, np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1)
    end = np.append(begin[1:], len(hit))
    seen: dict[tuple[int, int], list[tuple[int, int, np.ndarray]]] = {}
    for k in np.flatnonzero(end - begin >= least[key[1, begin]]):
        d, i, b = (int(x) for x in key[:, begin[k]])
        own = hit[begin[k] : end[k]]
        width = int(half[own[0]])
        seen.setdefault((d, i), []).append((b * width, (b + 2) * width - 1, own))
    # bands that follow each other are one region
    for (d, i), bands in sorted(seen.items(), key=lambda x: x[0]):
        merged: list[list] = []
        for low, high, own in bands:
            if merged and low <= merged[-1][1] + 1:
                merged[-1][1] = high
                merged[-1][2].append(own)
            else:
                merged.append([low, high, [own]])
        for low, high, own in merged:
            region = verify(index.points[i], points[d], low, high, offset[np.unique(np.concatenate(own))])
            if region:
                yield d, i, region


FOUND = "doc_id bigint, item_id bigint, item_start int, item_end int, text_start int, text_end int, edits int"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document, item and aligned region (positions in prepared text)."""
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    chars = items.select(F.sum(F.length("text"))).first()[0] or 0
    slices = int(chars) // SLICE_CHARS + 1
    out = None
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        shared = spark.sparkContext.broadcast(Index.of([(i, plain(t)) for i, t in part.toLocalIterator()]))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[d], index.ids[i], *r) for d, i, r in matches(index, [plain(t) for t in batch.column(1).to_pylist()])]
                columns = list(zip(*rows)) if rows else [()] * 7
                kinds = [pa.int64()] * 2 + [pa.int32()] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in FOUND.split(", ")])

        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(scan, FOUND)
        out = rows if out is None else out.union(rows)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which a benchmark passage was found; rows without id stay."""
    ids = stored(contaminated(docs, benchmark).select("doc_id").where("doc_id is not null").distinct())
    return only_ids(docs, ids, ["doc_id"], anti=True)
