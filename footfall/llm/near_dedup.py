"""Near duplicates: MinHash with tensored banding, confirmed on full shingle sets.

Two collections of ``BANDS`` sub-keys (two minhashes each) are computed; table keys
are all pairs of a sub-key of the first and one of the second collection, so 100
tables need 40 minhashes instead of 400. Two texts of similarity 0.75 share a table
with probability (1 - (1 - 0.75^2)^10)^2 = 0.9995.

Texts with equal shingle sets form a class, and classes are compared through their
smallest doc_id. A class can meet another only if both collections hold a sub-key
that some other class has too, so pairs are formed from such sub-keys alone. In each
table all classes are compared with one centre, the one whose sub-keys are most
common. Tables whose members then still lie in more than one component are compared
in blocks, but only across components, so no link that could join two components is
lost, however large a table is.

Null or empty text, or text without words: an empty set, linked with nothing. Rows
without id link with nothing and are kept. Rows that share an id are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import BROADCAST_IDS, components, only_ids, small_batches

WORDS = 5
BANDS = 10
HASHES = 4 * BANDS
#: Members per block where open tables are compared across components.
BLOCK = 1024
#: Shingles per matrix product there.
SLICE = 4096
#: Equal minhashes of 40 below which similarity 0.75 is ruled out: 4.4 standard deviations.
AGREE = 18
#: Words whose hashes a worker remembers.
REMEMBERED = 100_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(8)
_XOR = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of five words.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased; a
    text of one to four words is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mix(out * _MIX + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = (shingles[start : start + 4096, None] ^ _XOR) * _ODD
        part ^= part >> np.uint64(31)
        np.minimum(out, part.min(axis=0), out=out)
    return out


SKETCH = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
    ("subkeys", pa.list_(pa.int64())), ("sketch", pa.binary()),
])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in SKETCH]
        for text in batch.column(1).to_pylist():
            s = shingle_set(text)
            columns[1].append(len(s))
            if len(s):
                signature = xxhash.xxh3_128_digest(s.tobytes())
                m = minhashes(s)
                sub = _mix(_mix(m[0::2]) * _MIX + m[1::2])
                for c, v in zip(columns[2:], (*np.frombuffer(signature, np.int64).tolist(), sub.view(np.int64), (m >> np.uint64(32)).astype(np.uint32).tobytes())):
                    c.append(v)
            else:
                for c in columns[2:]:
                    c.append(None)
        yield pa.record_batch([batch.column(0)] + [pa.array(c, f.type) for c, f in zip(columns[1:], list(SKETCH)[1:])], schema=SKETCH)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets have 100 * intersection >= 75 * union.

    Sets travel once per pair, to the pair's centre ``v``; few pairs are broadcast to them.
    """
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv"))
    pairs = pairs.select("u", "v")
    few = pairs.count() <= BROADCAST_IDS // 2
    both = left.join(F.broadcast(pairs) if few else pairs, "u").join(right, "v")
    shared = F.size(F.array_intersect("su", "sv"))
    union = F.size("su") + F.size("sv") - F.col("shared")
    return both.withColumn("shared", shared).where(100 * F.col("shared") >= 75 * union).select("u", "v").distinct()


def _fits(a: str, b: str):
    """Similarity 0.75 needs set sizes of at least that ratio."""
    return (4 * F.col(a) >= 3 * F.col(b)) & (4 * F.col(b) >= 3 * F.col(a))


def _shared_counts(sa: list[np.ndarray], sb: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of all sets of the first with all of the second list.

    Products of 0/1 matrices over slices of the shingles that both sides hold.
    """
    both = np.intersect1d(np.concatenate(sa), np.concatenate(sb))
    counts = np.zeros((len(sa), len(sb)), np.float32)
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (sa, sb)]
    flat = [np.concatenate(s) for s in (sa, sb)]
    for start in range(0, len(both), SLICE):
        part = both[start : start + SLICE]
        sides = []
        for r, f, n in zip(rows, flat, counts.shape):
            at = np.minimum(np.searchsorted(part, f), len(part) - 1)
            hit = part[at] == f
            m = np.zeros((n, len(part)), np.float32)
            m[r[hit], at[hit]] = 1
            sides.append(m)
        counts += sides[0] @ sides[1].T
    return counts


def _links_across(a: pd.DataFrame, b: pd.DataFrame, alone: bool) -> list[tuple[int, int]]:
    """Links that join components, between two blocks or within one (``alone``)."""
    sa, sb = (np.stack([np.frombuffer(x, np.uint32) for x in g["sketch"]]) for g in (a, b))
    na, nb, ca, cb = (g[c].to_numpy() for c in ("n_shingles", "component") for g in (a, b))
    may = np.zeros((len(a), len(b)), bool)
    for k in range(len(a)):
        ok = (cb > ca[k] if alone else cb != ca[k]) & (4 * nb >= 3 * na[k]) & (4 * na[k] >= 3 * nb)
        at = np.flatnonzero(ok)
        may[k, at[(sb[at] == sa[k]).sum(axis=1) >= AGREE]] = True
    ra, rb = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    if not len(ra):
        return []
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    ia, ib, out = a["id"].to_numpy(), b["id"].to_numpy(), []
    right = [b["shingles"].iloc[j] for j in rb]
    for start in range(0, len(ra), 512):
        rows = ra[start : start + 512]
        shared = _shared_counts([a["shingles"].iloc[k] for k in rows], right)
        linked = (100 * shared >= 75 * (na[rows][:, None] + nb[rb][None, :] - shared)) & may[np.ix_(rows, rb)]
        for k, j in zip(*np.nonzero(linked)):
            x, y = find(int(ca[rows[k]])), find(int(cb[rb[j]]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(ia[rows[k]]), int(ib[rb[j]])))
    return out


def _across(rows: pd.DataFrame) -> pd.DataFrame:
    """Exact links across components for all pairs of blocks in a group."""
    out: list[tuple[int, int]] = []
    for (_, lo, hi), group in rows.groupby(["family", "lo", "hi"]):
        if lo == hi:
            out += _links_across(group, group, True)
        else:
            a, b = group[group["blk"] == lo], group[group["blk"] == hi]
            if len(a) and len(b):
                out += _links_across(a, b, False)
    return pd.DataFrame({"u": pd.Series([x for x, _ in out], dtype="int64"), "v": pd.Series([x for _, x in out], dtype="int64")})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketches = stored(
        texts.mapInArrow(_sketches, "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, subkeys array<bigint>, sketch binary")
    )
    filled = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = stored(filled.groupBy("s1", "s2").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles")))
    # one row of sub-keys per class: that of its smallest id
    reps = stored(
        filled.select("s1", "s2", F.col("doc_id").alias("id"), "subkeys", "sketch", "n_shingles")
        .join(classes.select("s1", "s2", "id"), ["s1", "s2", "id"], "left_semi")
        .dropDuplicates(["s1", "s2"])
    )
    sub = reps.select("id", F.posexplode("subkeys").alias("pos", "val"))
    common = stored(sub.groupBy("pos", "val").agg(F.count("*").alias("c")).where("c > 1"))
    hits = sub.join(common, ["pos", "val"])
    keys = stored(_tensored(hits))
    centres = stored(
        keys.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("top"), F.count("*").alias("members"))
        .where("members > 1").select("key", (-F.col("top.id")).alias("v"), "members")
    )
    tables = stored(keys.join(centres, "key").select("key", "id", "v", "members"))
    sizes = reps.select("id", "n_shingles")
    ids = stored(tables.select(F.col("id").alias("doc_id")).distinct())
    sets = only_ids(texts, ids, ["doc_id"]).mapInArrow(_sets, "doc_id bigint, shingles array<bigint>")
    sets = stored(sets.where(F.size("shingles") > 0))

    def tried(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where("u != v").distinct()
        pairs = pairs.join(sizes.select(F.col("id").alias("u"), F.col("n_shingles").alias("nu")), "u")
        pairs = pairs.join(sizes.select(F.col("id").alias("v"), F.col("n_shingles").alias("nv")), "v")
        return stored(pairs.where(_fits("nu", "nv")).select("u", "v"))

    links = stored(confirm(tried(tables.select(F.col("id").alias("u"), "v")), sets))
    found = components(links)
    open_rows, left = _open_tables(tables, found)
    # tables whose members lie in more than one component are compared in blocks, all of them
    if left:
        links = stored(links.union(_block_links(open_rows, reps, sets)))
        found = components(links)
    named = stored(
        classes.join(found, "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("component_id"))
    )
    out = sketches.select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _tensored(hits: DataFrame) -> DataFrame:
    """(key, id, weight): the pairs of sub-keys that other classes have too."""
    both = hits.groupBy("id").agg(F.collect_list(F.struct("pos", "val")).alias("hits"), F.sum("c").alias("weight"))
    first = F.filter("hits", lambda h: h["pos"] < BANDS)
    second = F.filter("hits", lambda h: h["pos"] >= BANDS)
    each = both.select("id", "weight", F.explode(first).alias("a"), second.alias("second"))
    each = each.select("id", "weight", "a", F.explode("second").alias("b"))
    return each.select(F.xxhash64("a.pos", "a.val", "b.pos", "b.val").alias("key"), "id", "weight")


def _open_tables(tables: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
    """(key, id, members, component) of tables in more than one component, and the rows
    outside the component that their table's smallest label names."""
    placed = tables.join(found, "id", "left").select("key", "id", "members", F.coalesce("component", "id").alias("component"))
    spread = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rows = stored(placed.join(spread.select("key", "low"), "key"))
    return rows.drop("low"), rows.where("component != low").count()


def _block_links(open_rows: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that join components among the members of open tables.

    Components that share open tables form a family, so its edges are counted per
    component, however many members a component has; each pair of a family's blocks is
    one unit of work, which confirms its links on the full sets and returns only joining
    ones.
    """
    held = stored(open_rows.select("key", "component").distinct())
    hubs = held.groupBy("key").agg(F.min("component").alias("v"))
    edges = held.select("key", F.col("component").alias("u")).join(hubs, "key").where("u != v").select("u", "v").distinct()
    family = components(stored(edges)).select(F.col("id").alias("component"), F.col("component").alias("family"))
    members = open_rows.select("id", "component").distinct().join(family, "component")
    members = stored(members)
    sizes = members.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n"))
    rows = members.join(sizes, "family").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.join(reps.select("id", "sketch", "n_shingles"), "id").join(sets.select(F.col("doc_id").alias("id"), "shingles"), "id")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "family", "id", "component", "sketch", "n_shingles", "shingles", "blk",
        F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"),
    )
    total = sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    # small families share a group, a pair of full blocks has its own
    rows = rows.withColumn("g", F.pmod(F.xxhash64("family", "lo", "hi"), F.lit(int(total) // 1_000 + 1)))
    return rows.groupBy("g").applyInPandas(_across, "u bigint, v bigint").distinct()


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id."""
    gone = stored(near_duplicates(docs).where("not kept").select("doc_id").distinct())
    return only_ids(docs, gone, ["doc_id"], anti=True)
