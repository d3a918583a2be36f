"""Exact duplicates: binary fuse filters of immutable snapshots screen new digests.

A snapshot is a written table of distinct digests with the number of rows of each, and one static filter per shard of its digests. A batch is
first grouped by itself; its distinct digests are then screened shard by shard. A
digest that no filter knows is new. Positives join the snapshot's digests exactly,
and every row of a group is compared byte by byte with the row that stays.

Null text counts as empty and is a text like any other. Rows with equal text and
equal id are one document: all of them report the same decision. A row without id
loses to any row with one; a group without any id keeps all its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import only_ids

#: Distinct digests per shard, so that one filter is built within a few dozen MB.
SHARD_DIGESTS = 200_000
#: So many rows of a group are compared with one copy of the text that stays.
COMPARED = 256
#: Digests this many bytes in all are broadcast; more are joined by shuffle.
BROADCAST_BYTES, DIGEST_BYTES = 8 << 20, 96
FILTER_FIELDS = "shard int, seed bigint, segment int, segments int, prints binary"


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys ^ np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots per key, in three segments that follow each other."""
    first = ((h >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)
    low = np.uint64(segment - 1)
    parts = [(h >> np.uint64(shift)) & low for shift in (0, 16, 40)]
    parts[2] = (parts[2] ^ (h >> np.uint64(7))) & low
    return np.stack([(first + k) * segment + p.astype(np.int64) for k, p in enumerate(parts)])


def _print8(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """A three-wise binary fuse filter with 8-bit prints over distinct uint64 keys.

    Keys that are alone in a slot are peeled round by round; prints are then set in
    reverse order. A seed under which peeling gets stuck is replaced by the next.
    """
    n = len(keys)
    segment = 1 << max(2, min(16, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
    for seed in range(1, 1000):
        segments = max(1, int(np.ceil(n * factor / segment)) - 2) + seed // 20
        h = _mixed(keys, seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
        slots = _slots(h, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(slots.ravel(), minlength=size)
        held = np.zeros(size, np.int64)
        for row in slots:
            np.bitwise_xor.at(held, row, np.arange(n))
        rounds, left = [], n
        front = np.flatnonzero(count == 1)
        while len(front):
            own, at = np.unique(held[front], return_index=True)
            rounds.append((own, front[at]))
            left -= len(own)
            touched = slots[:, own].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(held, touched, np.tile(own, 3))
            front = np.unique(touched)
            front = front[count[front] == 1]
        if left == 0:
            prints, want = np.zeros(size, np.uint8), _print8(h)
            for own, slot in reversed(rounds):
                three = prints[slots[:, own]]
                prints[slot] = want[own] ^ three[0] ^ three[1] ^ three[2]
            return seed, segment, segments, prints.tobytes()
    raise ValueError("keys are not distinct")


def may_hold(keys: np.ndarray, seed: int, segment: int, segments: int, prints: bytes) -> np.ndarray:
    """False only for keys that the filter was not built from."""
    h = _mixed(keys, seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
    table = np.frombuffer(prints, np.uint8)
    three = table[_slots(h, segment, segments)]
    return (three[0] ^ three[1] ^ three[2]) == _print8(h)


def _keys(digests: pd.Series) -> np.ndarray:
    """The first 64 bits of hex digests."""
    return np.array([int(d[:16], 16) for d in digests], np.uint64)


@dataclass(frozen=True)
class Snapshot:
    """Written, never changed: distinct digests and one filter row per shard."""

    digests: DataFrame
    filters: DataFrame
    shards: int


def _among(rows: DataFrame, digests: DataFrame, anti: bool = False) -> DataFrame:
    """The rows whose digest is (or is not) in ``digests``, a stored table of distinct ones."""
    few = digests.count() * DIGEST_BYTES <= BROADCAST_BYTES
    return rows.join(F.broadcast(digests) if few else digests, "text_sha256", "left_anti" if anti else "left_semi")


def _shard(shards: int) -> Column:
    """Taken from the digest's end; the filter keys are its beginning."""
    return F.pmod(F.xxhash64(F.substring("text_sha256", 33, 32)), F.lit(shards)).cast("int")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("text_sha256").agg(F.count("*").alias("n"))


def build_snapshot(groups: DataFrame, shards: int) -> Snapshot:
    digests = stored(groups.withColumn("shard", _shard(shards)))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(_keys(rows["text_sha256"]))
        return pd.DataFrame([(int(rows["shard"].iloc[0]), *build_filter(keys))], columns=["shard", "seed", "segment", "segments", "prints"])

    filters = stored(digests.select("shard", "text_sha256").groupBy("shard").applyInPandas(build, FILTER_FIELDS))
    return Snapshot(digests, filters, shards)


def screen(digests: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The distinct digests that the snapshot's filters may know.

    A shard meets its filter in one group: distinct digests only, whose number per
    shard is bounded by the choice of ``shards``.
    """

    def probe(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        rows = rows[["text_sha256"]]
        if filters.empty or rows.empty:
            return rows[:0]
        row = filters.iloc[0]
        return rows[may_hold(_keys(rows["text_sha256"]), int(row.seed), int(row.segment), int(row.segments), row.prints)]

    left = digests.select("text_sha256", _shard(snapshot.shards).alias("shard"))
    return left.groupBy("shard").cogroup(snapshot.filters.groupBy("shard")).applyInPandas(probe, "text_sha256 string")


def exact_duplicates(docs: DataFrame, batches: int = 2) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    ``docs`` arrive as ``batches`` batches by a hash of the id. Each batch is
    screened against the snapshots of those before it and then becomes one itself.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(
        texts.select(
            "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
            F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
        )
    )
    shards = max(1, rows.count() // (batches * SHARD_DIGESTS) + 1)
    snapshots: list[Snapshot] = []
    met: list[DataFrame] = []
    for k in range(batches):
        groups = _grouped(rows.where(F.col("batch") == k))
        snapshot = build_snapshot(groups, shards)
        for older in snapshots:
            positives = screen(snapshot.digests, older)
            met.append(positives.join(older.digests.select("text_sha256"), "text_sha256"))
        snapshots.append(snapshot)
    # a digest is repeated if its batch holds it twice or a positive met an older snapshot
    repeated = None
    for snapshot in snapshots:
        part = snapshot.digests.where("n > 1").select("text_sha256")
        repeated = part if repeated is None else repeated.union(part)
    for positives in met:
        repeated = repeated.union(positives)
    repeated = stored(repeated.distinct())
    members = stored(_among(rows, repeated).select("doc_id", "text_sha256"))
    # tables of their own, so that joins with them read both sides from files and a hot digest can be split
    keepers = stored(members.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")))
    checked = _byte_checked(texts, members, keepers)
    final = stored(
        checked.groupBy("text_sha256", "other").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    joined = checked.alias("c").join(
        final.alias("f"),
        (F.col("c.text_sha256") == F.col("f.text_sha256")) & F.col("c.other").eqNullSafe(F.col("f.other")),
    ).select("c.doc_id", "f.keep_id", "f.group_size", F.col("c.text_sha256").alias("text_sha256"))
    single = _among(rows, repeated, anti=True).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "text_sha256"
    )
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return single.union(joined).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _byte_checked(texts: DataFrame, members: DataFrame, keepers: DataFrame) -> DataFrame:
    """Members with ``other``: their text if its bytes differ from the keeper's, else null."""
    ids = stored(members.select("doc_id").where("doc_id is not null").distinct())
    bodies = only_ids(texts.where("doc_id is not null"), ids, ["doc_id"]).union(texts.where("doc_id is null"))
    bodies = bodies.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
    parts = F.ceil(F.col("n") / COMPARED)
    # rows without id have to be dealt out too; the table is written, so the salt stays what it is
    salt = F.pmod(F.monotonically_increasing_id(), parts)
    own = stored(bodies.join(keepers, "text_sha256").withColumn("salt", salt))
    heads = own.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("text_sha256", "n").agg(F.first("text").alias("head"))
    # one copy of the text that stays for each part of its group, so none for most
    heads = heads.select("text_sha256", "head", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("salt"))
    return stored(
        own.join(heads, ["text_sha256", "salt"]).select(
            "doc_id", "text_sha256", F.when(F.col("text") != F.col("head"), F.col("text")).alias("other")
        )
    )


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that another row with equal text replaces."""
    out = stored(exact_duplicates(docs).where("not kept").select("doc_id", "text_sha256").distinct())
    digest, own_digest, own_id = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256), _unused(docs, "_sha256"), _unused(docs, "_out_id")
    out = out.select(F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_digest))
    few = out.count() * DIGEST_BYTES <= BROADCAST_BYTES
    keyed = docs.withColumns({own_digest: digest, own_id: F.col("doc_id").cast("bigint")})
    return keyed.join(F.broadcast(out) if few else out, [own_id, own_digest], "left_anti").select(*docs.columns)
