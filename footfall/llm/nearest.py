"""Nearest vectors by inner product, through randomly rotated one-bit codes.

Each vector less the nearest of a few centres is rotated into more dimensions, and one
bit a dimension is kept (its sign) with correction scalars: together they give an unbiased
estimate of the inner product with any query and a bound of its error. Vectors and their
codes lie in blocks, and every block of queries meets every block of codes in one task: a
scan of the stated queries against all rows, which costs queries * rows estimates of
``bits`` each. Inside a task the likeliest candidates are compared exactly first; the
20th of those is a score that others must be able to beat, so only vectors whose estimate
plus bound reaches it are compared exactly too. The scores returned are sums of products
in double precision, in the order of the components.

``SIGMAS`` standard deviations bound an estimate's error (a true neighbour exactly at the
limit is missed with probability 0.0013). The centres are fitted on at most ``SAMPLE``
vectors, chosen by a hash of the id; every vector is indexed.

Vectors that are null, empty, zero or hold a null or non-finite component take no part,
nor do rows without id. Vectors of different lengths are never compared. Rows equal in id
and vector are one; rows that share an id with different vectors are queries and candidates
of their own, but never candidates of a query with their id. Of equal vectors only the
``k + 1`` smallest ids are kept with the code, which is all a result can name. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

SIGMAS = 3.0
#: Bits of a code: this many at least, and one a component at least.
MIN_BITS = 512
SAMPLE, CENTRES, ROUNDS = 4096, 32, 8
#: Rows of a block: bounds what one task holds.
BLOCK_ROWS, QUERY_ROWS, TILE = 8192, 1024, 2048
#: Candidates compared exactly before the bound is known, and pairs compared at once.
FIRST, PAIRS = 32, 500_000
SEED = 20240501


def usable(vector: Column) -> Column:
    """Arrays without null or non-finite components, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def n_bits(dim: int) -> int:
    return max(MIN_BITS, -(-dim // 64) * 64)


def rotation(dim: int) -> np.ndarray:
    """``n_bits(dim)`` x ``dim``, orthonormal columns: the part of a random rotation that padded vectors meet."""
    normal = np.random.default_rng([SEED, dim]).standard_normal((n_bits(dim), dim))
    return np.linalg.qr(normal)[0]


def fit_centres(sample: np.ndarray) -> np.ndarray:
    """A few rounds of k-means from ``CENTRES`` spread vectors of ``sample``; at least one centre."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centres = sample[np.random.default_rng(SEED).choice(len(sample), min(CENTRES, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        own = nearest_centre(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None] - 2 * x @ centres.T, axis=1)


def encode(x: np.ndarray, centres: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, centre, scalars) of each row: the estimate is ``q.c + slope * (Pq).signs + shift``,
    its standard deviation ``|q - c| * spread``, and ``length`` bounds what rounding adds."""
    bits = len(turn)
    own = nearest_centre(x, centres)
    c = centres[own]
    rest = x - c
    size = np.sqrt((rest**2).sum(1))
    turned = rest @ turn.T
    up = turned >= 0
    signs = np.where(up, 1.0, -1.0)
    # the cosine between a vector and its code; never 0, for signs agree with what they code
    cosine = np.abs(turned).sum(1) / np.sqrt(bits) / np.where(size > 0, size, 1)
    cosine = np.where(size > 0, np.clip(cosine, 1e-3, 1), 1)
    slope = size / (cosine * np.sqrt(bits))
    shift = (c * rest).sum(1) - slope * ((c @ turn.T) * signs).sum(1)
    spread = size * np.sqrt(np.maximum(0, 1 - cosine**2)) / cosine / np.sqrt(bits - 1)
    length = np.sqrt((x**2).sum(1))
    return np.packbits(up, axis=1), own, np.stack([slope, shift, spread, length])


def exact(queries: np.ndarray, vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs, components added in their order."""
    out = np.zeros(len(i))
    for a in range(0, len(i), PAIRS):
        q, v, sums = i[a : a + PAIRS], j[a : a + PAIRS], out[a : a + PAIRS]
        for d in range(queries.shape[1]):
            sums += queries[q, d] * vectors[v, d]
    return out


def best_pairs(queries: np.ndarray, own_ids: np.ndarray, vectors: np.ndarray, only: np.ndarray, first_ids: np.ndarray,
               codes: np.ndarray, own: np.ndarray, scalars: np.ndarray, centres: np.ndarray, turn: np.ndarray, k: int):
    """(query row, vector row, score) that hold each query's ``k + 1`` best vectors of the block.

    ``first_ids``: the smallest id of each vector; ``only``: whether it has no other. Vectors
    whose only id is the query's own are left out.
    """
    slope, shift, spread, length = (s.astype(np.float32) for s in scalars)
    turned = (queries @ turn.T).astype(np.float32)
    dots = queries @ centres.T
    away = np.sqrt(np.maximum(0, (queries**2).sum(1)[:, None] - 2 * dots + (centres**2).sum(1)[None])).astype(np.float32)
    dots = dots.astype(np.float32)
    # what single precision may add: a few units in the last place of sums of products
    slack = (4e-6 * np.sqrt((queries**2).sum(1))).astype(np.float32)
    limit = np.full(len(queries), -np.inf)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]

    def merged(parts):
        i, j, s = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((first_ids[j], -s, i))
        i, j, s = i[order], j[order], s[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place <= k
        at = place == k - 1
        limit[i[at]] = np.maximum(limit[i[at]], s[at])
        return [(i[keep], j[keep], s[keep])]

    for a in range(0, len(vectors), TILE):
        t = slice(a, min(a + TILE, len(vectors)))
        signs = np.unpackbits(codes[t], axis=1, count=len(turn)).astype(np.float32) * 2 - 1
        high = turned @ signs.T
        high *= slope[t]
        high += shift[t]
        high += dots[:, own[t]]
        high += SIGMAS * away[:, own[t]] * spread[t] + slack[:, None] * (length[t] + np.abs(shift[t]))
        barred = only[t][None] & (own_ids[:, None] == first_ids[t][None])
        high[barred] = -np.inf
        width = t.stop - t.start
        if a == 0:
            n = min(max(FIRST, k), width)
            j = np.argpartition(high, width - n, axis=1)[:, width - n :]
            i = np.repeat(np.arange(len(queries)), n)
            j = j.ravel()
            real = high[i, j] > -np.inf
            i, j = i[real], j[real]
            high[i, j] = -np.inf
            found = merged([*found, (i, j + a, exact(queries, vectors, i, j + a))])
        step = max(1, PAIRS // width)
        for b in range(0, len(queries), step):
            i, j = np.nonzero((high[b : b + step] >= limit[b : b + step, None]) & (high[b : b + step] > -np.inf))
            if len(i):
                found = merged([*found, (i + b, j + a, exact(queries, vectors, i + b, j + a))])
    return found[0]


BLOCK = "dim int, block int, n int, ids binary, n_ids binary, vectors binary, codes binary, centres binary, scalars binary"
QUERIES = "dim int, block int, n int, ids binary, vectors binary"
FOUND = "dim int, query_block int, query_row int, query_id bigint, vec_id bigint, score double"


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _coder(centres: dict[int, np.ndarray]):
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        dim, block = key[0].as_py(), key[1].as_py()
        rows = rows.combine_chunks()
        x = _matrix(rows["vector"].chunk(0), dim)
        ids = rows["ids"].chunk(0)
        codes, own, scalars = encode(x, centres.get(dim, np.zeros((1, dim))), rotation(dim))
        lengths = ids.value_lengths().to_numpy(zero_copy_only=False)
        values = (dim, block, len(x), ids.flatten().to_numpy().tobytes(), lengths.astype(np.int32).tobytes(), x.tobytes(), codes.tobytes(), own.astype(np.int32).tobytes(), scalars.tobytes())
        kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds)], names=[f.split()[0] for f in BLOCK.split(", ")])

    return pack


def _pack_queries(key: tuple, rows: pa.Table) -> pa.Table:
    dim, block = key[0].as_py(), key[1].as_py()
    rows = rows.combine_chunks()
    x = _matrix(rows["vector"].chunk(0), dim)
    values = (dim, block, len(x), rows["vec_id"].to_numpy().tobytes(), x.tobytes())
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([v], t) for v, t in zip(values, kinds)], names=[f.split()[0] for f in QUERIES.split(", ")])


def _searcher(centres: dict[int, np.ndarray], k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, n, m = row["dim"], row["n"], row["q_n"]
                c = centres.get(dim, np.zeros((1, dim)))
                ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["n_ids"], np.int32)
                starts = np.cumsum(sizes) - sizes
                vectors = np.frombuffer(row["vectors"]).reshape(n, dim)
                queries, own_ids = np.frombuffer(row["q_vectors"]).reshape(m, dim), np.frombuffer(row["q_ids"], np.int64)
                i, j, s = best_pairs(
                    queries, own_ids, vectors, sizes == 1, ids[starts], np.frombuffer(row["codes"], np.uint8).reshape(n, -1),
                    np.frombuffer(row["centres"], np.int32), np.frombuffer(row["scalars"]).reshape(4, n), c, rotation(dim), k,
                )
                # every id that a vector may be named by, without the query's own
                many = sizes[j]
                at = np.repeat(starts[j] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                i, s, v = np.repeat(i, many), np.repeat(s, many), ids[at]
                other = v != own_ids[i]
                i, s, v = i[other], s[other], v[other]
                order = np.lexsort((v, -s, i))
                i, s, v = i[order], s[order], v[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, s, v = i[keep], s[keep], v[keep]
                full = lambda x: np.full(len(i), x, np.int32)
                columns = [full(dim), full(row["q_block"]), i.astype(np.int32), own_ids[i], v, s]
                yield pa.record_batch([pa.array(x) for x in columns], names=[f.split()[0] for f in FOUND.split(", ")])

    return search


def _blocked(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``block``, and (dim, blocks): as many blocks of each length as keep them near ``size`` rows."""
    blocks = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    spot = F.xxhash64("vector", F.lit(SEED))
    # lengths of vectors are few: one row each
    return rows.join(blocks, "dim").withColumn("block", F.pmod(spot, F.col("blocks")).cast("int")).drop("blocks"), blocks


def nearest(rows: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of each row for which ``is_query`` holds."""
    spark = rows.sparkSession
    good = rows.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.size(vector).alias("dim"), F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("query")
    )
    good = stored(good.distinct())
    # of equal vectors, the k + 1 smallest ids; Spark keeps only so many of each task
    first = F.row_number().over(Window.partitionBy("dim", "vector").orderBy("vec_id"))
    named = good.select("dim", "vector", "vec_id").withColumn("place", first).where(F.col("place") <= k + 1)
    distinct = stored(named.groupBy("dim", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    centres: dict[int, np.ndarray] = {}
    common = distinct.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if common is not None:
        share = min(1.0, SAMPLE / 2 / common["n"])
        lot = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30))
        sample = distinct.where((F.col("dim") == common["dim"]) & lot).select("vector").limit(SAMPLE).toPandas()["vector"]
        centres[common["dim"]] = fit_centres(np.array([list(v) for v in sample], np.float64).reshape(-1, common["dim"]))
    candidates, n_blocks = _blocked(distinct, BLOCK_ROWS)
    blocks = stored(candidates.groupBy("dim", "block").applyInArrow(_coder(centres), BLOCK))
    asked, n_queries = _blocked(good.where("query").select("dim", "vec_id", "vector"), QUERY_ROWS)
    asked = stored(asked.groupBy("dim", "block").applyInArrow(_pack_queries, QUERIES))

    def copied(packed: DataFrame, times: DataFrame, name: str) -> DataFrame:
        return packed.join(times, "dim").withColumn(name, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    left = copied(blocks, n_queries, "q_block")
    right = asked.select("dim", F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    met = left.join(copied(right, n_blocks, "block"), ["dim", "block", "q_block"])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a row holds two blocks
    try:
        found = stored(met.mapInArrow(_searcher(centres, k), FOUND))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    rank = F.row_number().over(Window.partitionBy("dim", "query_block", "query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The nearest of each row whose id ``every`` divides, among all rows."""
    return nearest(embeddings, F.col("vec_id") % every == 0, k)
