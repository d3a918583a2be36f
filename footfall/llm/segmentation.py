"""Sampled SentencePiece encodings without replacement, and their decoding.

A text is escaped as the vocabulary expects (a blank in front, blanks as ``▁``) and
cut into units between which no piece reaches: runs of blanks with the characters up
to the next blank, letters apart from punctuation behind them, and line feeds. Runs
over ``LONGEST`` characters are cut there.
Within a unit all pieces that match form a lattice; a character without a piece is
spelled in byte pieces. A task numbers the units it meets and adds the new ones
of each batch to one lattice, until that holds ``ROOM`` characters and the next one is
begun. A segmentation has the product of its pieces' weights, which
fall with their rank in the vocabulary, as its probability.

Segmentations come from a perturbed A-star search. Forward masses give each lattice
node its exact probability of every next piece, so the segmentation with the largest
Gumbel-perturbed log-probability is an ancestral sample. The pieces not taken at a
node form one group, whose largest perturbed value is drawn as a Gumbel below that of
the path; the queue holds these groups, and the best one is opened next. The first
``k`` segmentations out of the queue are a sample without replacement. The largest
value still in the queue is the threshold behind the inclusion scores.

All draws are hashes of (doc_id, sample, character), so a rerun task repeats them.
Null text counts as empty: one segmentation without pieces. Texts with fewer than
``k`` segmentations give as many rows as there are. A ``▁`` in a text decodes as a
blank, as in the library; ``decoded`` is then false.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LONGEST = 48
SAMPLES = 2
#: Characters that are encoded together; one longer text is encoded alone.
CHARS = 600_000
#: Characters of distinct units from which on a task begins a new lattice.
ROOM = 700_000
#: Added to a rank before weights fall with it, and weight per character.
FLAT, PER_CHAR = 50.0, 5.0
BLANK, BREAK = "▁", "\U0010ffff"
_LETTERS = r"[^\W\d_²]"
_UNIT = re.compile(rf" *{_LETTERS}{{1,{LONGEST}}}(?![\w])| *[^ \n]{{1,{LONGEST}}}|\n| +")
_RUN = re.compile(r" *[^ ]+| +")
_END = np.uint64(0xFF51AFD7ED558CCD)


class Trie:
    """Pieces by their characters: one hashed table from (node, character) to node."""

    BITS = 20

    def __init__(self, pieces: list[tuple[int, str]]):
        nodes: dict[str, int] = {"": 0}
        edges = []
        for _, piece in pieces:
            for end in range(1, len(piece) + 1):
                if piece[:end] not in nodes:
                    nodes[piece[:end]] = len(nodes)
                    edges.append((nodes[piece[: end - 1]] << 21 | ord(piece[end - 1]), nodes[piece[:end]]))
        self.piece = np.full(len(nodes), -1, np.int32)
        for i, piece in pieces:
            self.piece[nodes[piece]] = i
        self.key = np.full((1 << self.BITS) + len(edges), -1, np.int64)
        self.node = np.zeros(len(self.key), np.int32)
        for key, node in edges:
            slot = int(self._slot(np.array([key]))[0])
            while self.key[slot] >= 0:
                slot += 1
            self.key[slot], self.node[slot] = key, node

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def step(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The next node of each, -1 where no piece goes on."""
        key = node << 21 | character
        slot = self._slot(key)
        held = self.key[slot]
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):
            slot[open_] += 1
            now = self.key[slot[open_]]
            open_ = open_[(now != key[open_]) & (now >= 0)]
        return np.where(self.key[slot] == key, self.node[slot], np.int32(-1)).astype(np.int64)

    def matches(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, piece) of all pieces in the text, sorted by start, longest first."""
        found = []
        start, node, size = np.arange(len(points), dtype=np.int32), np.zeros(len(points), np.int64), 0
        while len(start):
            node = self.step(node, points[start + size])
            size += 1
            on = np.flatnonzero(node >= 0)
            start, node = start[on], node[on]
            hit = np.flatnonzero(self.piece[node] >= 0)
            found.append((start[hit], np.full(len(hit), size, np.int32), self.piece[node[hit]]))
            on = np.flatnonzero(start + size < len(points))
            start, node = start[on], node[on]
        start, size, piece = (np.concatenate(x) for x in zip(*reversed(found))) if found else (np.empty(0, np.int64),) * 3
        order = np.argsort(start, kind="stable")
        return start[order], size[order], piece[order]


@dataclass
class Vocabulary:
    trie: Trie
    weight: np.ndarray
    bytes_of: list[bytes]
    first_byte: int
    spelled: pa.LargeBinaryArray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        pieces, rank, bytes_of = [], np.full(n, float(n)), []
        first_byte = model.piece_to_id("<0x00>")
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_of.append(bytes([i - first_byte]))
            elif model.is_control(i) or model.is_unknown(i):
                bytes_of.append(b"")
            else:
                bytes_of.append(piece.replace(BLANK, " ").encode())
                pieces.append((i, piece))
                rank[i] = min(-model.get_score(i), n)
        return cls(Trie(pieces), 1.0 / (rank + FLAT), bytes_of, first_byte, pa.array(bytes_of, pa.large_binary()))


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary.load(path)
    return _loaded[path]


def decode_all(ids: np.ndarray, cuts: np.ndarray, words: Vocabulary) -> list[str]:
    """The texts of several encodings, one behind the other and cut at ``cuts``."""
    pieces = words.spelled.take(pa.array(ids, pa.uint32()))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pieces), pa.scalar(b"", pieces.type))
    texts = (x.decode("utf-8", "replace") for x in joined.to_pylist())
    return [x[1:] if x.startswith(" ") else x for x in texts]


def decode(ids: Sequence[int], words: Vocabulary) -> str:
    return decode_all(np.array(ids, np.uint32), np.array([0, len(ids)]), words)[0]


class Lattice:
    """Units side by side; nodes are characters and each unit's end, edges sorted by start.

    ``at`` has each node's first edge, ``p`` the probability of an edge at its start and
    ``upto`` that of the edges up to it.
    """

    FIELDS = {"first": np.int64, "sizes": np.int64, "ends": bool, "at": np.int64, "size": np.int8, "piece": np.int32, "p": float, "upto": float}

    def __init__(self, units: list[str], words: Vocabulary):
        flat = BREAK.join(units).replace(" ", BLANK) + BREAK
        points = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(sizes + 1) - 1
        self.first, self.sizes = ends - sizes, sizes
        self.ends = np.zeros(len(points), bool)
        self.ends[ends] = True
        start, size, piece = words.trie.matches(points.astype(np.int64))
        spelled = ~self.ends
        spelled[start[size == 1]] = False
        spelled = np.flatnonzero(spelled)
        if len(spelled):
            cp = points[spelled].astype(np.int32)
            start = np.concatenate([start, spelled.astype(np.int32)])
            size = np.concatenate([size, np.ones(len(spelled), np.int32)])
            piece = np.concatenate([piece, np.where(cp < 128, cp + np.int32(words.first_byte), -cp)])
            order = np.argsort(start, kind="stable")
            start, size, piece = start[order], size[order], piece[order]
        self.start, self.size, self.piece = start, size, piece
        weight = np.where(self.piece >= 0, words.weight[np.maximum(self.piece, 0)], words.weight[words.first_byte])
        weight = weight * np.exp(PER_CHAR * self.size)
        into = self.start + self.size
        left = (np.repeat(ends, sizes + 1)[self.start] - self.start).astype(np.int16)
        mass = self.ends.astype(np.float64)
        level = np.argsort(left, kind="stable")
        cuts = np.searchsorted(left[level], np.arange(1, int(left.max(initial=0)) + 2))
        for low, high in zip(cuts[:-1], cuts[1:]):
            e = level[low:high]
            if len(e):
                nodes = self.start[e]
                begin = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
                mass[nodes[begin]] = np.add.reduceat(weight[e] * mass[into[e]], begin)
        self.p = weight * mass[into] / mass[self.start]
        del weight, into, left, level
        counts = np.bincount(self.start, minlength=len(points))
        after = np.cumsum(counts)
        self.at = after - counts
        total = np.append(0.0, np.cumsum(self.p))
        self.upto = np.minimum(total[1:] - np.repeat(total[self.at], counts), 1.0)
        self.upto[after[counts > 0] - 1] = 1.0


class _Numbers(dict):
    """Numbers from 0 on; ``fresh`` has the keys that got theirs since it was emptied."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.fresh.append(key)
        return n


def _units_of(runs: list[str]) -> tuple[list[str], np.ndarray]:
    """The units of each run, a blank in front of it, one behind the other, and where each run's begin.

    No unit reaches over a blank but to the character behind it, so runs can be cut side by side.
    """
    units = _UNIT.findall(" " + " ".join(runs)) if runs else []
    heads = np.flatnonzero(np.fromiter(map(str.startswith, units, repeat(" ")), bool, len(units)))
    if len(heads) < len(runs):  # a text ends in blanks, which ran into the next run's
        each = [_UNIT.findall(" " + x) for x in runs]
        units, heads = list(chain.from_iterable(each)), np.cumsum([0, *map(len, each[:-1])])
    return units, heads


class Units:
    """Numbers of the units met so far, and the lattice of all these units."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.held = {name: np.empty(0, kind) for name, kind in Lattice.FIELDS.items()}
        self._begin()

    def _begin(self) -> None:
        self.number, self.used = _Numbers(), dict.fromkeys(Lattice.FIELDS, 0)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts by number, and where each text's begin and the last one's end."""
        if self.used["ends"] > ROOM:
            self._begin()
        runs = [
            [] if not t else [x[1:] for x in _RUN.findall(" " + t)] if "  " in t or t[0] == " " or t[-1] == " " else t.split(" ")
            for t in texts
        ]
        distinct = pa.array(list(chain.from_iterable(runs)), pa.string()).dictionary_encode()
        of_run = distinct.indices.to_numpy()
        units, heads = _units_of(distinct.dictionary.to_pylist())
        numbers = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        if self.number.fresh:
            self._grow(Lattice(self.number.fresh, self.words))
            self.number.fresh = []
        counts = np.diff(np.append(heads, len(units)))[of_run]
        upto = np.append(0, np.cumsum(counts))
        of_unit = numbers[np.repeat(heads[of_run] - upto[:-1], counts) + np.arange(upto[-1])]
        return of_unit, upto[np.cumsum([0, *map(len, runs)])]

    def _grow(self, new: Lattice) -> None:
        nodes, edges = self.used["ends"], self.used["p"]
        new.first += nodes
        new.at += edges
        for name, low in self.used.items():
            values, held = getattr(new, name), self.held[name]
            high = self.used[name] = low + len(values)
            if high > len(held):
                self.held[name] = np.empty(high + high // 2, held.dtype)
                self.held[name][:low] = held[:low]
            self.held[name][low:high] = values

    def node_of(self, edge: int) -> int:
        return int(np.searchsorted(self.held["at"][: self.used["at"]], edge, side="right")) - 1

    def __getattr__(self, name: str) -> np.ndarray:
        if name not in Lattice.FIELDS:
            raise AttributeError(name)
        return self.held[name]


def _uniform(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = key + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(33))) * _END
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _walk(lattice: Units, node: np.ndarray, at: np.ndarray, key: np.ndarray, origin: np.ndarray, edges: np.ndarray) -> None:
    """Ancestral samples of all given units at once; ``edges`` gets one edge per token."""
    ends, first, size, upto = lattice.ends, lattice.at, lattice.size, lattice.upto
    while len(node):
        e, draw = first.take(node), _uniform(key, at - origin)
        more = np.flatnonzero(upto.take(e) <= draw)
        while len(more):
            e[more] += 1
            more = more[upto[e[more]] <= draw[more]]
        edges[at] = e
        step = size.take(e)
        node, at = node + step, at + step
        on = np.flatnonzero(~ends.take(node))
        if len(on) < len(node):
            node, at, key, origin = node.take(on), at.take(on), key.take(on), origin.take(on)


def _below(mu: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel with location ``mu``, given that it lies below ``top``."""
    with np.errstate(divide="ignore", over="ignore"):
        return mu - np.log(np.exp(mu - top) - np.log(u))


def _keys(names: list[str], what: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(n, seed=what) for n in names], np.uint64)


@dataclass
class Sampled:
    doc: int
    rank: int
    ids: np.ndarray
    log_prob: float
    perturbed: float
    inclusion: float


def sample(names: list[str], texts: list[str], words: Vocabulary, k: int = SAMPLES, lattice: Units | None = None) -> Iterator[Sampled]:
    """Up to ``k`` distinct segmentations of each text, best perturbed value first."""
    lattice = lattice or Units(words)
    of_unit, cuts = lattice.cut(texts)
    sizes = lattice.sizes[of_unit]
    starts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    offsets = np.append(starts, total)[cuts]
    doc_of = np.repeat(np.arange(len(texts)), np.diff(cuts))
    queues: list[list] = [[] for _ in texts]
    paths: list[np.ndarray] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []  # of each path: pieces, and where each text's begin
    done: list[list[tuple]] = [[] for _ in texts]
    first = -np.log(-np.log(_uniform(_keys(names, 1), np.zeros(len(names)))))
    for d, t in enumerate(texts):
        if not t:
            done[d].append((0, float(first[d]), 0.0))
    alive = [(d, -1, int(offsets[d]), float(first[d]), 0.0, ()) for d, t in enumerate(texts) if t]
    for rank in range(k):
        if not alive:
            break
        edges = np.full(total, -1, np.int32)
        key, noise = _keys(names, 2 * rank + 2), _keys(names, 2 * rank + 3)
        top, base, fresh = np.zeros(len(texts)), np.zeros(len(texts)), np.full(len(texts), total + 1, np.int64)
        nodes, places, docs_ = [], [], []
        begin_unit = np.full(len(texts), len(starts) + 1, np.int64)
        for d, path, at, value, phi, taken in alive:
            top[d], base[d], fresh[d], begin_unit[d] = value, phi, at, cuts[d]
            if path >= 0:
                node = lattice.node_of(taken[0])
                low, high = int(lattice.at[node]), int(lattice.at[node + 1])
                free = [e for e in range(low, high) if e not in taken]
                share = np.cumsum(lattice.p[free])
                u = float(_uniform(noise[d : d + 1], np.array([at - offsets[d]]))[0])
                e = free[min(int(np.searchsorted(share, u * share[-1])), len(free) - 1)]
                edges[offsets[d] : at] = paths[path][offsets[d] : at]
                edges[at] = e
                taken = (*taken, e)
                rest = 1.0 - float(lattice.p[list(taken)].sum())
                if rest > 1e-12 and len(free) > 1:
                    mu = np.array([phi + np.log(rest)])
                    u = _uniform(noise[d : d + 1] + np.uint64(1), np.array([at - offsets[d]]))
                    heapq.heappush(queues[d], (-float(_below(mu, np.array([value]), u)[0]), path, at, phi, taken))
                base[d] = phi + float(np.log(lattice.p[e]))
                fresh[d] = at + int(lattice.size[e])
                begin_unit[d] = int(np.searchsorted(starts, at, side="right"))
                node += int(lattice.size[e])
                if not lattice.ends[node]:
                    nodes.append(node)
                    places.append(int(fresh[d]))
                    docs_.append(d)
        run = np.flatnonzero(np.arange(len(starts)) >= begin_unit[doc_of])
        owner = np.concatenate([doc_of[run], np.array(docs_, np.int64)])
        _walk(
            lattice, np.concatenate([lattice.first[of_unit[run]], np.array(nodes, np.int64)]),
            np.concatenate([starts[run], np.array(places, np.int64)]), key[owner], offsets[owner], edges,
        )
        paths.append(edges)
        tokens = np.flatnonzero(edges >= 0)
        bounds = np.searchsorted(tokens, offsets)
        chosen, doc = edges.take(tokens), np.repeat(np.arange(len(texts)), np.diff(bounds))
        found.append((lattice.piece.take(chosen), bounds))
        new = np.flatnonzero(tokens >= fresh[doc])
        if len(new) < len(tokens):
            tokens, doc, chosen = tokens[new], doc[new], chosen[new]
        p = lattice.p.take(chosen)
        log_p = np.log(p)
        upto = np.cumsum(log_p)
        head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.empty(0, np.int64)
        lead = np.repeat((upto - log_p)[head], np.diff(np.append(head, len(doc))))
        phi = upto - log_p - lead + base[doc]
        with np.errstate(divide="ignore"):
            mu = phi + np.log(np.where(p > 1 - 1e-12, 0.0, 1 - p))
        g = _below(mu, top[doc], _uniform(noise[doc], tokens - offsets[doc]))
        g[~np.isfinite(g)] = -np.inf
        whole = base.copy()
        if len(head):
            whole[doc[head]] += np.add.reduceat(log_p, head)
            for _ in range(k - rank):  # so many of a path's groups can still be wanted
                best = np.maximum.reduceat(g, head)
                hit = np.flatnonzero(g == np.repeat(best, np.diff(np.append(head, len(doc)))))
                for j in hit[np.append(True, doc[hit][1:] != doc[hit][:-1])]:
                    if g[j] > -np.inf:
                        heapq.heappush(queues[doc[j]], (-float(g[j]), rank, int(tokens[j]), float(phi[j]), (int(edges[tokens[j]]),)))
                        g[j] = -np.inf
        for d, *_ in alive:
            done[d].append((rank, float(top[d]), float(whole[d])))
        if rank + 1 < k:
            alive = [(d, q[1], q[2], -q[0], q[3], q[4]) for d, q in ((d, heapq.heappop(queues[d])) for d, *_ in alive if queues[d])]
    for d in range(len(texts)):
        limit = -queues[d][0][0] if queues[d] and len(done[d]) == k else -np.inf
        for rank, value, log_prob in done[d]:
            pieces, bounds = found[rank] if found else (np.empty(0, np.int32), cuts)
            ids = pieces[bounds[d] : bounds[d + 1]]
            if len(ids) and ids.min() < 0:
                ids = np.array(
                    [x for i in ids.tolist() for x in ([i] if i >= 0 else [b + words.first_byte for b in chr(-i).encode()])], np.int64
                )
            inclusion = 1.0 if limit == -np.inf else -np.expm1(-np.exp(min(log_prob - limit, 50.0)))
            yield Sampled(d, rank, ids.astype(np.uint32), log_prob, value, float(inclusion))


FIELDS = [
    ("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("log_prob", pa.float64()),
    ("perturbed", pa.float64()), ("inclusion", pa.float64()), ("decoded", pa.bool_()), ("ids_crc32", pa.int64()),
]


def sampled_segmentations(docs: DataFrame, path: str, k: int = SAMPLES, with_ids: bool = True) -> DataFrame:
    """One row per document and sampled segmentation; ``with_ids`` adds the ids themselves.

    ``decoded`` says whether the ids decode to the text; ``ids_crc32`` is over the ids
    as little-endian unsigned 32-bit integers.
    """
    small_batches(docs.sparkSession)
    fields = FIELDS + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)

        units = Units(words)

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            texts = [t for _, t in rows]
            got = list(sample([str(i) for i, _ in rows], texts, words, k, units))
            ids = np.concatenate([s.ids for s in got])
            sizes = [len(s.ids) for s in got]
            cuts = np.cumsum([0, *sizes])
            decoded = [text == texts[s.doc] for text, s in zip(decode_all(ids, cuts, words), got)]
            columns = [
                [rows[s.doc][0] for s in got], [s.rank for s in got], sizes, [s.log_prob for s in got], [s.perturbed for s in got],
                [s.inclusion for s in got], decoded, [zlib.crc32(s.ids.astype("<u4").tobytes()) for s in got],
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.view(np.int32))))
            return pa.record_batch(arrays, schema=schema)

        held, chars = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((doc_id, text or ""))
                chars += len(held[-1][1])
                if chars >= CHARS:
                    yield flush(held)
                    held, chars = [], 0
        if held:
            yield flush(held)

    kinds = "doc_id bigint, sample int, n_pieces bigint, log_prob double, perturbed double, inclusion double, decoded boolean, ids_crc32 bigint"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, kinds + (", ids array<int>" if with_ids else ""))
