"""Token ids in files: a static range asymmetric numeral system over shared frequencies.

Documents are tokenised once, ids are counted over all of them into one frequency
table, and every range of doc_ids becomes a part: blocks of whole documents in
ascending doc_id order, written as one Parquet row each. A block interleaves
``LANES`` coders, so each step codes that many ids with a few vector operations.
Blocks need nothing but the shared table; every ``CHECKPOINT`` steps they hold the
coders' states, the place in the payload and a checksum, so that decoding can begin
at any checkpoint.

Null text counts as empty: just the end id. Null ids come first; rows with equal
ids keep some order among themselves. A part's blocks are numbered; a document's
place follows from the sums of the parts and blocks before it.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import stored
from .common import small_batches

LANES = 1024
BLOCK_IDS = 1 << 18
CHECKPOINT = 64
SCALE = 20
LOW = np.uint64(1 << 31)
#: Pieces of text whose ids a worker remembers, about 150 bytes each.
REMEMBERED = 1_000_000

#: A space within white space: there a cut could part what the byte-level pattern joins.
_WITHIN = re.compile(r"\s (?:\s|\Z)")
#: The spaces before which a text can always be cut.
_CUT = re.compile(r"(?<=\S) | (?=\S)")
#: Stands between pieces that are tokenised together; a token of its own there.
_MARK = "\t"
#: Latin, Greek, Cyrillic, kana, Chinese and Korean letters that every version of Unicode has.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωА-яぁ-ゖァ-ヺ一-龥가-힣"
#: A character that is none of these, white space and signs of ASCII, nor common punctuation.
_OTHER = re.compile(rf"[^\t\n\r -~{_LETTERS}\u2010-\u2027\u2030-\u205e]")
#: The byte-level pattern, for texts without such a character.
_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\t\n\r 0-9{_LETTERS}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)


def _byte_signs() -> dict[int, int]:
    """The sign that stands for each byte in a byte-level vocabulary, where it is not the byte's own."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in own)}


class _Words(dict):
    """Ids of the pattern's tokens, each asked of the library's model when first met."""

    def __init__(self, tokenizer: Tokenizer, kind: str):
        self.tokenize, self.signs = tokenizer.model.tokenize, _byte_signs()
        self.blank = chr(self.signs[ord(" ")])
        self.own = [np.array([i], kind).tobytes() for i in range(max(tokenizer.get_vocab(True).values()) + 1)]

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            signed = word.replace(" ", self.blank)
        else:
            signed = word.encode().decode("latin-1").translate(self.signs)
        self[word] = ids = b"".join([self.own[t.id] for t in self.tokenize(signed)])
        return ids


class Encoder:
    """Ids of whole texts as bytes, with the ids of known words or pieces remembered.

    A byte-level model sees each token of the byte-level pattern alone. Texts of common
    characters are split by that pattern here, and the model is asked for every token
    once. Others are cut before spaces and their pieces left to the library: the pattern
    begins a token at a space that has another character than white space before or after
    it, so the ids of the pieces strung together are those of the whole text. A text that
    holds an added token is encoded whole. ``special``: special tokens in a text get their
    own ids, as in the library's plain call; else they are spelled out.
    """

    def __init__(self, path: str, special: bool = False):
        self.kind = id_type(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer, self.kind) if _is_plain(self.tokenizer) else None
        self.tokenizer.encode_special_tokens = not special
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        self.added = re.compile("|".join(added)) if added else None
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        #: by piece, without the space that all but a text's first piece have
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, as wide as ``kind``."""
        ways: dict = {}
        for k, t in enumerate(texts):
            if self.added is not None and self.added.search(t):
                way = self._separately
            else:
                way = self._by_piece if self.words is None or _OTHER.search(t) else self._by_word
            ways.setdefault(way, []).append(k)
        ids = {k: x for way, own in ways.items() for k, x in zip(own, way([texts[k] for k in own]))}
        return [ids[k] for k in range(len(texts))]

    def _by_word(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if len(self.words) > REMEMBERED:
                self.words.clear()
            out.append(b"".join(map(self.words.__getitem__, _WORD.findall(text))))
        return out

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        cut = [(_CUT.split(t) if _WITHIN.search(t) else t.split(" ")) for t in texts]
        first = self._separately([pieces.pop(0) for pieces in cut])
        if len(self.known) > REMEMBERED:
            self.known = {}
        found = [list(map(self.known.get, pieces)) for pieces in cut]
        self._learn(list({p for pieces, ids in zip(cut, found) if None in ids for p, i in zip(pieces, ids) if i is None}))
        return [
            f + b"".join(map(self.known.__getitem__, pieces) if None in ids else ids) for f, pieces, ids in zip(first, cut, found)
        ]

    def _separately(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Pieces that begin and end without white space are tokenised as one text, parted by marks."""
        plain = [p for p in pieces if p and p == p.strip() and _MARK not in p] if self.mark is not None else []
        for start in range(0, len(plain), 2000):
            part = plain[start : start + 2000]
            text = " " + f"{_MARK} ".join(part)
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(part) - 1:
                starts, ends = ((x * ids.itemsize).tolist() for x in (np.append(0, marks + 1), np.append(marks, len(ids))))
                flat = ids.tobytes()
                self.known.update(zip(part, (flat[a:b] for a, b in zip(starts, ends))))
        rest = [p for p in pieces if p not in self.known]
        self.known.update(zip(rest, self._separately([" " + p for p in rest])))


def _is_plain(tokenizer: Tokenizer) -> bool:
    """Whether it asks a byte-pair model for each token of the byte-level pattern, and does nothing else."""
    spec = json.loads(tokenizer.to_str())
    split = spec["pre_tokenizer"] or {}
    return (
        not any(spec.get(k) for k in ("normalizer", "truncation", "padding")) and spec["model"].get("type") == "BPE"
        and not any(spec["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    )


@lru_cache(maxsize=2)
def _encoder(path: str, special: bool) -> Encoder:
    """A worker's encoder, kept from task to task."""
    return Encoder(path, special)


def tokenised(docs: DataFrame, path: str, end_id: int, special: bool = False) -> DataFrame:
    """(doc_id, ids), ids as bytes of unsigned 16-bit numbers, or 32-bit for large vocabularies."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, special)
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            ids = [x + end for x in encoder.encode([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids binary")


def id_type(path: str) -> str:
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


@dataclass
class Table:
    """Frequencies that add up to 2^SCALE, with the sums before each symbol."""

    symbols: np.ndarray
    freq: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray, counts: np.ndarray) -> Table:
        order = np.argsort(symbols)
        symbols, counts = symbols[order], counts[order].astype(np.float64)
        freq = np.maximum(1, np.floor(counts / counts.sum() * (1 << SCALE))).astype(np.int64)
        # the rounding rest goes to, or comes from, the most frequent symbols
        rest = (1 << SCALE) - int(freq.sum())
        for k in np.argsort(-freq, kind="stable"):
            if not rest:
                break
            change = rest if rest > 0 else max(rest, 1 - int(freq[k]))
            freq[k] += change
            rest -= change
        return cls(symbols, freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64))

    def by_slot(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.symbols)), self.freq.astype(np.int64))


@dataclass
class Block:
    n: int
    payload: bytes
    states: bytes
    places: list[int]
    sums: list[int]


def encode_block(ids: np.ndarray, table: Table) -> Block:
    n = len(ids)
    place = np.zeros(int(table.symbols[-1]) + 1, np.int64)
    place[table.symbols] = np.arange(len(table.symbols))
    index = place[ids]
    steps = -(-n // LANES)
    x = np.full(LANES, LOW, np.uint64)
    words: list[np.ndarray] = []
    states: dict[int, bytes] = {}
    shift, scale, half = np.uint64(63 - SCALE), np.uint64(SCALE), np.uint64(32)
    for step in range(steps - 1, -1, -1):
        s = index[step * LANES : (step + 1) * LANES]
        f, own = table.freq[s], x[: len(s)]
        full = own >= (f << shift)
        words.append((own[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        own = np.where(full, own >> half, own)
        quotient = own // f
        x[: len(s)] = (quotient << scale) + (own - quotient * f) + table.before[s]
        if step % CHECKPOINT == 0:
            states[step] = x.astype("<u8").tobytes()
    words.reverse()
    ends = np.cumsum([0] + [len(w) for w in words])
    marks = range(0, steps, CHECKPOINT)
    size = CHECKPOINT * LANES
    return Block(
        n, b"".join(w.tobytes() for w in words), b"".join(states[m] for m in marks), [int(ends[m]) for m in marks],
        [zlib.crc32(ids[m * LANES : m * LANES + size].astype("<u4").tobytes()) for m in marks],
    )


def decode_block(block: Block, table: Table, by_slot: np.ndarray, checkpoint: int | None = None) -> np.ndarray:
    """All ids of a block, or those from one checkpoint to the next."""
    words = np.frombuffer(block.payload, "<u4")
    mask, scale, half = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    marks = range(len(block.places)) if checkpoint is None else [checkpoint]
    out = []
    for mark in marks:
        x = np.frombuffer(block.states, "<u8")[mark * LANES : (mark + 1) * LANES].copy()
        at, first = block.places[mark], mark * CHECKPOINT * LANES
        found = []
        for start in range(first, min(block.n, first + CHECKPOINT * LANES), LANES):
            own = x[: min(LANES, block.n - start)]
            slot = own & mask
            s = by_slot[slot.astype(np.int64)]
            own = table.freq[s] * (own >> scale) + slot - table.before[s]
            low = np.flatnonzero(own < LOW)
            own[low] = (own[low] << half) | words[at : at + len(low)]
            at += len(low)
            x[: len(own)] = own
            found.append(s)
        ids = table.symbols[np.concatenate(found)] if found else table.symbols[:0]
        if zlib.crc32(ids.astype("<u4").tobytes()) != block.sums[mark]:
            raise ValueError(f"checksum differs after checkpoint {mark}")
        out.append(ids)
    return np.concatenate(out) if out else table.symbols[:0]


@dataclass(frozen=True)
class TokenFiles:
    """Written blocks and the frequency table they share."""

    blocks: DataFrame
    table: DataFrame


BLOCK_FIELDS = (
    "part int, block int, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary, states binary, "
    "places array<int>, sums array<bigint>"
)


def _frequencies(tokens: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents; each task sends its own sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            part = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(part) > len(total):
                part[: len(total)] += total
                total = part
            else:
                total[: len(part)] += part
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def read_table(rows: DataFrame) -> Table:
    """At most one row per id of the vocabulary reaches the driver."""
    found = rows.select("id", "n").toPandas()
    return Table.of(found["id"].to_numpy(np.int64), found["n"].to_numpy(np.int64))


def write_tokens(docs: DataFrame, path: str, end_id: int = 2, special: bool = False) -> TokenFiles:
    spark, kind = docs.sparkSession, id_type(path)
    tokens = stored(tokenised(docs, path, end_id, special))
    table = stored(_frequencies(tokens, kind))
    shared = spark.sparkContext.broadcast(read_table(table)) if not tokens.isEmpty() else None

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, docs_, size = [], [], 0

        def flush() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), kind).astype(np.int64)
            b = encode_block(flat, shared.value)
            row = {
                "part": part, "block": number, "n_ids": b.n, "doc_ids": docs_, "lengths": [len(x) // np.dtype(kind).itemsize for x in ids],
                "payload": b.payload, "states": b.states, "places": b.places, "sums": b.sums,
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            for doc_id, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(x)
                docs_.append(doc_id)
                size += len(x) // np.dtype(kind).itemsize
                if size >= BLOCK_IDS:
                    yield flush()
                    ids, docs_, size, number = [], [], 0, number + 1
        if ids:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
    return TokenFiles(stored(ordered.mapInArrow(write, BLOCK_FIELDS)), table)


def read_tokens(spark: SparkSession, files: TokenFiles, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) and, on request, the ids, from the files alone."""
    empty = files.table.isEmpty()
    shared = None if empty else spark.sparkContext.broadcast(read_table(files.table))
    names = ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + ([pa.list_(pa.int64())] if with_ids else [])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        by_slot = table.by_slot()
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(Block(row["n_ids"], row["payload"], row["states"], row["places"], row["sums"]), table, by_slot)
                ends = np.cumsum(row["lengths"])
                columns: list[list] = [[] for _ in names]
                for doc_id, end, n in zip(row["doc_ids"], ends.tolist(), row["lengths"]):
                    own = ids[end - n : end].astype("<u4")
                    values = [row["part"], row["block"], doc_id, end - n, n, zlib.crc32(own.tobytes())] + ([own.tolist()] if with_ids else [])
                    for c, v in zip(columns, values):
                        c.append(v)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    extra = ", ids array<bigint>" if with_ids else ""
    rows = files.blocks.mapInArrow(read, "part int, block int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + extra)
    sizes = files.blocks.select("part", "block", "n_ids")
    # one row per part: a small table, whatever the number of documents
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    within = sizes.withColumn("inside", F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids"))
    starts = within.join(parts.select("part", "before"), "part").select("part", "block", (F.col("before") + F.col("inside")).alias("base"))
    return rows.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )
