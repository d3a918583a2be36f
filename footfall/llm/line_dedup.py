"""Repeated passages of lines, found by anchors at content-defined places.

Each line is hashed, and a rolling hash runs over every ``WINDOW`` lines. Where it is
smaller than at the place before or after, a chunk begins: its first ``WINDOW`` lines are
its anchor. Of any ``WINDOW + 1`` lines that stand together in two texts at least one
window is chosen in both, whatever surrounds them. A window of ``WORDS`` words or more is
always chosen. A line of ``LONG_WORDS`` words or more counts as several lines (pieces) of
about ``PIECE_WORDS`` words, since a passage may be written as one line.

Anchors with equal digests are one group all over the corpus; its first member (by
doc_id, row, place) stays. The others are joined up with their neighbours that lie alike
towards the same text, extended by the line before and after where it is equal as well,
and compared byte by byte with that text: only then do the lines go, and only whole lines.
Chunks of a single line never go, nor does an anchor that other texts rely on, unless it
is part of a passage that an earlier text holds too. So the first of equal lines always
stays, and whatever goes stands somewhere before.

Digests are shuffled first; of texts, only the passages that stay are read and sent to
the rows that repeat them. Rows that repeat nothing are not shuffled while their number
allows it, see ``only_ids``.

Null text stays null and has no lines; empty text is one empty line. Each row is a
document of its own, also when it shares its id and text with others; rows without id
come last, and among equal ids the order of reading decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import only_ids, small_batches

WINDOW = 2
#: A window of so many words is chosen whatever its hash; a line of so many is read in pieces.
WORDS, LONG_WORDS, PIECE_WORDS = 40, 50, 25
_ODD = np.uint64(0x9E3779B97F4A7C15)


def pieces(text: str | None) -> tuple[list[str], list[int]]:
    """The pieces of a text and the line that each belongs to."""
    out: list[str] = []
    line_of: list[int] = []
    for k, line in enumerate(text.split("\n") if text is not None else []):
        n = line.count(" ") + 1
        if n < LONG_WORDS:
            out.append(line)
            line_of.append(k)
            continue
        words, parts = line.split(" "), n // PIECE_WORDS
        ends = [n * (p + 1) // parts for p in range(parts)]
        out += [" ".join(words[a:b]) for a, b in zip([0, *ends], ends)]
        line_of += [k] * parts
    return out, line_of


def anchors(parts: list[str]) -> list[int]:
    """Where the windows stand that are chosen: at least one of any two neighbours."""
    if len(parts) < WINDOW:
        return []
    h = np.array([xxhash.xxh3_64_intdigest(p) for p in parts], np.uint64)
    rolled = h[: len(h) - WINDOW + 1].copy()
    for k in range(1, WINDOW):
        rolled = rolled * _ODD + h[k : len(h) - WINDOW + 1 + k]
    rolled = (rolled ^ (rolled >> np.uint64(29))) * _ODD
    chosen = np.zeros(len(rolled), bool)
    chosen[:-1] |= rolled[:-1] <= rolled[1:]
    chosen[1:] |= rolled[1:] < rolled[:-1]
    if len(rolled) == 1:
        chosen[:] = True
    words = np.array([p.count(" ") + 1 for p in parts])
    chosen |= sum(words[k : len(words) - WINDOW + 1 + k] for k in range(WINDOW)) >= WORDS
    return np.flatnonzero(chosen).tolist()


def _bytes(parts: list[str], start: int, n: int) -> str:
    return "\n".join(parts[start : start + n])


ANCHOR = "array<struct<at:int,h1:bigint,h2:bigint,before:bigint,after:bigint>>"


def _anchors(texts: pd.Series) -> pd.Series:
    def neighbour(parts: list[str], k: int) -> int | None:
        return int(np.uint64(xxhash.xxh3_64_intdigest(parts[k], 1)).astype(np.int64)) if 0 <= k < len(parts) else None

    out = []
    for text in texts:
        parts, _ = pieces(text)
        rows = []
        for at in anchors(parts):
            h1, h2 = np.frombuffer(xxhash.xxh3_128_digest(_bytes(parts, at, WINDOW)), np.int64).tolist()
            rows.append({"at": at, "h1": h1, "h2": h2, "before": neighbour(parts, at - 1), "after": neighbour(parts, at + WINDOW)})
        out.append(rows)
    return pd.Series(out)


BODY = "array<struct<k_start:int,n:int,body:string>>"
CLEAN = "text string, n_removed int, lines_removed int"
RUN = "row bigint, start int, n int, k_row bigint, k_start int"


def runs_of(members: Iterable[tuple[int, int, int, bool, bool, bool]]) -> list[tuple[int, int, int, int]]:
    """(start, n, k_row, k_start) of one text's repeated passages.

    ``members``: (at, k_row, k_at, the line before is equal too, the line after, whether
    others rely on this anchor). An anchor that others rely on is left out, unless the
    text that a passage repeats holds all of it as well.
    """
    spans: dict[tuple[int, int], set[int]] = {}
    needed: list[set[int]] = []
    for at, k_row, k_at, left, right, stays in members:
        if stays:
            needed.append(set(range(at, at + WINDOW)))
        else:
            spans.setdefault((k_row, k_at - at), set()).update(range(at - left, at + WINDOW + right))
    relied = set().union(*(n for n in needed if not any(n <= found for found in spans.values())))
    out: list[list[int]] = []
    for (k_row, shift), found in sorted(spans.items()):
        for k in sorted(found - relied):
            if out and out[-1][2:] == [k_row, shift] and out[-1][0] + out[-1][1] == k:
                out[-1][1] += 1
            else:
                out.append([k, 1, k_row, shift])
    return [(a, n, k_row, a + shift) for a, n, k_row, shift in out]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    for batch in batches:
        rows = [
            (row, *run)
            for row, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for run in runs_of((m["at"], m["k_row"], m["k_at"], m["left"], m["right"], m["stays"]) for m in members)
        ]
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in RUN.split(", ")])


def repeated_runs(keyed: DataFrame) -> DataFrame:
    """Passages that repeat an earlier text, by digests. ``keyed``: row, doc_id, anchors."""
    found = keyed.select("row", "doc_id", F.inline("anchors"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "at", "before", "after")
    groups = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("members")).where("members > 1")
    groups = stored(groups.select("h1", "h2", *[F.col(f"first.{c}").alias(f"k_{c}") for c in ("row", "at", "before", "after")]))
    # both sides are read from files, so that Spark may split a digest that is everywhere
    met = found.join(groups, ["h1", "h2"])
    same_row = F.col("row") == F.col("k_row")
    stays = same_row & (F.col("at") == F.col("k_at"))
    apart = ~same_row | (F.col("at") >= F.col("k_at") + WINDOW)
    member = F.struct(
        "at", "k_row", "k_at", F.coalesce(F.col("before") == F.col("k_before"), F.lit(False)).alias("left"),
        F.coalesce(F.col("after") == F.col("k_after"), F.lit(False)).alias("right"), stays.alias("stays"),
    )
    per_row = met.where(stays | apart).groupBy("row").agg(F.collect_list(member).alias("members"))
    return per_row.where(F.exists("members", lambda m: ~m["stays"])).mapInArrow(_merge, RUN)


def _bodies(texts: pd.Series, wanted: pd.Series) -> pd.Series:
    out = []
    for text, spans in zip(texts, wanted):
        parts, _ = pieces(text)
        out.append([{"k_start": int(s["k_start"]), "n": int(s["n"]), "body": _bytes(parts, s["k_start"], s["n"])} for s in spans])
    return pd.Series(out)


def _clean(texts: pd.Series, passages: pd.Series) -> pd.DataFrame:
    out = []
    for text, spans in zip(texts, passages):
        parts, line_of = pieces(text)
        gone, used = np.zeros(len(parts), bool), 0
        for s in spans:
            if _bytes(parts, s["start"], s["n"]) == s["body"]:
                gone[s["start"] : s["start"] + s["n"]] = True
        whole = np.ones(line_of[-1] + 1, bool)
        np.logical_and.at(whole, line_of, gone)
        for s in spans:
            used += bool(whole[line_of[s["start"]] : line_of[s["start"] + s["n"] - 1] + 1].any())
        kept = [line for line, drop in zip(text.split("\n"), whole) if not drop]
        out.append(("\n".join(kept), used, int(whole.sum())))
    return pd.DataFrame(out, columns=["text", "n_removed", "lines_removed"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned ``text`` and ``n_chunks``, ``n_removed``, ``lines_removed`` added last.

    ``n_chunks``: the anchors of the whole text; ``n_removed``: passages that went, whole
    or in part. Their names get a leading underscore where ``docs`` has them already.
    """
    small_batches(docs.sparkSession)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    keyed = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.pandas_udf(_anchors, ANCHOR)("text").alias("anchors"), own.alias("own"),
    ))
    runs = stored(repeated_runs(keyed.select("row", "doc_id", "anchors")))
    wanted = stored(runs.select("k_row", "k_start", "n").distinct().groupBy(F.col("k_row").alias("row")).agg(F.collect_list(F.struct("k_start", "n")).alias("wanted")))
    sources = only_ids(keyed.select("row", "text"), wanted.select("row"), ["row"]).join(wanted, "row")
    bodies = stored(sources.select(F.col("row").alias("k_row"), F.inline(F.pandas_udf(_bodies, BODY)("text", "wanted"))))
    told = runs.join(bodies, ["k_row", "k_start", "n"]).groupBy("row").agg(F.collect_list(F.struct("start", "n", "body")).alias("passages"))
    told = stored(told)
    touched = only_ids(keyed, told.select("row"), ["row"]).join(told, "row").withColumn("clean", F.pandas_udf(_clean, CLEAN)("text", "passages"))
    rest = only_ids(keyed, told.select("row"), ["row"], anti=True)
    names = {n: (f"_{n}" if n in docs.columns else n) for n in ("n_chunks", "n_removed", "lines_removed")}

    def shown(rows: DataFrame, text: str, n_removed: Column, lines_removed: Column) -> DataFrame:
        return rows.select(
            *[F.col(text).alias("text") if c == "text" else F.col(f"own.`{c}`").alias(c) for c in docs.columns], F.size("anchors").alias(names["n_chunks"]),
            n_removed.cast("int").alias(names["n_removed"]), lines_removed.cast("int").alias(names["lines_removed"]),
        )

    cleaned = shown(touched, "clean.text", F.col("clean.n_removed"), F.col("clean.lines_removed"))
    return cleaned.unionByName(shown(rest, "text", F.lit(0), F.lit(0)))
