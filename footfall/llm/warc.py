"""WARC archives: writing pages, and reading them back by boundary-chain verification.

Archives are plain ``WARC/1.1`` files, written as text whose line separator is the
blank lines behind a record. To read, files are split at every occurrence of the
version line, wherever the splits of the file fall. Each occurrence is a candidate
record: a task parses its header and emits the offset of the candidate and that of its
successor. Offsets within a split are counted from its first line; sums over the
splits before it make them offsets in the file. Pointer jumping from offset 0 marks
the candidates on the chain; all others are payload and go back into the record that
holds them.

Null html counts as empty. Pages of at least ``LEAST`` bytes with equal payloads are
one group: the page with the largest id is written as response, the others as
revisits that name it. Rows that share the largest id are all responses. Null ids
and null addresses leave out their header; a page without id is a revisit only if
another page of its group has an id. Line breaks in addresses are escaped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_folder, stored
from .common import BROADCAST_IDS, small_batches

LEAST = 1000
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Records of one file, so that a file's chain needs few rounds.
FILE_RECORDS = 4096
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(pages: DataFrame) -> DataFrame:
    """Pages with payload, digests, record type and the response a revisit refers to."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("payload")
    )
    body = F.col("payload").cast("binary")
    rows = rows.withColumns({"n": F.octet_length("payload").cast("bigint"), "sha1": F.sha1(body), "same": F.sha2(body, 256)})
    groups = stored(
        rows.where(F.col("n") >= LEAST).groupBy("same").agg(F.max("page_id").alias("keep"), F.count("*").alias("copies"))
        .where("copies > 1 and keep is not null").select("same", "keep")
    )
    few = groups.count() <= BROADCAST_IDS // 5
    rows = rows.join(F.broadcast(groups) if few else groups, "same", "left")
    return rows.withColumn("refers_to", F.when(~F.col("keep").eqNullSafe(F.col("page_id")), F.col("keep")))


def write_warc(pages: DataFrame, path: str) -> None:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    opt = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    length = F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")
    head = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), opt("WARC-Record-ID", urn("page_id")),
        opt("WARC-Target-URI", url), line("WARC-Date", F.lit(DATE)), opt("WARC-Refers-To", urn("refers_to")),
        opt("WARC-Profile", F.when(revisit, F.lit(PROFILE))), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("X-Payload-Length", F.col("n").cast("string")), line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", length), F.lit("\r\n"),
    )
    value = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    out = records(pages).select(value.alias("value")).write
    out.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).text(path)


_HEADER = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)\r\n")


def _parsed(fragment: bytes) -> tuple[dict, int, int] | None:
    """(fields, payload start, payload length) of a candidate behind its version line."""
    end = fragment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields, at = {}, 0
    while at < end + 2:
        m = _HEADER.match(fragment, at)
        if not m:
            return None
        fields[m[1].decode().lower()] = m[2].decode("utf-8", "replace")
        at = m.end()
    size = fields.get("content-length", "")
    return (fields, end + 4, int(size)) if size.isdigit() and "warc-type" in fields else None


#: One candidate: where it is, where its record ends, and what its record says.
CANDIDATE = [
    ("path", pa.string()), ("split", pa.int64()), ("rel", pa.int64()), ("size", pa.int64()), ("span", pa.int64()), ("whole", pa.bool_()),
    ("type", pa.string()), ("record_id", pa.string()), ("refers", pa.string()), ("digest", pa.string()), ("length", pa.int64()),
    ("sha1", pa.string()), ("body", pa.binary()),
]
CANDIDATE_FIELDS = (
    "path string, split bigint, rel bigint, size bigint, span bigint, whole boolean, type string, record_id string, refers string, "
    "digest string, length bigint, sha1 string, body binary"
)


def _described(fragment: bytes) -> list:
    """Columns from ``span`` on; ``body`` only where a fragment isn't one whole record."""
    parsed = _parsed(fragment)
    if parsed is None:
        return [None, False, None, None, None, None, None, None, fragment]
    fields, start, size = parsed
    span = len(MAGIC) + start + size + len(END)
    whole = start + size + len(END) == len(fragment) and fragment.endswith(END.encode())
    length = fields.get("x-payload-length", "")
    about = [fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-payload-digest")]
    digest = hashlib.sha1(fragment[start : start + size]).hexdigest() if whole else None
    return [span, whole, *about, int(length) if length.isdigit() else size, digest, None if whole else fragment]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of a split come one after the other, so their offsets add up."""
    schema = pa.schema(CANDIDATE)
    now, rel = None, 0
    for batch in batches:
        columns: list[list] = [[] for _ in schema]
        for fragment, path, split in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (path, split) != now:
                now, rel = (path, split), 0
            size = len(fragment) + len(MAGIC)
            for c, v in zip(columns, [path, split, rel, size, *_described(fragment)]):
                c.append(v)
            rel += size
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    small_batches(spark)
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(F.col("value").cast("binary"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fragment with its place, counted as for the candidates."""
    now, rel = None, 0
    for batch in batches:
        rels = []
        for fragment, path, split in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (path, split) != now:
                now, rel = (path, split), 0
            rels.append(rel)
            rel += len(fragment) + len(MAGIC)
        yield pa.record_batch(
            [batch.column(1), batch.column(2).cast(pa.int64()), pa.array(rels, pa.int64()), batch.column(0)], names=["path", "split", "rel", "body"]
        )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All candidates with ``at``, the offset of their version line in the file."""
    found = stored(_fragments(spark, path).mapInArrow(_candidates, CANDIDATE_FIELDS))
    sizes = found.groupBy("path", "split").agg(F.sum("size").alias("all"))
    starts = sizes.withColumn("first", F.sum("all").over(Window.partitionBy("path").orderBy("split")) - F.col("all"))
    at = F.col("first") + F.col("rel") - len(MAGIC)
    # a file's first line ends before its first version line and is no candidate
    return found.join(starts.select("path", "split", "first"), ["path", "split"]).withColumn("at", at).where("at >= 0").drop("first")


def on_chain(found: DataFrame) -> DataFrame:
    """(path, at) of the candidates that the chain from offset 0 reaches.

    Marked candidates mark what they point to, and every pointer then skips to its
    target's pointer, so a file of n records takes about log2(n) rounds.
    """
    links = stored(found.where("span is not null").select("path", "at", (F.col("at") + F.col("span")).alias("to")))
    marked = links.where("at = 0").select("path", "at")
    reached = marked.count()
    while reached:
        step = marked.join(links, ["path", "at"]).select("path", F.col("to").alias("at"))
        known = links.select("path", "at")
        marked = stored(marked.union(step.join(known, ["path", "at"], "left_semi")).distinct())
        now = marked.count()
        if now == reached:
            break
        reached = now
        target = links.select("path", F.col("at").alias("to"), F.col("to").alias("next"))
        links = stored(links.join(target, ["path", "to"], "left").select("path", "at", F.coalesce("next", "to").alias("to")))
    return marked


def _mended(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """Records whose payload holds version lines, put together from their fragments.

    Fragments that look like whole records but are payload are read once more.
    """
    broken = found.where(~(F.col("whole") & F.col("real"))).select("path", "split", "rel", "at", "real", "body")
    need = stored(broken.where("body is null").select("path", "split", "rel"))
    if not need.isEmpty():
        again = _fragments(spark, path).mapInArrow(_bodies, "path string, split bigint, rel bigint, body binary")
        again = again.join(need, ["path", "split", "rel"], "left_semi").withColumnRenamed("body", "again")
        broken = broken.join(again, ["path", "split", "rel"], "left").withColumn("body", F.coalesce("body", "again"))
    order = Window.partitionBy("path").orderBy("at")
    owner = F.last(F.when(F.col("real"), F.col("at")), ignorenulls=True).over(order)
    parts = broken.withColumn("owner", owner).groupBy("path", "owner").agg(F.array_sort(F.collect_list(F.struct("at", "body"))).alias("parts"))

    @F.udf("type string, record_id string, refers string, digest string, length bigint, sha1 string")
    def joined(parts: list) -> tuple | None:
        described = _described(MAGIC.encode().join(bytes(p["body"]) for p in parts))
        return tuple(described[2:8]) if described[1] else None

    return parts.select(joined("parts").alias("r")).where("r is not null").select("r.*")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records.

    A response's digest is that of the payload as read; one that differs from its
    header fails the query. A revisit has what its header says of the full payload.
    """
    found = candidates(spark, path)
    real = on_chain(found).withColumn("real", F.lit(True))
    found = stored(found.join(real, ["path", "at"], "left").withColumn("real", F.coalesce("real", F.lit(False))))
    names = ["type", "record_id", "refers", "digest", "length", "sha1"]
    rows = found.where("real and whole").select(*names).union(_mended(spark, path, found).select(*names))
    stated = F.regexp_replace("digest", "^sha1:", "")
    right = (F.col("type") == "revisit") | (stated == F.col("sha1"))
    digest = F.when(right, stated).otherwise(F.raise_error(F.lit("payload differs from its digest")))
    return rows.select(
        F.when(F.col("record_id").isNotNull(), F.expr("try_cast(regexp_extract(record_id, '^<urn:page:(-?[0-9]+)>$', 1) AS bigint)")).alias("page_id"),
        F.col("length").alias("payload_bytes"), digest.alias("payload_digest"), F.col("type").alias("record_type"),
        F.when(F.col("refers").isNotNull(), F.expr("try_cast(regexp_extract(refers, '^<urn:page:(-?[0-9]+)>$', 1) AS bigint)")).alias("refers_to"),
    )


def archived(pages: DataFrame) -> DataFrame:
    """Pages written to fresh archives and read back."""
    spark = pages.sparkSession
    path = fresh_folder(spark)
    write_warc(pages, path)
    return read_warc(spark, path)
