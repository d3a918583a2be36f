"""How filters interact: every order of them, by recursion over prefixes of orders.

Documents are first counted by mask, one bit per filter that they fail. A recursive
query then starts from the masks that occur, extends each prefix of an order by every
letter not yet used and carries the bits applied so far; each level of it says, for each
mask, whether that step keeps it, removes it or meets it too late. Counts join by mask,
so the recursion has at most 2^5 * 326 rows, whatever the number of documents or parts.

Null text counts as empty, null language as the part ``''``. A text fails ``E`` when a
smaller id has the same bytes anywhere in the table; rows that share an id are no copies
of each other, a row without id comes after all ids, and rows without any id among equal
texts are no copies. A label counts if any label row of the id has it; ids without label
rows are neither good nor toxic. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

LETTERS = "ABCDE"
#: Bounds of the filters (fixed values of the contract).
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 100, 80, 10
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failed_bits(text: Column) -> Column:
    """Bits of A to D that ``text`` (not null) fails; E needs the other rows."""
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    n, distinct = F.size(words).cast("bigint"), F.size(F.array_distinct(words)).cast("bigint")
    points = F.length(text).cast("bigint")
    capitals = points - F.length(F.translate(text, CAPITALS, ""))
    fails = [
        n < MIN_WORDS,
        distinct * 100 < n * MIN_DISTINCT_PERCENT,
        capitals * 100 > points * MAX_CAPITALS_PERCENT,
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)), F.lit(0))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``good`` and ``toxic`` (0 or 1) of each row; rows without id meet no label and are not shuffled for it."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    nameless = rows.where("doc_id is null").withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    return known.unionByName(nameless).na.fill(0, ["good", "toxic"])


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters they fail.

    Only digests and bits are shuffled. Copies are combined before each shuffle, so that
    a text that fills a third of the table is a few rows by the time it meets itself.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.sha2(text.cast("binary"), 256).alias("digest"), failed_bits(text).alias("bits"),
    )
    same = ["digest", "part", "bits", "good", "toxic"]
    per_id = _labelled(rows, labels).groupBy(*same, "doc_id").agg(F.count("*").alias("n"))
    firsts = per_id.groupBy(*same).agg(
        F.sum("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "n")).alias("first")
    )
    smallest = firsts.groupBy("digest").agg(F.min("first").alias("least"))
    met = firsts.join(smallest, "digest")
    original = (
        F.when(F.col("least.nameless"), F.col("n"))
        .when(F.col("first.doc_id") == F.col("least.doc_id"), F.col("first.n"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    copy_bit = 1 << LETTERS.index("E")
    two = F.array(
        F.struct(F.col("bits").alias("mask"), original.alias("n")),
        F.struct((F.col("bits").bitwiseOR(F.lit(copy_bit))).alias("mask"), (F.col("n") - original).alias("n")),
    )
    cells = met.select("part", "good", "toxic", F.explode(two).alias("c")).where("c.n > 0")
    return cells.groupBy("part", "c.mask").agg(
        F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic")
    )


def prefixes(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(mask, prefix, bit, step, kept, removed, redundant), by recursion over ``masks`` (mask int)."""
    return masks.sparkSession.sql(
        f"""
        WITH RECURSIVE extended (mask, prefix, before, bit, step) AS (
            SELECT mask, '', 0, 0, 0 FROM {{masks}}
            UNION ALL
            SELECT mask, concat(prefix, substring('{letters}', 1 + k, 1)), before | bit, 1 << k, step + 1
            FROM (SELECT *, explode(sequence(0, {len(letters) - 1})) AS k FROM extended WHERE step < {len(letters)})
            WHERE (before | bit) & (1 << k) = 0
        )
        SELECT mask, prefix, bit, step,
               mask & (before | bit) = 0 AS kept,
               mask & before = 0 AND mask & bit <> 0 AS removed,
               mask & before <> 0 AND mask & bit <> 0 AS redundant
        FROM extended WHERE step > 0
        """,
        masks=masks,
    )


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of all ``letters`` and step, zeros included. ``cells``: see ``mask_cells``."""
    spark = cells.sparkSession
    cells = stored(cells)
    steps = stored(prefixes(cells.select("mask").distinct(), letters))
    # at most 2^5 masks * 325 prefixes
    met = cells.join(F.broadcast(steps), "mask")

    def count(flag: Column, what: str = "n") -> Column:
        return F.sum(F.when(flag, F.col(what)).otherwise(0))

    own = F.col("mask") == F.col("bit")
    metrics = met.groupBy("part", "prefix", "bit", "step").agg(
        count(F.col("kept")).alias("kept"), count(F.col("removed")).alias("removed"), count(F.col("redundant")).alias("redundant"),
        count(own).alias("unique_fails"), count(F.col("removed"), "good").alias("good_lost"), count(F.col("removed"), "toxic").alias("toxic_lost"),
    )
    metrics = stored(metrics)
    # the prefix of s letters opens (letters - s)! orders
    orders_of = F.factorial(F.lit(len(letters)) - F.col("step"))
    shapley = metrics.groupBy("part", "bit").agg(F.sum(F.col("removed") * orders_of).alias("shapley"))
    orders = steps.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    at = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("n_letters"))
    at = at.select("filter_order", F.expr("substring(filter_order, 1, n_letters)").alias("prefix"))
    whole = metrics.join(shapley, ["part", "bit"]).join(F.broadcast(at), "prefix")  # 120 orders of 5 steps
    return whole.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(mask_cells(docs, labels))
