"""Ordered per-user columns that stay exact when a user is cut into slices.

Each column is a window over (user, slice). For sliced users the part that comes
from earlier (or later) slices is computed from one summary row per slice and
joined back on (user, slice), as the rows already lie. The summaries of a user are
an ordered history themselves: they are scanned in groups of ``GROUP`` slices, and
the groups' summaries after them, so that no window holds more than ``GROUP`` of
them for a user of up to a million slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices, and groups of slices, that one window goes through.
GROUP = 1024
LEVELS = 2


@dataclass(frozen=True)
class RunningSum:
    """Sum of ``value`` from the first row up to this one."""

    value: Column


@dataclass(frozen=True)
class Previous:
    """``value`` of the row before, NULL on the first row."""

    value: Column


@dataclass(frozen=True)
class LastKnown:
    """Last non-NULL ``value`` before this row, or up to it when ``inclusive``."""

    value: Column
    inclusive: bool = False


@dataclass(frozen=True)
class NextKnown:
    """First non-NULL ``value`` after this row."""

    value: Column


@dataclass(frozen=True)
class HighestBefore:
    """Highest ``value`` of the rows before this one, NULL on the first row."""

    value: Column


Step = RunningSum | Previous | LastKnown | NextKnown | HighestBefore


def scan(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: dict[str, Step],
    sliced: bool = False,
) -> DataFrame:
    """Add one ordered column per step. ``order`` must be total within a key."""
    parts = [*keys, "slice"] if sliced else list(keys)
    ahead = Window.partitionBy(*parts).orderBy(*order)
    behind = Window.partitionBy(*parts).orderBy(*[F.col(c).desc() for c in order])
    local = {name: _local(step, ahead, behind) for name, step in steps.items()}
    if not sliced:
        finished = {n: _unwrap(s, local[n]) for n, s in steps.items()}
        return rows.withColumns(finished)
    carries = _carries(rows, keys, order, steps)
    out = rows.withColumns({f"_local_{n}": c for n, c in local.items()})
    out = out.join(carries, parts, "left")
    done = {}
    for name, step in steps.items():
        here, carry = F.col(f"_local_{name}"), F.col(f"_carry_{name}")
        if isinstance(step, RunningSum):
            done[name] = here + F.coalesce(carry, F.lit(0))
        elif isinstance(step, HighestBefore):
            done[name] = F.greatest(here, carry)
        else:
            done[name] = _unwrap(step, F.coalesce(here, carry))
    extra = [f"_local_{n}" for n in steps] + [f"_carry_{n}" for n in steps]
    return out.withColumns(done).drop(*extra)


def _local(step: Step, ahead, behind) -> Column:
    first, here = Window.unboundedPreceding, Window.currentRow
    match step:
        case RunningSum(value):
            return F.sum(value).over(ahead.rowsBetween(first, here))
        case Previous(value):
            # wrapped, so that "no row before" and "NULL before" differ
            return F.lag(F.struct(value.alias("v"))).over(ahead)
        case LastKnown(value, inclusive):
            frame = ahead.rowsBetween(first, here if inclusive else -1)
            return F.last(value, ignorenulls=True).over(frame)
        case NextKnown(value):
            # frames that end at the partition's end cost n * n, so sort backwards
            return F.last(value, ignorenulls=True).over(behind.rowsBetween(first, -1))
        case HighestBefore(value):
            return F.max(value).over(ahead.rowsBetween(first, -1))
    raise TypeError(step)


def _unwrap(step: Step, column: Column) -> Column:
    return column["v"] if isinstance(step, Previous) else column


def _edge(step: Step, value: Column, place: Column) -> Column:
    """What a piece of history leaves for the pieces after (or before) it, as one value."""
    match step:
        case RunningSum():
            return F.sum(value)
        case Previous():
            return F.max_by(value, place)
        case LastKnown():
            return F.max_by(value, F.when(value.isNotNull(), place))
        case NextKnown():
            return F.min_by(value, F.when(value.isNotNull(), place))
        case HighestBefore():
            return F.max(value)
    raise TypeError(step)


def _carries(rows: DataFrame, keys: Sequence[str], order: Sequence[str], steps: dict[str, Step]) -> DataFrame:
    """Per (key, slice) what all other slices bring: ``_carry_`` columns."""
    place = F.struct(*order)
    edges = {
        # wrapped, so that "no row before" and "NULL before" differ
        n: _edge(s, F.struct(s.value.alias("v")) if isinstance(s, Previous) else s.value, place).alias(f"_edge_{n}")
        for n, s in steps.items()
    }
    summary = rows.where(F.col("slice") > 0).groupBy(*keys, "slice").agg(*edges.values())
    return _scan_pieces(summary, keys, "slice", steps, LEVELS)


def _scan_pieces(summary: DataFrame, keys: Sequence[str], piece: str, steps: dict[str, Step], levels: int) -> DataFrame:
    """Carries of one summary row per piece: within groups of pieces, and of the groups by the same means."""
    grouped = levels > 1
    rows = summary.withColumn("_group", F.floor(F.col(piece) / GROUP) if grouped else F.lit(0))
    parts = [*keys, "_group"]
    ahead = Window.partitionBy(*parts).orderBy(piece)
    behind = Window.partitionBy(*parts).orderBy(F.col(piece).desc())
    earlier = ahead.rowsBetween(Window.unboundedPreceding, -1)
    later = behind.rowsBetween(Window.unboundedPreceding, -1)
    carry = {}
    for name, step in steps.items():
        edge = F.col(f"_edge_{name}")
        match step:
            case RunningSum():
                carry[name] = F.sum(edge).over(earlier)
            case Previous():
                carry[name] = F.lag(edge).over(ahead)
            case LastKnown():
                carry[name] = F.last(edge, ignorenulls=True).over(earlier)
            case NextKnown():
                carry[name] = F.last(edge, ignorenulls=True).over(later)
            case HighestBefore():
                carry[name] = F.max(edge).over(earlier)
    here = rows.select(*keys, piece, "_group", *[c.alias(f"_carry_{n}") for n, c in carry.items()])
    if not grouped:
        return here.drop("_group")
    edges = [_edge(s, F.col(f"_edge_{n}"), F.col(piece)).alias(f"_edge_{n}") for n, s in steps.items()]
    above = _scan_pieces(rows.groupBy(*parts).agg(*edges).withColumnRenamed("_group", "_piece"), keys, "_piece", steps, levels - 1)
    above = above.select(*keys, F.col("_piece").alias("_group"), *[F.col(f"_carry_{n}").alias(f"_above_{n}") for n in steps])
    met = here.join(above, parts, "left")
    done = {}
    for name, step in steps.items():
        inner, outer = F.col(f"_carry_{name}"), F.col(f"_above_{name}")
        match step:
            case RunningSum():
                both = F.coalesce(inner, F.lit(0)) + F.coalesce(outer, F.lit(0))
            case HighestBefore():
                both = F.greatest(inner, outer)
            case _:
                both = F.coalesce(inner, outer)
        done[name] = both.alias(f"_carry_{name}")
    return met.select(*keys, piece, *done.values())
