"""Aggregate expressions and the order of report rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_known(value: Column, *order: str) -> Column:
    """First non-NULL value in the given order."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))


def rising(column: str) -> Column:
    """Ascending with NULLs last."""
    return F.col(column).asc_nulls_last()


def falling(column: str) -> Column:
    """Descending with NULLs first."""
    return F.col(column).desc_nulls_first()
