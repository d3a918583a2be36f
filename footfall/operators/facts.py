"""Per-user facts: first join, first known city, and the bundle cohorts need."""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.aggregates import first_known
from footfall.functions.scalars import json_text, known_city
from footfall.operators import detectors
from footfall.plans.skew import HotKeys, add_slice
from footfall.plans.time_range import between


def first_time_users(logs: DataFrame) -> DataFrame:
    """First ``AppStartup`` of session 1 per user."""
    return (
        logs.where((F.col("event") == "AppStartup") & (F.col("session") == 1))
        .groupBy("userid")
        .agg(F.min("created_at").alias("first_join"))
    )


def first_time_users_by_session(logs: DataFrame, ignore_idle: bool = True) -> DataFrame:
    """Users whose lowest session is at most 1; the map-end event may not count."""
    rows = logs.where(F.col("event") != "MapModeEnd") if ignore_idle else logs
    return (
        rows.groupBy("userid")
        .agg(F.min("session").alias("low"))
        .where(F.col("low") <= 1)
        .select("userid")
    )


def first_cities(logs: DataFrame, raw: bool = False) -> DataFrame:
    """First known city per user; ties are ordered by activation time, then event id.

    ``raw`` takes the city the app reported instead of the widened column.
    """
    city = json_text(F.col("properties"), N.KEY_CITY) if raw else F.col("city")
    return (
        logs.withColumn("_city", city)
        .where(known_city(F.col("_city")))
        .groupBy("userid")
        .agg(first_known(F.col("_city"), "created_at", "activation_time", "event_id").alias("first_city"))
    )


def first_seen_places(logs: DataFrame) -> DataFrame:
    """Each known (user, city) with the user's earliest time in any known city."""
    pairs = logs.where(known_city(F.col("city"))).groupBy("userid", "city").agg(
        F.min("created_at").alias("at")
    )
    seen = pairs.groupBy("userid").agg(F.min("at").alias("first_seen"))
    return pairs.join(seen, "userid").select("userid", "city", "first_seen")


def never_located_users(logs: DataFrame, null_is_unknown: bool = False) -> DataFrame:
    """Users without any known location.

    A NULL city counts as known unless ``null_is_unknown``.
    """
    unknown = F.coalesce(F.col("city").isin(*N.UNKNOWN_PLACES), F.lit(null_is_unknown))
    return (
        logs.groupBy("userid")
        .agg(F.sum(F.when(unknown, 0).otherwise(1)).alias("known"))
        .where(F.col("known") == 0)
        .select("userid")
    )


@dataclass(frozen=True)
class Detection:
    """How got-value moments and experimental sessions are looked for.

    Without ``anchor`` over whole histories; with it in batches of ``days`` days from
    the anchor on, up to ``end``, which no history crosses. ``strict_order`` and
    ``compat``: see ``detectors.experimental_sessions`` and ``detectors.choose_place``.
    """

    anchor: date | str | None = None
    end: date | str | None = None
    days: int = N.DETECTOR_BATCH_DAYS
    rule: detectors.GotValueRule = detectors.GotValueRule()
    compat: bool = False
    strict_order: bool = False


class Facts:
    """Event log with everything cohorts are built from.

    Derived tables are built when first asked for. ``keep`` decides how they are
    kept between uses: as plans (default) or written out, see ``session.stored``.
    The detections are taken as given, or run over the log when a gazetteer is, in
    the way ``detection`` says.
    """

    def __init__(
        self,
        logs: DataFrame,
        hot: HotKeys | None = None,
        gazetteer: DataFrame | None = None,
        keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        detection: Detection = Detection(),
    ) -> None:
        self.detection = detection
        self.logs = logs if "slice" in logs.columns else add_slice(logs, hot)
        self.hot = hot
        self._gazetteer = gazetteer
        self._keep = keep

    @property
    def sliced(self) -> bool:
        return self.hot is not None

    def between(self, start, end=None) -> DataFrame:
        """Log rows of ``[start, end)``, or from ``start`` on; prunes a log stored by day."""
        return between(self.logs, start, end)

    @cached_property
    def first_users(self) -> DataFrame:
        return self._keep(first_time_users(self.logs))

    @cached_property
    def first_cities(self) -> DataFrame:
        return self._keep(first_cities(self.logs))

    @cached_property
    def _detected(self) -> tuple[DataFrame, DataFrame]:
        if self._gazetteer is None:
            raise ValueError("detections need a gazetteer, or give the finished tables")
        how = self.detection
        return detectors.detect(
            self.logs, self._gazetteer, how.anchor, how.end, how.days, how.rule, how.compat, how.strict_order,
            sliced=self.sliced, keep=self._keep,
        )

    @cached_property
    def got_value(self) -> DataFrame:
        return self._keep(self._detected[0])

    @cached_property
    def experimental(self) -> DataFrame:
        return self._keep(self._detected[1])

    def detected(self, how: Detection) -> Facts:
        """The same facts with detections made in another way."""
        out = copy(self)
        out.detection = how
        for name in ("_detected", "got_value", "experimental"):
            out.__dict__.pop(name, None)
        return out

    def with_detections(self, got_value: DataFrame, experimental: DataFrame) -> Facts:
        """The same facts with detections made elsewhere."""
        out = copy(self)
        out.__dict__.update(got_value=got_value, experimental=experimental)
        return out
