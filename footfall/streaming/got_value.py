"""Got-value moments as they happen: one small state per user.

State: start of the current offline run, its number of events, and whether the
user already got the value. On input that arrives in order the moments equal
those of the batch detector. With places, the state also holds the last known place,
and a moment waits for the user's next known place, or for an event-time timer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from footfall import names as N
from footfall.functions.scalars import known_city
from footfall.operators.detectors import GotValueRule, resolve_region

OUTPUT = "userid string, created_at timestamp, session int, activation_time int"
STATE = "run_start int, run_events int, done boolean"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class GotValueProcessor(StatefulProcessor):
    """Follows each user's offline run."""

    def __init__(self, interval: int, min_events: int) -> None:
        self.interval = interval
        self.min_events = min_events

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        start, count, done = self.run.get() if self.run.exists() else (None, 0, False)
        if done:
            return
        # a micro batch brings a user's rows in any order
        for row in sorted(rows, key=lambda r: (r.created_at, r.activation_time, r.event_id)):
            if not row.offline:
                start, count = None, 0
                continue
            count += 1
            if start is None:
                start = row.activation_time
                continue
            lasted = row.activation_time - start >= self.interval
            if lasted and (count >= self.min_events or row.event == "MapIteraction"):
                done = True
                yield Row(
                    userid=key[0], created_at=row.created_at, session=row.session,
                    activation_time=row.activation_time,
                )
                break
        self.run.update((start, count, done))

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """The processor's state lives in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def got_value_stream(
    events: DataFrame,
    excluded: Sequence[str] = N.DETECTOR_EXCLUDED,
    interval: int = N.OFFLINE_SECONDS,
    min_events: int = N.OFFLINE_MIN_EVENTS,
) -> DataFrame:
    """First got-value moment of each user of a stream of log rows."""
    rows = events.where(~F.col("event").isin(*excluded)).select(
        "userid", "created_at", "session", "activation_time", "event", "event_id",
        F.col("network").eqNullSafe(F.lit(False)).alias("offline"),
    )
    return rows.groupBy("userid").transformWithState(
        statefulProcessor=GotValueProcessor(interval, min_events),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None",
    )


LOCATED = "userid string, created_at timestamp, session int, activation_time int, place string"
LOCATED_STATE = (
    "phase int, run_start int, run_events int, place string, place_at int, "
    "hit_created timestamp, hit_session int, hit_at int"
)
FOLLOWING, WAITING, DONE = 0, 1, 2


class LocatedGotValueProcessor(StatefulProcessor):
    """Follows each user's offline run and places; gives a moment out once its place is known."""

    def __init__(self, interval: int, min_events: int, wait_seconds: int) -> None:
        self.interval = interval
        self.min_events = min_events
        self.wait_seconds = wait_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", LOCATED_STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = list(self.state.get()) if self.state.exists() else [FOLLOWING, None, 0, None, None, None, None, None]
        if state[0] == DONE:
            return
        # a micro batch brings a user's rows in any order
        for row in sorted(rows, key=lambda r: (r.created_at, r.activation_time, r.event_id)):
            if state[0] == WAITING:
                if row.place is not None:
                    for timer in self.handle.listTimers():
                        self.handle.deleteTimer(timer)
                    yield self._moment(key, state, _closer(state[3], state[4], state[7], row.place, row.activation_time))
                    state[0] = DONE
            else:
                if row.counts and self._hit(state, row):
                    state[5:] = [row.created_at, row.session, row.activation_time]
                    if row.place is not None:
                        yield self._moment(key, state, row.place)
                        state[0] = DONE
                    else:
                        state[0] = WAITING
                        end = int(row.created_at.timestamp() * 1000) + self.wait_seconds * 1000
                        self.handle.registerTimer(end)
                if row.place is not None and state[0] == FOLLOWING:
                    state[3:5] = [row.place, row.activation_time]
            if state[0] == DONE:
                break
        self.state.update(tuple(state))

    def _hit(self, state: list, row: Row) -> bool:
        if not row.offline:
            state[1:3] = [None, 0]
            return False
        state[2] += 1
        if state[1] is None:
            state[1] = row.activation_time
            return False
        lasted = row.activation_time - state[1] >= self.interval
        return lasted and (state[2] >= self.min_events or row.event == "MapIteraction")

    def _moment(self, key: Any, state: list, place: str | None) -> Row:
        return Row(userid=key[0], created_at=state[5], session=state[6], activation_time=state[7], place=place)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        """No known place came in time: the one before, if any."""
        state = list(self.state.get())
        if state[0] == WAITING:
            yield self._moment(key, state, state[3])
            state[0] = DONE
            self.state.update(tuple(state))

    def close(self) -> None:
        pass


def _closer(before: str | None, before_at: int | None, at: int, after: str, after_at: int) -> str:
    """On equal distance the later place."""
    return before if before is not None and abs(at - before_at) < abs(after_at - at) else after


def located_got_value_stream(
    events: DataFrame,
    gazetteer: DataFrame,
    wait: int = 30 * 86_400,
    late: str = "2 days",
    rule: GotValueRule = GotValueRule(),
) -> DataFrame:
    """First got-value moment of each user of a stream of log rows, with the region of the closest known place.

    A moment is given out with the user's next known place, or ``wait`` seconds of event
    time after it. On input that arrives in order the rows equal ``detectors.got_value``
    where no next place takes longer than that.
    """
    rows = events.withWatermark("created_at", late).select(
        "userid", "created_at", "session", "activation_time", "event", "event_id",
        F.col("network").eqNullSafe(F.lit(False)).alias("offline"), (~F.col("event").isin(*rule.excluded)).alias("counts"),
        F.when(known_city(F.col("city")), F.col("city")).alias("place"),
    )
    moments = rows.groupBy("userid").transformWithState(
        statefulProcessor=LocatedGotValueProcessor(rule.interval, rule.min_events, wait),
        outputStructType=LOCATED,
        outputMode="Append",
        timeMode="EventTime",
    )
    return resolve_region(moments, gazetteer, "place", "city").select("userid", "created_at", "session", "activation_time", "city")
