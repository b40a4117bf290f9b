"""Gaps between calls and log-outs as streams: state per extension, timers by event time, and batch twins that say the same.

Rows may come late within the watermark and in any order: they wait in state until the watermark has passed them, and are then
read in order. What a stream told it tells no second time, after a restart from its checkpoint neither; a seen mark expires
once the watermark is ``remember`` past it. The state store must be RocksDB (see ``use_rocksdb``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.operators.calls import call_gaps, logout_sessions

GAPS = "extension long, call_id long, start timestamp, previous_start timestamp, gap_seconds double"
LOGOUTS = "extension long, day string, out_at timestamp, back_at timestamp"


def use_rocksdb(spark: SparkSession) -> None:
    """The provider that transformWithState needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _micros(t: dt.datetime) -> int:
    return int(t.astimezone(dt.UTC).timestamp()) * 1_000_000 + t.microsecond


def _moment(us: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(us // 1_000_000, dt.UTC).replace(microsecond=us % 1_000_000)


class Ordered(StatefulProcessor):
    """Holds rows until the watermark has passed them, and gives them in the order of time and id to ``next``."""

    waiting_value: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long, id long", self.waiting_value)

    def hold(self, at: int, id_: int, value: tuple) -> None:
        self.waiting.updateValue((at, id_), value)
        self.handle.registerTimer(at // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        for row in rows:
            self.take(row)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        until = (expiredTimerInfo.getExpiryTimeInMs() + 1) * 1000
        due = sorted((tuple(k), tuple(v)) for k, v in self.waiting.iterator() if k[0] < until)
        out = []
        for (at, id_), value in due:
            out += self.next(key[0], at, id_, value)
            self.waiting.removeKey((at, id_))
        self.forget(until)
        return iter(out)

    def forget(self, now: int) -> None:
        pass

    def close(self) -> None:
        pass


class GapProcessor(Ordered):
    waiting_value = "seconds double"

    def __init__(self, max_minutes: float, remember: dt.timedelta):
        self.most, self.remember = max_minutes * 60, int(remember.total_seconds() * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "start long, seconds double")
        self.seen = handle.getMapState("seen", "call_id long", "at long")

    def take(self, row: Row) -> None:
        if not self.seen.containsKey((row["call_id"],)):
            self.hold(_micros(row["start"]), row["call_id"], (float(row["seconds"] or 0),))

    def next(self, key: int, at: int, id_: int, value: tuple) -> list[Row]:
        if self.seen.containsKey((id_,)):
            return []
        self.seen.updateValue((id_,), (at,))
        last = self.last.get() if self.last.exists() else None
        self.last.update((at, value[0]))
        if last is None:
            return []
        gap = (at - last[0]) / 1e6 - last[1]
        if gap <= self.most:
            return []
        return [Row(extension=key, call_id=id_, start=_moment(at), previous_start=_moment(last[0]), gap_seconds=gap)]

    def forget(self, now: int) -> None:
        for k in [k for k, v in self.seen.iterator() if v[0] < now - self.remember]:
            self.seen.removeKey(tuple(k))


class LogoutProcessor(Ordered):
    waiting_value = "online boolean"

    def __init__(self, shift: tuple[str, str]):
        self.shift = shift

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "online boolean, day string")
        self.out = handle.getMapState("out", "at long", "day string")

    def take(self, row: Row) -> None:
        if row["online"] is not None:  # no answer is no change
            self.hold(_micros(row["at"]), row["poll_id"], (bool(row["online"]),))

    def next(self, key: int, at: int, id_: int, value: tuple) -> list[Row]:
        now = _moment(at)
        day, online = now.strftime("%Y-%m-%d"), value[0]
        last = tuple(self.last.get()) if self.last.exists() else (None, None)
        self.last.update((online, day))
        if online:
            out = sorted((k[0], v[0]) for k, v in self.out.iterator())
            for k, _ in out:
                self.out.removeKey((k,))
            return [Row(extension=key, day=d, out_at=_moment(k), back_at=now) for k, d in out]
        if last[0] and last[1] == day and self.shift[0] <= now.strftime("%H:%M") <= self.shift[1]:
            self.out.updateValue((at,), (day,))
            return [Row(extension=key, day=day, out_at=now, back_at=None)]
        return []


def gap_alerts(calls: DataFrame, max_minutes: float = 1.0, late: str = "10 minutes", remember: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """Stream of calls (extension, call_id, start, seconds) to gaps longer than max_minutes, each once."""
    keyed = calls.select("extension", "call_id", "start", F.col("seconds").cast("double").alias("seconds")).withWatermark("start", late).groupBy("extension")
    return keyed.transformWithState(GapProcessor(max_minutes, remember), GAPS, "Append", "EventTime")


def logout_alerts(polls: DataFrame, shift: tuple[str, str] = ("00:00", "23:59"), late: str = "10 minutes") -> DataFrame:
    """Stream of polls (extension, poll_id, at, online or null) to log-outs: told when they begin (back_at null) and again when they end."""
    keyed = polls.select("extension", "poll_id", "at", "online").withWatermark("at", late).groupBy("extension")
    return keyed.transformWithState(LogoutProcessor(shift), LOGOUTS, "Append", "EventTime")


def gap_alerts_batch(calls: DataFrame, max_minutes: float = 1.0) -> DataFrame:
    """The same gaps of a finished table; a call that is told twice counts once."""
    once = calls.dropDuplicates(["extension", "call_id"]).withColumn("seconds", F.coalesce("seconds", F.lit(0)))
    return call_gaps(once, max_minutes).select("extension", "call_id", "start", "previous_start", "gap_seconds")


def logout_alerts_batch(polls: DataFrame, shift: tuple[str, str] = ("00:00", "23:59")) -> DataFrame:
    """The same rows of a finished table: each log-out once without and, where it ended, once with its end."""
    found = logout_sessions(polls, shift=shift).select("extension", "day", "out_at", "back_at")
    return found.withColumn("back_at", F.lit(None).cast("timestamp")).unionByName(found.filter("back_at IS NOT NULL"))
