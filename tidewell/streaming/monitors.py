"""Stateful monitors over polled streams, and their batch twins.

The folds are plain functions of (state, poll), so that stream and batch say the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ALERTS = "extension long, at timestamp, reason string"
STATE = "last_online boolean, online_at double, alert_at double"


def presence_step(state: tuple, at: float, online: bool | None, in_shift: bool, idle: float, quiet: float) -> tuple[tuple, str | None]:
    """One poll of an extension: the next state, and the reason of an alert if one is due.

    Offline in the shift alerts; online alerts if the last online poll lies idle seconds back. An alert
    within quiet seconds of the last one is not told. A poll without an answer alerts of nothing, but the next
    online one then doesn't follow an online poll, so it can't be idle.
    """
    last, online_at, alert_at = state
    if online is None:
        return (None, online_at, alert_at), None
    reason = None
    if in_shift and not online:
        reason = "offline during shift"
    elif in_shift and online and last and online_at is not None and at - online_at >= idle:
        reason = "no activity change"
    if reason and alert_at is not None and at - alert_at < quiet:
        reason = None
    return (online, at if online else online_at, at if reason else alert_at), reason


def _fold(key: tuple, rows: pd.DataFrame, state: tuple, shift: tuple[str, str], idle: float, quiet: float) -> tuple[tuple, pd.DataFrame]:
    out = []
    for at, online in rows.sort_values("at")[["at", "online"]].itertuples(index=False):
        inside = shift[0] <= at.strftime("%H:%M") <= shift[1]
        state, reason = presence_step(state, at.timestamp(), None if pd.isna(online) else bool(online), inside, idle, quiet)
        if reason:
            out.append((key[0], at, reason))
    return state, pd.DataFrame(out, columns=["extension", "at", "reason"])


def presence_alerts(polls: DataFrame, shift: tuple[str, str] = ("09:00", "18:00"), idle: float = 900, quiet: float = 3600) -> DataFrame:
    """Alerts of a stream of polls (extension long, at timestamp, online boolean); state is kept per extension."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (None, None, None)
        now, out = _fold(key, pd.concat(list(batches)), tuple(now), shift, idle, quiet)
        state.update(now)
        yield out

    return polls.groupBy("extension").applyInPandasWithState(step, ALERTS, STATE, "append", GroupStateTimeout.NoTimeout)


def presence_alerts_batch(polls: DataFrame, shift: tuple[str, str] = ("09:00", "18:00"), idle: float = 900, quiet: float = 3600) -> DataFrame:
    """The same over a finished table: Spark deals out and sorts the polls; a task folds them in batches and holds one state."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who, state = None, (None, None, None)
        for rows in batches:
            out = []
            for extension, at, online in rows.itertuples(index=False):
                if extension != who:
                    who, state = extension, (None, None, None)
                inside = shift[0] <= at.strftime("%H:%M") <= shift[1]
                state, reason = presence_step(state, at.timestamp(), None if pd.isna(online) else bool(online), inside, idle, quiet)
                if reason:
                    out.append((extension, at, reason))
            yield pd.DataFrame(out, columns=["extension", "at", "reason"])

    return polls.select("extension", "at", "online").repartition("extension").sortWithinPartitions("extension", "at").mapInPandas(whole, ALERTS)


def gap_alert_stream(gaps: DataFrame, at: str = "start", key: str = "call_id", late: str = "1 day") -> DataFrame:
    """Each gap once, however often a poll tells it, within the watermark."""
    return gaps.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, at: str, kind: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Events by kind and tumbling window; late ones are filed by their own time up to the watermark."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), kind).count()
