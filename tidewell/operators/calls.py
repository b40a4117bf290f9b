"""Call and presence analytics: gaps, summaries, log-outs, alerts, eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.text import in_shift, minutes_text


def call_gaps(calls: DataFrame, max_minutes: float, by: str = "extension", start: str = "start", seconds: str = "seconds", ident: str = "call_id") -> DataFrame:
    """Pauses longer than max_minutes between the end of a call and the start of the next, per extension.

    A call of no seconds ends at its start. One shuffle by the extension; calls that start together keep
    the order of their ids.
    """
    w = Window.partitionBy(by).orderBy(start, ident)
    prev = F.lag(start).over(w).cast("timestamp")
    gap = (F.unix_micros(F.col(start).cast("timestamp")) - F.unix_micros(prev)) / 1e6 - F.lag(seconds).over(w)
    return calls.select("*", F.lag(start).over(w).alias("previous_start"), gap.alias("gap_seconds")).filter(F.col("gap_seconds") > max_minutes * 60)


def shift_gaps(calls: DataFrame, max_minutes: float, shift: tuple[str, str], **names) -> DataFrame:
    """Gaps that begin in the shift, filed under the day on which they began."""
    found = call_gaps(calls, max_minutes, **names)
    return found.filter(in_shift(F.col("previous_start"), *shift)).withColumn("day", F.date_format("previous_start", "yyyy-MM-dd"))


def unseen(alerts: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Alerts whose key was not told before, each key once."""
    return alerts.join(seen.select(key), key, "left_anti").dropDuplicates([key])


def daily_summary(alerts: DataFrame, logouts: DataFrame) -> DataFrame:
    """Per day and operator: alerts by kind, longest and total gap, log-outs and time away, as text too.

    alerts: day, who, kind, minutes. logouts: day, who, minutes (null while still out).
    """
    count = lambda kind: F.count_if(F.col("kind") == kind)
    gap = F.when(F.col("kind") == "gap", F.col("minutes"))
    told = alerts.groupBy("day", "who").agg(count("offline").alias("offline"), count("idle").alias("idle"), count("gap").alias("gaps"), F.max(gap).alias("longest"), F.sum(gap).alias("lost"))
    away = logouts.groupBy("day", "who").agg(F.count("*").alias("logouts"), F.sum("minutes").alias("away"), F.bool_or(F.col("minutes").isNull()).alias("open"))
    both = told.join(away, ["day", "who"], "full").fillna(0, ["offline", "idle", "gaps", "longest", "lost", "logouts", "away"]).fillna(False, ["open"])
    still = F.when(F.col("open"), F.when(minutes_text(F.col("away")) == "", "still out").otherwise(F.concat(minutes_text(F.col("away")), F.lit(" + still out")))).otherwise(minutes_text(F.col("away")))
    return both.withColumns({"longest_text": minutes_text(F.col("longest")), "lost_text": minutes_text(F.col("lost")), "away_text": F.when(F.col("logouts") > 0, still).otherwise("")})


def logout_sessions(polls: DataFrame, by: str = "extension", at: str = "at", online: str = "online", shift: tuple[str, str] = ("00:00", "23:59")) -> DataFrame:
    """Log-outs in the shift with the time of the return: extension, day, out_at, back_at.

    Polls without an answer are passed over. The first poll of a day is only remembered. A log-out is a
    change from online to offline within a day; it ends at the next online poll, of any day.
    """
    known = polls.filter(F.col(online).isNotNull())
    w = Window.partitionBy(by).orderBy(at)
    day = F.date_format(at, "yyyy-MM-dd")
    left = (F.lag(online).over(w)) & ~F.col(online) & (F.lag(day).over(w) == day) & in_shift(F.col(at), *shift)
    back = F.min(F.when(F.col(online), F.col(at))).over(w.rowsBetween(1, Window.unboundedFollowing))
    return known.select(by, day.alias("day"), F.col(at).alias("out_at"), back.alias("back_at"), F.coalesce(left, F.lit(False)).alias("__left")).filter("__left").drop("__left")


def eligible(status: Column, today: Column, tried: Column, per_day: int, contacts: int) -> Column:
    """Whether a row may be called: not done or exhausted, under both caps. tried is an array of numbers."""
    return ~status.isin("done", "exhausted") & (F.coalesce(today, F.lit(0)) < per_day) & (F.size(F.array_distinct(F.filter(tried, lambda t: t != ""))) < contacts)


def transcripts(turns: DataFrame, by: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", least: int = 40) -> DataFrame:
    """One transcript per conversation, and whether it was answered: over so many characters."""
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(turn, F.concat_ws(": ", role, text).alias("line")))), lambda x: x["line"]), "\n")
    return turns.groupBy(by).agg(said.alias("transcript")).withColumn("answered", F.char_length(F.btrim("transcript")) > least)


def after_calls(events: DataFrame, by: str, order: str, outcome: str, answered: str) -> DataFrame:
    """The state of a campaign row after all its calls: attempts, last outcome, status."""
    last = F.max_by(F.struct(outcome, answered), F.struct(*[c for c in (order,)]))
    out = events.groupBy(by).agg(F.count("*").alias("attempts_total"), last.alias("l"))
    done = F.col(f"l.{answered}") & ~F.col(f"l.{outcome}").isin("none", "needs_review", "needs_arrival_date")
    return out.select(by, "attempts_total", F.col(f"l.{outcome}").alias("last_outcome"), F.when(done, "done").when(~F.col(f"l.{answered}"), "pending").otherwise("calling").alias("status"))
