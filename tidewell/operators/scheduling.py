"""Queues, budgets, caps and retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .allocation import allocate_once


def startable(queue: DataFrame, budget: float, lane: str = "lane", priority: str = "priority", added: str = "added", cost: str = "cost", ident: str = "item_id") -> DataFrame:
    """What each lane may start: priority first, then by arrival, while the lane's running cost stays in the budget. Costs aren't negative.

    Sums by lane, priority and arrival tell first where a lane's budget ends; only what arrives before is put in order row by row.
    """
    exact = F.col(cost).cast("decimal(18,2)")
    sums = queue.groupBy(lane, priority, added).agg(F.sum(exact).alias("__s"))
    ahead = F.sum("__s").over(Window.partitionBy(lane).orderBy(F.col(priority).desc(), added).rowsBetween(Window.unboundedPreceding, -1))
    within = sums.withColumn("__ahead", ahead).filter(F.coalesce("__ahead", F.lit(0)) <= budget).select(F.col(lane).alias("__l"), F.col(priority).alias("__p"), F.col(added).alias("__a"))
    order = Window.partitionBy(lane).orderBy(F.col(priority).desc(), added, ident)
    rows = queue.join(within, F.col(lane).eqNullSafe(F.col("__l")) & F.col(priority).eqNullSafe(F.col("__p")) & F.col(added).eqNullSafe(F.col("__a"))).drop("__l", "__p", "__a")
    return rows.withColumn("place", F.row_number().over(order)).withColumn("spent", F.sum(exact).over(order)).filter(F.col("spent") <= budget)


def spending_cap(total: Column, spent: Column, floor: float = 0.5, reserve: float = 1.0) -> Column:
    """What the next batch may spend: the rest less a reserve, and nothing below the floor."""
    rest = total - reserve - spent
    return F.when(rest < floor, 0.0).otherwise(rest)


def wait_state(pending: Column, progressed: Column, reason: Column) -> Column:
    """What a batch reports with rows left: a pause (quota, busy) wins over progress, and no progress waits to retry."""
    return F.when(pending == 0, "done").when(reason == "quota", "waiting daily").when(reason == "busy", "waiting busy").when(~F.coalesce(progressed, F.lit(False)), "waiting retry").otherwise("running")


def resume_time(state: Column, now: Column, until: Column, was_waiting: Column, progressed: Column) -> Column:
    """When a waiting batch is due: the pause's end, though half an hour on if it waited before in vain; at least a quarter of an hour for the others."""
    later = lambda minutes: now + F.expr(f"INTERVAL {minutes} MINUTES")
    again = F.coalesce(was_waiting, F.lit(False)) & ~F.coalesce(progressed, F.lit(False))
    return F.when(state == "waiting daily", F.when(again, later(30)).otherwise(until)).when(state == "waiting busy", F.greatest(until, later(15))).when(state == "waiting retry", later(15))


def stale(minutes: Column, restarts: Column, limit: int = 60, most: int = 3) -> Column:
    """running, restart or failed for an item by the minutes without progress."""
    return F.when(minutes <= limit, "running").when(restarts < most, "restart").otherwise("failed")


def dead_sites(visits: DataFrame, site: str, day: str, ok: str, least: int = 3) -> DataFrame:
    """Sites that failed on so many different days since they last answered."""
    last = visits.groupBy(site).agg(F.max(F.when(F.col(ok), F.col(day))).alias("last_ok"))
    bad = visits.join(last, site).filter(~F.col(ok) & (F.col("last_ok").isNull() | (F.col(day) > F.col("last_ok"))))
    return bad.groupBy(site).agg(F.count_distinct(day).alias("days")).filter(F.col("days") >= least)


def numbers_once(leads: DataFrame, shard: str, lead: str, order: str, number: str, per_lead: int = 3) -> DataFrame:
    """Give every number of a shard to the first lead that can take it: each lead has per_lead at most.

    A number beyond a lead's cap is not used up; a later lead may still take it. See allocate_once: no task holds a shard.
    """
    wants = leads.filter(F.col(number).isNotNull()).select(F.struct(shard, lead).alias("__agent"), F.struct(order, number).alias("__place"), F.struct(shard, number).alias("__item"), F.lit(per_lead).alias("__cap"))
    got = allocate_once(wants, "__agent", "__place", "__item", "__cap")
    return got.select(f"__agent.{shard}", f"__agent.{lead}", f"__place.{order}", f"__place.{number}")
