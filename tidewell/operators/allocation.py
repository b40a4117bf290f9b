"""Giving things out once, in an order of claims, without a fold over all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.keys import phone_digits, phone_hash
from tidewell.sources.scratch import cleared, written

#: One in so many rows of a batch tells early which numbers will be gone; numbers so told at most (a broadcast: others go on untold, to the rounds).
TELLING, TOLD = 8, 1_000_000
#: What ``_item`` gives for six digits at least.
LEAST = 1_000_000


def allocate_once(wants: DataFrame, agent: str, place: str, item: str, cap: str) -> DataFrame:
    """The rows of wants (agent in their order, place of the wish, item, cap of the agent) that are granted.

    As if agents came one by one and took the items they want, by place, that are still there, as many as their cap. In
    rounds: a wish is granted if no earlier agent still wants the item and the agent's open wishes before it can't fill the cap; then
    wishes for granted items and of agents with a full cap fall. So do those of later agents for an item that an agent's open wishes before it
    can't keep from being taken: it is gone after that agent at the latest. The first open wish of all is always granted, and
    mostly very many are: a hot item goes in the first round that its first agent gets it. agent and place must tell rows apart.
    """
    rows = wants.select(agent, place, item, cap).filter(F.col(item).isNotNull())
    # an agent wants an item once, at its first place
    once = rows.repartition(agent).groupBy(agent, item).agg(F.min(F.struct(place, cap)).alias("w")).select(agent, item, F.col(f"w.{place}").alias(place), F.col(f"w.{cap}").alias(cap), F.col(f"w.{cap}").cast("int").alias("left"), F.lit(False).alias("got"))
    w = Window.partitionBy(agent).orderBy(place)
    # sure: nothing but an earlier agent can take the item from this one
    sure = ~F.col("got") & (F.row_number().over(Window.partitionBy(agent, "got").orderBy(place)) <= F.col("left"))
    state = written(once.withColumn("sure", sure), "wishes")
    granted: list[DataFrame] = []
    while not state.filter("NOT got").isEmpty():
        # the state holds the wishes of the last round as well, so that what they took is gone in this one
        first = state.groupBy(item).agg(F.min(agent).alias("__first"), F.max("got").alias("__gone"), F.min(F.when(F.col("sure"), F.col(agent))).alias("__by")).filter("NOT __gone").drop("__gone")
        still = state.join(first, item).filter(F.col("__by").isNull() | (F.col(agent) <= F.col("__by")))
        ranked = still.withColumn("got", (F.row_number().over(w) <= F.col("left")) & (F.col(agent) == F.col("__first")))
        after = ranked.withColumn("left", F.col("left") - F.sum(F.col("got").cast("int")).over(Window.partitionBy(agent)).cast("int"))
        old, state = state, written(after.filter("got OR left > 0").withColumn("sure", sure).select(agent, item, place, cap, "left", "got", "sure"), "wishes")
        cleared(old)
        granted.append(written(state.filter("got").select(agent, place, item, cap), "granted"))
    cleared(state)
    if not granted:
        return rows.limit(0)
    out = granted[0]
    for more in granted[1:]:
        out = out.unionByName(more)
    return out


def _item(number: Column) -> Column:
    """The last eight digits behind a 1: one for numbers that phone_hash holds equal, but short and cheap; under a million (LEAST) for fewer than six digits."""
    return F.concat(F.lit("1"), F.right(phone_digits(number), F.lit(8))).cast("long")


def _untried(wishes: DataFrame, tried: DataFrame) -> DataFrame:
    """wishes (institute, number and more) without those that the institute tried before."""
    # as bytes, half as long, and never null, or each would be made twice: once to be asked for null
    seen = tried.select("institute", F.coalesce(F.unhex("hash"), F.lit(b"")).alias("hash"))
    return wishes.withColumn("hash", F.unhex(phone_hash(F.col("number")))).join(seen, ["institute", "hash"], "left_anti").drop("hash")


def lead_numbers(rows: DataFrame, people: DataFrame, tried: DataFrame, order: str, most: int = 3) -> DataFrame:
    """order, person, k, number: which numbers each row of a batch takes, every number once in the file.

    rows: order (its place in the file), institute (its key) and numbers (the sheet's own, then offices': an array); people: order,
    person (0 the main one) and phone; tried: institute and hash of numbers that were tried before. A row's main lead wants the sheet's first
    two numbers, the main person's, then the offices' and takes three; then each further person takes their own number, if it
    is still free: a lead of their own (person). Numbers are equal by the hash of their last eight digits; shorter ones than six digits don't count.
    """
    # one join brings a row's persons, few, beside its numbers
    beside = people.groupBy(order).agg(F.collect_list(F.struct("person", "phone")).alias("__p"))
    main = F.get(F.filter("__p", lambda p: p["person"] == 0), 0)["phone"]
    own = F.struct(F.lit(0).alias("person"), F.concat(F.slice("numbers", 1, 2), F.array(main), F.slice("numbers", 3, 1_000_000)).alias("numbers"))
    others = F.transform(F.filter(F.coalesce("__p", F.array()), lambda p: p["person"] > 0), lambda p: F.struct(p["person"].cast("int").alias("person"), F.array(p["phone"]).alias("numbers")))
    leads = rows.join(beside, order, "left").select(order, "institute", F.explode(F.concat(F.array(own), others)).alias("__l"))
    wanted = leads.select(order, "institute", F.col("__l.person").alias("person"), F.posexplode("__l.numbers").alias("k", "number")).withColumn("item", _item(F.col("number")))
    cap = F.when(F.col("person") == 0, most).otherwise(1)
    # a lead takes what stands at its first places, if nobody did before: later rows needn't ask for that. What a few rows tell keeps most wishes, far more than numbers, off the disk
    counted = wanted.filter((F.pmod(F.xxhash64(order), F.lit(TELLING)) == 0) & (F.col("item") >= LEAST)).withColumn("n", F.row_number().over(Window.partitionBy(order, "person").orderBy("k", F.btrim("number"))))
    told = _untried(counted.filter(F.col("n") <= cap), tried).groupBy("item").agg(F.min(order).alias("__by")).limit(TOLD)
    # one condition, which can't sink below the join, so that digits are read once
    open_still = F.when(F.col("item") >= LEAST, F.coalesce(F.col(order) <= F.col("__by"), F.lit(True))).otherwise(False)
    wishes = _untried(wanted.join(F.broadcast(told), "item", "left").filter(open_still).drop("__by"), tried)
    # the number rides behind its place, so that no wish is made twice
    asked = wishes.select(F.struct(order, "person").alias("agent"), F.struct("k", F.btrim("number").alias("number")).alias("place"), "item", cap.alias("cap"))
    got = allocate_once(asked, "agent", "place", "item", "cap")
    return got.select(f"agent.{order}", "agent.person", "place.k", "place.number")
