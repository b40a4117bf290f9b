"""The pace of calls to a service that refuses when asked too often: an ordered fold, computed as a parallel prefix.

After a refusal the gap doubles (2 s at least, 30 s at most) and the run of answers is forgotten; after ten answers in a row it
shrinks to seven tenths, or to nothing if it was half a second or less. How long a run is doesn't depend on the gap, so over a
stretch of calls the run goes through a machine of ten states, and for each state that it may begin in the gap goes through a
function of one shape: a constant up to a threshold, and above it a line, clamped. Such functions compose to such functions. Each
stretch is summed up as ten of them; one pass over the stretches (a row each) gives every stretch what it begins with.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.sources.scratch import written

RUN, LEAST, MOST, SHRINK, SMALL = 10, 2.0, 30.0, 0.7, 0.5
#: The identity: constant low up to threshold, above it slope * gap within floor and ceiling.
SAME = (-1.0, 0.0, 1.0, 0.0, MOST)


def answered(run: int, gap: float, refused: bool) -> tuple[int, float]:
    """One call: the run of answers and the gap after it."""
    if refused:
        return 0, min(max(gap * 2, LEAST), MOST)
    if run + 1 < RUN:
        return run + 1, gap
    return 0, gap * SHRINK if gap > SMALL else 0.0


def doubled(f: tuple) -> tuple:
    limit = lambda g: min(max(2 * g, LEAST), MOST)
    t, low, a, floor, ceiling = f
    return t, limit(low), 2 * a, limit(floor), limit(ceiling)


def shrunk(f: tuple) -> tuple:
    t, low, a, floor, ceiling = f
    cut = lambda g: g * SHRINK if g > SMALL else 0.0
    if ceiling <= SMALL:
        return t, cut(low), 0.0, 0.0, 0.0
    if floor > SMALL:
        return t, cut(low), a * SHRINK, floor * SHRINK, ceiling * SHRINK
    return max(t, SMALL / a), cut(low), a * SHRINK, 0.0, ceiling * SHRINK


def value(f: tuple, gap: float) -> float:
    t, low, a, floor, ceiling = f
    return low if gap <= t else min(max(a * gap, floor), ceiling)


def summed(refusals: list[bool]) -> list[tuple[int, tuple]]:
    """For each run that a stretch may begin with: the run that it ends with, and what it makes of the gap."""
    out = []
    for run in range(RUN):
        f = SAME
        for r in refusals:
            if r:
                run, f = 0, doubled(f)
            elif run + 1 < RUN:
                run += 1
            else:
                run, f = 0, shrunk(f)
        out.append((run, f))
    return out


def paced(calls: DataFrame, key: str, order: str, refused: str, stretch: int = 1000) -> DataFrame:
    """key, order and gap: what to wait after each call of its key, in order. A key's calls are cut into stretches by ranges of
    order over the whole table, so none has to fit one task; order must tell the calls of a key apart."""
    rows = calls.select(F.col(key).alias("key"), F.col(order).alias("at"), F.coalesce(refused, F.lit(False)).alias("no"))
    spark = calls.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Calls with the number of their stretch: at most so many calls of one key."""
        from pyspark import TaskContext

        number, who, size = (TaskContext.get().partitionId() << 32) - 1, None, 0
        for b in batches:
            pieces = []
            for k in b["key"]:
                if k != who or size == stretch:
                    number, who, size = number + 1, k, 0
                size += 1
                pieces.append(number)
            yield b.assign(piece=pieces)

    kind = rows.schema["key"].dataType.simpleString()
    at = rows.schema["at"].dataType.simpleString()
    cutted = written(rows.repartitionByRange(n, "key", "at").sortWithinPartitions("key", "at").mapInPandas(cut, f"key {kind}, at {at}, no boolean, piece long"), "paced")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []

        def row(piece: int, k, refusals: list[bool]) -> tuple:
            return piece, k, [r for r, _ in summed(refusals)], [x for _, f in summed(refusals) for x in f]

        piece, k, said = None, None, []
        for b in batches:
            for p, kk, no in zip(b["piece"], b["key"], b["no"], strict=True):
                if p != piece:
                    if piece is not None:
                        held.append(row(piece, k, said))
                    piece, k, said = p, kk, []
                said.append(bool(no))
            if len(held) > 500:
                yield pd.DataFrame(held, columns=["piece", "key", "runs", "lines"])
                held = []
        if piece is not None:
            held.append(row(piece, k, said))
        yield pd.DataFrame(held, columns=["piece", "key", "runs", "lines"])

    dealt = cutted.repartition("piece").sortWithinPartitions("piece", "at")
    pieces = written(dealt.mapInPandas(sums, f"piece long, key {kind}, runs array<int>, lines array<double>"), "paces")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who, run, gap = None, 0, 0.0
        for b in batches:
            out = []
            for piece, k, runs, lines in zip(b["piece"], b["key"], b["runs"], b["lines"], strict=True):
                if k != who:
                    who, run, gap = k, 0, 0.0
                out.append((piece, run, gap))
                run, gap = int(runs[run]), value(tuple(lines[5 * run : 5 * run + 5]), gap)
            yield pd.DataFrame(out, columns=["piece", "run", "gap"])

    # a row for each stretch of so many calls
    begun = pieces.repartition("key").sortWithinPartitions("key", "piece").mapInPandas(scan, "piece long, run int, gap double")

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, run, gap = None, 0, 0.0
        for b in batches:
            out = []
            for p, no, r, g in zip(b["piece"], b["no"], b["run"], b["gap"], strict=True):
                if p != piece:
                    piece, run, gap = p, r, g
                run, gap = answered(run, gap, bool(no))
                out.append(gap)
            yield b.assign(gap=out)[["key", "at", "gap"]]

    begun = cutted.join(begun, "piece").repartition("piece").sortWithinPartitions("piece", "at")
    told = begun.mapInPandas(go, f"key {kind}, at {at}, gap double")
    return told.select(F.col("key").alias(key), F.col("at").alias(order), "gap")
