"""SimHash near-duplicate groups by the generalised pigeonhole principle.

A fingerprint has 64 bits. Two fingerprints link if they differ in at most ``limit`` bits. The bits are
dealt into partitions of correlated bits; partition i gets a threshold t_i >= -1 with
sum(t_i) = limit - m + 1, so that every linked pair is within t_i bits on some partition i. A dynamic
programme allots the thresholds (-1 skips a partition) with the fewest estimated candidates and probes.
The estimates come from the co-occurrence counts of the bits over all distinct fingerprints.

Documents with the same fingerprint are one node, so copies are never paired. Buckets of more than
``bucket`` fingerprints are not paired either: their fingerprints are linked through the Hamming balls
of radius 1 around them. Two fingerprints within 2 bits share a point of their balls, and all
fingerprints that share one are within 2 bits, at most 65 of them; so a large bucket costs 65 rows a
fingerprint and loses no link.

Defined results for odd input: null and blank texts have the fingerprint zero and link like any other;
texts of fewer words than a shingle have one shingle, all their words; repeated rows and repeated ids
are linked by their equal fingerprints; a null id takes the component of its fingerprint, and null if
no member has an id; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, join_unique, settle

BITS = 64
#: Buckets of more fingerprints are found by a broadcast of their keys, so that none is a hot partition.
HOT_BUCKET = 1_000_000


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of a text: bit b is set if over half of the shingles' XXH64 have it set."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and space and \t-\r only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    return of_hashes(hashes)


def of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of the hashes of shingles."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """Columns id and fp (the fingerprint as a signed long), a row for each row of docs."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle, seed) for x in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(of, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many the bits i and j are both set: 4096 numbers at most."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        n = 0
        for batch in batches:
            words = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(words, axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        cells = np.arange(BITS * BITS + 1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.append(total.ravel(), n))], names=["cell", "n"])

    got = fps.select("fp").mapInArrow(of, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for row in got:
        flat[row["cell"]] = row["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def differing(n: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of two fingerprints drawn at random: the chance that bit i differs, and that bits i and j both do."""
    p11 = both / max(n, 1)
    p = np.diag(p11)
    p10 = p[:, None] - p11
    p01 = p[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    joint = 2 * (p11 * p00 + p10 * p01)
    return 2 * p * (1 - p), np.where(np.eye(BITS, dtype=bool), 2 * p * (1 - p), joint)


def partition_bits(joint: np.ndarray, single: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits as equal in size as can be; each is grown from a bit by its most correlated free bits."""
    spread = np.sqrt(np.maximum(single * (1 - single), 1e-12))
    corr = np.abs((joint - np.outer(single, single)) / np.outer(spread, spread))
    free = set(range(BITS))
    groups = []
    for g in range(m):
        size = len(free) // (m - g)
        first = max(sorted(free), key=lambda b: sum(corr[b, x] for x in free if x != b))
        group = [first]
        free.discard(first)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: sum(corr[b, x] for x in group))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def chance_within(group: list[int], t: int, single: np.ndarray, joint: np.ndarray) -> float:
    """The estimated chance that two fingerprints differ in at most t bits of the group.

    A beta-binomial law with the group's true mean and variance of differing bits.
    """
    if t < 0:
        return 0.0
    w = len(group)
    mean = float(single[group].sum())
    var = float((joint[np.ix_(group, group)] - np.outer(single[group], single[group])).sum())
    p = min(max(mean / w, 1e-9), 1 - 1e-9)
    rho = min(max((var / (w * p * (1 - p)) - 1) / max(w - 1, 1), 1e-6), 1 - 1e-6)
    a, b = p * (1 / rho - 1), (1 - p) * (1 / rho - 1)
    log = lambda k: math.lgamma(w + 1) - math.lgamma(k + 1) - math.lgamma(w - k + 1) + math.lgamma(k + a) + math.lgamma(w - k + b) - math.lgamma(w + a + b) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    return min(1.0, sum(math.exp(log(k)) for k in range(t + 1)))


def masks_of(group: list[int], t: int) -> list[int]:
    """Masks such that two fingerprints within t bits on the group agree under one of them."""
    whole = sum(1 << b for b in group)
    if t < 0:
        return []
    return [whole & ~sum(1 << b for b in gone) for gone in itertools.combinations(group, min(t, len(group)))]


def allot(groups: list[list[int]], limit: int, n: int, single: np.ndarray, joint: np.ndarray) -> tuple[float, list[int]]:
    """The thresholds of least cost, sum limit - m + 1, by dynamic programming over the groups."""

    def cost(group: list[int], t: int) -> float:
        return n * len(masks_of(group, t)) + n * n / 2 * chance_within(group, t, single, joint)

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (spent, chosen) in best.items():
            for t in range(-1, limit + 1):
                now = (spent + cost(group, t), [*chosen, t])
                if total + t not in step or now[0] < step[total + t][0]:
                    step[total + t] = now
        best = step
    return best[limit - len(groups) + 1]


def plan(n: int, both: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """The partitions and their thresholds: the cheapest over the numbers of partitions."""
    single, joint = differing(n, both)
    options = []
    for m in range(1, limit + 3):
        groups = partition_bits(joint, single, m)
        spent, chosen = allot(groups, limit, n, single, joint)
        options.append((spent, m, list(zip(groups, chosen, strict=True))))
    return min(options)[2]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(fps: DataFrame, limit: int = 2, bucket: int = 48) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp) that connect what links within limit bits.

    Pairs of small buckets are verified one by one. The fingerprints of larger buckets are joined to the
    least one of each shared ball point, which connects the same documents without emitting all pairs.
    """
    if limit != 2:
        bucket = 1 << 62  # the balls of radius 1 decide 2 bits only; else all buckets are paired
    n, both = bit_counts(fps)
    masks = [m for group, t in plan(n, both, limit) for m in masks_of(group, t)]
    keys = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for k, m in enumerate(masks)])).alias("key")).select("fp", "key.k", "key.v")
    most = n * len(masks)
    crowded = settle(keys.groupBy("k", "v").agg(F.count("*").alias("c")).filter("c > 1"), "simhash-buckets", most)
    hot = crowded.filter(F.col("c") > HOT_BUCKET).select("k", "v")  # at most keys / HOT_BUCKET of them
    if bucket < HOT_BUCKET and not hot.isEmpty():
        hot = F.broadcast(settle(hot, "simhash-hot"))
        apart = keys.join(hot, ["k", "v"], "left_semi").withColumn("c", F.lit(HOT_BUCKET + 1).cast("bigint"))
        members = settle(apart.unionByName(keys.join(hot, ["k", "v"], "left_anti").join(crowded, ["k", "v"])), "simhash-members", most)
    else:
        members = settle(keys.join(crowded, ["k", "v"]), "simhash-members", most)
    few = members.filter(F.col("c") <= bucket).select("k", "v", "fp")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= limit
    pairs = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["k", "v"]).filter("a < b").filter(near).select("a", "b")
    edges = pairs
    if bucket < 1 << 62:
        many = members.filter(F.col("c") > bucket).select("fp").distinct()
        points = many.select("fp", F.explode(_ball(F.col("fp"))).alias("z"))
        shared = points.groupBy("z").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
        edges = edges.union(shared.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a < b"))
    return edges.distinct()


def _ball(fp: Column) -> Column:
    return F.concat(F.array(fp), F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the connected components of the edges a, b, one root for each, by contraction.

    Each round every node follows its neighbour of least hash, twice removed, and edges are drawn anew
    between what the ends followed. Hashes make the chains short, so the rounds are about the logarithm
    of the nodes. All state is in tables; nothing is gathered on the driver or in one group.
    """
    edge = settle(edges.select("a", "b"), "links")
    most = 2 * edge.count()  # neither nodes nor edges become more
    root: DataFrame | None = None
    while not edge.isEmpty():
        ways = edge.select("a", "b").union(edge.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        up = ways.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("least")).select("node", F.least(order("node"), F.col("least"))["id"].alias("up"))
        up = settle(up, "follow", most)
        twice = settle(up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up")), "follow", most)
        old_root, old_edge = root, edge
        if root is None:
            root = twice.select("node", F.col("up").alias("root"))
        else:
            root = root.join(twice.select(F.col("node").alias("root"), "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        root = settle(root, "roots", most)
        moved = edge.join(twice.select(F.col("node").alias("a"), F.col("up").alias("x")), "a").join(twice.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        edge = settle(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links", most)
        for old in (up, twice, old_root, old_edge):
            discard(old)
    if root is None:
        node = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {node}, root {node}")
    return root


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """id, fp and component (the least id reachable over links) for every row of docs."""
    marked = settle(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fps")
    nodes = settle(marked.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("c")), "simhash-nodes")
    linked = components(links(nodes.select("fp"), limit))
    rooted = nodes.join(linked.select(F.col("node").alias("fp"), "root"), "fp")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    part = settle(rooted.join(least, "root").select("fp", "component"), "simhash-parts")
    named = nodes.join(part, "fp", "left").select("fp", "c", F.coalesce("component", "rep").alias("component"))
    named = settle(named, "simhash-named")
    return join_unique(marked, named, "fp").select("id", "fp", "component")
