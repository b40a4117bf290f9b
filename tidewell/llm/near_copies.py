"""Groups of near copies: documents that share most of their shingles of five words.

Two documents link if the Jaccard similarity of their sets of shingles is ``similarity`` or more; a group is
what links connect. Operator 1 (simhash.py) goes first, over shingles of five words: texts of one fingerprint,
and of fingerprints that it links, are verified by their whole sets, and what that connects is paired no more.
Pairs of similarity 0.8 differ in more bits than a pigeonhole over 64 can find, so more are looked for: minima of
``BANDS * ROWS`` hash functions over a set, dealt into bands, propose pairs: a pair of similarity 0.8 shares none of the
40 bands of 6 with a chance of 6 in a million, a closer one with less.

A proposed pair becomes a row only if exact bounds leave it possible; none of them loses a link. Sizes must agree. A bitmap
of 1,024 bits marks the hashes of a set: each bit that only one set has is a shingle that the other lacks, which bounds what they
share. What is left is verified on whole sets of sorted hashes, so no wrong pair links.

Equal texts are one node and are never paired, nor are texts that are already connected. In a bucket of over ``bucket`` nodes all
are compared with its pivot first: the node that has most company in all such buckets, which of many copies tends to be
the text that they were made from. Members that this did not connect with the pivot may pair with any other; how many
shingles of theirs no other member of such buckets has is counted, since those can't be shared: copies with many edits of their own
can't have a partner and leave, the others are compared with all whose size, bitmap and unshared shingles allow it.

Defined results for odd input: words are split and folded as in simhash.py; texts of fewer words than a
shingle have one shingle, all their words; null and blank texts are alike; rows without an id are not read;
rows with one id and several texts are several nodes; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_of, discard, join_unique, settle
from .simhash import components, of_hashes
from .simhash import links as fingerprint_links

BANDS, ROWS = 40, 6
#: Words of 64 bits of a set's bitmap.
BITMAP = 16
#: So many nodes are broadcast, of 8 bytes each, to fetch their texts; more are shuffled with all texts.
FEW_NODES = 1_000_000
#: Of texts or sets that a task holds at once.
BATCH = "4m"
#: Odd factors and summands of the hash functions.
FACTORS, SUMMANDS = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """The XXH64 of the text's shingles, repeats included, one at least."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    return np.fromiter((xxhash.xxh64_intdigest(line[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)), np.uint64, len(starts))


def shingle_set(text: str | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted and distinct."""
    return np.unique(shingle_hashes(text, shingle, seed))


def bands(found: np.ndarray) -> list[int]:
    """A signed key for each band of the set's minima."""
    import xxhash

    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), 1024):
        least = np.minimum(least, (FACTORS[:, None] * found[None, k : k + 1024] + SUMMANDS[:, None]).min(axis=1))
    keys = [xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def bitmap(found: np.ndarray) -> list[int]:
    """BITMAP signed words; a bit is set if a hash of the set begins with its number."""
    marks = np.zeros(64 * BITMAP, bool)
    marks[(found >> np.uint64(54)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").view(np.int64).tolist()


def sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """node, fp (operator 1's fingerprint; blank texts have zero), n (shingles), keys (of the bands) and bits for each node of the rows node, text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sizes, keys, bits = [], [], [], []
            for x in batch.column(1):
                text = x.as_py()
                hashes = shingle_hashes(text, shingle)
                found = np.unique(hashes)
                fps.append(of_hashes(hashes) if text and not text.isspace() else 0)
                sizes.append(len(found))
                keys.append(bands(found))
                bits.append(bitmap(found))
            cols = [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["node", "fp", "n", "keys", "bits"])

    found = rows.select("node", "text").mapInArrow(of, "node long, fp long, n int, keys array<long>, bits array<long>")
    return found.groupBy("node").agg(*[F.first(c).alias(c) for c in ("fp", "n", "keys", "bits")])


def possible(x: str, y: str, similarity: float) -> Column:
    """Whether sets of prefixes x and y (n and bits) may be similar enough, by their sizes and bitmaps."""
    m, n = F.col(f"{x}n"), F.col(f"{y}n")
    lacks = lambda s, t: sum((F.bit_count(F.col(f"{s}bits")[k].bitwiseAND(F.bitwise_not(F.col(f"{t}bits")[k]))) for k in range(1, BITMAP)), F.bit_count(F.col(f"{s}bits")[0].bitwiseAND(F.bitwise_not(F.col(f"{t}bits")[0]))))
    shared = F.lit(similarity / (1 + similarity)) * (m + n) - 1e-6
    return (F.least(m, n) >= shared) & (m - lacks(x, y) >= shared) & (n - lacks(y, x) >= shared)


def hashed_sets(rows: DataFrame, nodes: DataFrame, shingle: int, most: int) -> DataFrame:
    """node and set (sorted hashes of 64 bits) of those nodes, of which there are at most so many."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingle_set(x.as_py(), shingle).tobytes() for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["node", "set"])

    wanted = settle(nodes.select("node").distinct(), "copies-wanted", most)
    n = wanted.count()
    few = F.broadcast(wanted) if n <= FEW_NODES else wanted
    texts = rows.select("node", "text").join(few, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    out = settle(texts.mapInArrow(of, "node long, set binary"), "copies-sets", 100 * n)  # 2,500 texts a file
    discard(wanted)
    return out


def verified(pairs: DataFrame, rows: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The pairs a, b of nodes whose sets are similar enough."""
    n = pairs.count()
    sets = hashed_sets(rows, pairs.select(F.explode(F.array("a", "b")).alias("node")), shingle, 2 * n)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (s, t))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both / (len(x) + len(y) - both) >= similarity)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("s")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("t")), "b")
    out = settle(both.select("a", "b", "s", "t").mapInArrow(of, "a long, b long"), "copies-links", n)
    discard(sets)
    return out


def unshared(rows: DataFrame, nodes: DataFrame, shingle: int, most: int) -> DataFrame:
    """node and u: how many of its shingles no other of these nodes has; nodes without any are absent."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
                node = np.repeat(part.column(0).to_numpy(), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(sets))], names=["node", "hash"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = hashed_sets(rows, nodes, shingle, most).repartition(tasks)  # few files become many rows
    single = sets.mapInArrow(of, "node long, hash long").groupBy("hash").agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1")
    return single.groupBy("node").agg(F.count("*").alias("u"))


def by_fingerprint(sketched: DataFrame, limit: int = 2) -> DataFrame:
    """Pairs a, b of nodes that operator 1 connects: with one fingerprint, or with fingerprints that it links."""
    fps = sketched.select("node", "fp")
    lead = settle(fps.groupBy("fp").agg(F.min("node").alias("a"), F.count("*").alias("c")), "copies-leads", fps.count())
    same = join_unique(fps, lead.filter("c > 1"), "fp").filter("a <> node").select("a", F.col("node").alias("b"))
    near = fingerprint_links(lead.select("fp"), limit).withColumnRenamed("a", "x").withColumnRenamed("b", "y")
    near = near.join(lead.select(F.col("fp").alias("x"), "a"), "x").join(lead.select(F.col("fp").alias("y"), F.col("a").alias("b")), "y")
    return settle(same.union(near.select("a", "b")), "copies-near")


def links(rows: DataFrame, similarity: float = 0.8, shingle: int = 5, bucket: int = 48) -> DataFrame:
    """Verified edges a, b that connect what similar nodes connect; rows: node, text, maybe repeated."""
    made: list[DataFrame] = []

    def keep(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
        made.append(settle(df, tag, rows))
        return made[-1]

    def done(edges: DataFrame) -> DataFrame:
        for old in made:
            if old is not edges:
                discard(old)
        return edges

    whole = keep(sketches(rows, shingle), "copies-sketches")
    close = verified(by_fingerprint(whole), rows, similarity, shingle)
    made.append(close)
    # A node is known by the least that it is directly connected with: nodes of one such name are connected.
    first = close.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("first"))
    sketched = whole.drop("fp").join(first, "node", "left").withColumn("first", F.coalesce("first", "node"))
    keys = sketched.select("node", "first", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("c"), F.max("first").alias("most"), F.min("first").alias("fewest")).filter("c > 1 AND most <> fewest").select("key", "c")
    members = join_unique(keys, keep(shared, "copies-buckets").withColumn("of", F.col("c")), "key").withColumnRenamed("of", "c")
    members = keep(members.join(whole.select("node", "n", "bits"), "node"), "copies-members")
    most = members.count()
    side = lambda df, name, *more: df.select("key", F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("bits").alias(f"{name}_bits"), *[F.col(c).alias(f"{name}_{c}") for c in more])
    can = possible("a_", "b_", similarity)
    few = members.filter(F.col("c") <= bucket)
    a, b = side(few, "a", "first"), side(few, "b", "first")
    near = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (F.col("a_first") != F.col("b_first")) & can)
    many = members.filter(F.col("c") > bucket)
    weighed = keep(many.join(many.groupBy("node").agg(F.sum("c").alias("weight")), "node"), "copies-crowded", most)
    pivots = weighed.groupBy("key").agg(F.max(F.struct("weight", "node", "n", "bits", "first")).alias("p"), F.count("*").alias("c"))
    pivots = keep(pivots.select("key", "c", F.col("p.node").alias("b"), F.col("p.n").alias("b_n"), F.col("p.bits").alias("b_bits"), F.col("p.first").alias("b_first")), "copies-pivots", most)
    star = join_unique(side(many, "a", "first"), pivots, "key").filter((F.col("a") != F.col("b")) & (F.col("a_first") != F.col("b_first")) & can)
    pairs = keep(near.select("a", "b").union(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct(), "copies-pairs")
    edges = keep(close.union(verified(pairs, rows, similarity, shingle)), "copies-edges", close.count() + pairs.count())
    if pivots.isEmpty():
        return done(edges)
    roots = components(edges).select("node", "root")
    rooted = many.select("key", "node", "n", "bits").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    led = pivots.select("key", "c", F.col("b").alias("node")).join(roots, "node", "left").select("key", "c", F.coalesce("root", "node").alias("led"))
    rooted = keep(join_unique(rooted, led, "key"), "copies-rooted", most)
    loose = keep(rooted.filter("root <> led").select("key").distinct(), "copies-loose", most)
    if loose.isEmpty():
        return done(edges)
    rooted = rooted.join(loose, "key", "left_semi")
    alone = keep(unshared(rows, rooted.select("node"), shingle, most), "copies-alone", most)
    # x shares n - u shingles at most, so its partner's size has a bound, which must reach the least size that fits
    reach = (F.col("n") - F.coalesce("u", F.lit(0))) * F.lit((1 + similarity) / similarity) - F.col("n") + 1e-6
    alive = keep(rooted.join(alone, "node", "left").withColumn("most", reach).filter(F.col("most") >= F.col("n") * similarity), "copies-alive", most)
    a, b = side(alive.filter("root <> led"), "a", "root", "most"), side(alive, "b", "root", "most")
    rest = a.join(b, (a["key"] == b["key"]) & (F.col("a_root") != F.col("b_root")) & (F.col("b_n") <= F.col("a_most")) & (F.col("a_n") <= F.col("b_most")) & can)
    rest = keep(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"), "copies-rest")
    return done(keep(edges.union(verified(rest, rows, similarity, shingle)), "copies-edges", edges.count() + rest.count()))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, shingle: int = 5, bucket: int = 48) -> DataFrame:
    """id and node of one text of each group: that of the least id."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), node_of(text_col).alias("node")).filter("id IS NOT NULL")
    nodes = settle(rows.groupBy("node").agg(F.min("id").alias("id")), "copies-nodes")
    with batches_of(docs.sparkSession, BATCH):
        edges = links(rows, similarity, shingle, bucket)
    roots = components(edges)
    grouped = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(F.struct("id", "node")).alias("kept"))
    out = settle(grouped.select("kept.id", "kept.node"), "copies-kept")
    for old in (nodes, edges, roots):
        discard(old)
    return out


def node_of(text_col: str):
    """The key of equal texts."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
