"""Fingerprints of documents as quartile digests of hashed byte triplets, and how alike they are.

The byte triplets at three spacings are hashed into ``BUCKETS`` buckets and counted. A bucket's code is how many of the three
quartiles of the text's own counts it exceeds (0 to 3); the digest is the length's logarithm in one byte and two bits a
bucket, in hexadecimal. Codes don't depend on the length, and a local edit moves few of them.

Two digests differ by the sum of their codes' differences, of which the largest (3) weighs 6, plus what their lengths
differ by, of at most ``LENGTH_MOST``. Likeness is 1 less that over ``BOUND``, at least 0; unrelated texts of one language
differ by some 330.

``with_neighbours`` goes once through all texts in the order of their ids, sorted by ranges over the cluster;
a partition's last document meets the first one of the partition after it in a table of two rows a partition.

Defined results for odd input: null texts are empty; texts of fewer bytes than a triplet spans have no counts, so that all of one
length are alike; texts of any length are read whole; rows without an id come first, rows of one id are ordered by their text's
hash, repeated rows stand beside each other as documents of their own; the document after the last is the first, a
lone document's is itself; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _chunks
from .common import settle

BUCKETS = 256
#: Offsets of the bytes of a triplet, and odd factors of its hash.
SPACINGS = ((0, 5, 11), (0, 7, 13), (0, 6, 16))
FACTORS = np.random.default_rng(12).integers(0, 1 << 31, (len(SPACINGS), 4), np.uint32) * np.uint32(2) + np.uint32(1)
WEIGHTS = np.array([0, 1, 2, 6])
#: The length code grows by one as a text grows by a quarter; a step of difference weighs 8.
LENGTH_BASE, LENGTH_WEIGHT, LENGTH_MOST = math.log(1.25), 8, 64
BOUND = 512


def codes(texts: list[str]) -> np.ndarray:
    """A row for each text: its length code, then its buckets' codes."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    flat, doc = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32), np.repeat(np.arange(len(raw)), size)
    counts = np.zeros(len(raw) * BUCKETS, np.int64)
    for offsets, (f, g, h, shift) in zip(SPACINGS, FACTORS, strict=True):
        n = len(flat) - offsets[-1]
        if n <= 0:
            continue
        x, y, z = (flat[k : k + n] for k in offsets)
        hashed = x * f + y * g + z * h + shift
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x2C1B3C6D)
        inside = doc[:n] == doc[offsets[-1] :]
        counts += np.bincount((doc[:n] * BUCKETS + (hashed >> np.uint32(24)))[inside], minlength=len(counts))
    counts = counts.reshape(len(raw), BUCKETS)
    quartiles = np.partition(counts, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1], axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    levels = (counts[:, :, None] > quartiles[:, None, :]).sum(axis=2)
    lengths = np.minimum(255, np.floor(np.log1p(size) / LENGTH_BASE)).astype(np.int64)
    return np.concatenate([lengths[:, None], levels], axis=1).astype(np.uint8)


def written(found: np.ndarray) -> list[str]:
    """Digests of rows of codes, in hexadecimal."""
    packed = found[:, 1::4] << 6 | found[:, 2::4] << 4 | found[:, 3::4] << 2 | found[:, 4::4]
    return [bytes(x).hex() for x in np.concatenate([found[:, :1], packed], axis=1)]


def read(digest: str) -> np.ndarray:
    """The codes of a digest."""
    x = np.frombuffer(bytes.fromhex(digest), np.uint8)
    return np.concatenate([x[:1], np.stack([x[1:] >> s & 3 for s in (6, 4, 2, 0)], axis=1).reshape(-1)])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of codes, one by one."""
    apart = np.abs(a.astype(np.int64) - b)
    score = WEIGHTS[apart[:, 1:]].sum(axis=1) + np.minimum(LENGTH_MOST, LENGTH_WEIGHT * apart[:, 0])
    return 1 - np.minimum(score, BOUND) / BOUND


def edited(text: str, after: str) -> str:
    """text with its last half replaced by as much of the beginning of the one after it."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


FOUND = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(texts: list[str], after: list[str], own: np.ndarray, next_: np.ndarray) -> list[pa.Array]:
    made = [edited(t, a) for t, a in zip(texts, after, strict=True)]
    other = codes(made)
    digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in made]
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array(digests), pa.array(written(own)), pa.array(written(other)), pa.array(likeness(own, other)), pa.array(likeness(own, next_))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(written(codes(texts)), pa.string())], names=["id", "fingerprint"])

    return rows.mapInArrow(of, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string")


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row (see edited; next: by ascending id)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = [x.split()[0] for x in FOUND.split(", ")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, held = TaskContext.get().partitionId(), None  # held: the row before, its text and codes

        def edge(side: str, ids: pa.Array, text: str) -> pa.RecordBatch:
            blank = [pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.string())] * 3, *[pa.nulls(1, pa.float64())] * 2]
            return pa.RecordBatch.from_arrays([pa.array([pid], pa.int64()), pa.array([side]), ids, *blank, pa.array([text])], names=["pid", "edge", "id", *names, "text"])

        for part, texts in _chunks(batches):
            found, ids = codes(texts), part.column(0)
            if held is None:
                yield edge("first", ids.slice(0, 1), texts[0])
            else:
                texts, found, ids = [held[1], *texts], np.concatenate([held[2], found]), pa.concat_arrays([held[0], ids])
            n = len(texts) - 1
            if n:
                cols = _compared(texts[:n], texts[1:], found[:n], found[1:])
                yield pa.RecordBatch.from_arrays([pa.array([pid] * n, pa.int64()), pa.nulls(n, pa.string()), ids.slice(0, n), *cols, pa.nulls(n, pa.string())], names=["pid", "edge", "id", *names, "text"])
            held = ids.slice(n, 1), texts[n], found[n:]
        if held is not None:
            yield edge("last", held[0], held[1])

    hashed = rows.withColumn("at", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = hashed.repartitionByRange("id", "at", "row").sortWithinPartitions("id", "at", "row").select("id", "text")
    found = settle(ordered.mapInArrow(of, f"pid long, edge string, id {kind}, {FOUND}, text string"), "digests")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches):
            after = part.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([part.column(0), *_compared(texts, after, codes(texts), codes(after))], names=["id", *names])

    lasts, firsts = found.filter("edge = 'last'").select("pid", "id", "text"), found.filter("edge = 'first'").select("pid", F.col("text").alias("after"))
    pids = Window.orderBy("pid")  # one row a partition
    order = firsts.select("pid").select("pid", F.coalesce(F.lead("pid").over(pids), F.min("pid").over(pids)).alias("to"))
    edges = lasts.join(order, "pid").join(firsts.withColumnRenamed("pid", "to"), "to").select("id", "text", "after")
    return found.filter("edge IS NULL").select("id", *names).unionByName(edges.mapInArrow(pairs, f"id {kind}, {FOUND}"))
