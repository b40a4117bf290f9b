"""Alignment of two tokenizers over the bytes of each text, by a dangling-suffix transducer.

The transducer reads the tokens of both sides. Its state is which side leads and the bytes of that side's last
token that the other side has not matched yet; the next token of the other side either shortens that residual,
overtakes it (then the other side leads with its own dangling suffix) or matches it exactly, which closes a group.
Transitions are memoised by state and token. Each token that is read against a residual is linked with the token
that left it, so links are found without offsets.

Texts are cut before each space that follows a character other than white space: no token of either side crosses
such a place (words of the byte-level side start there; that no piece of the other side does is checked when its
vocabulary is loaded). Equal segments are encoded and aligned once a task, within ``KEPT_CHARS``.

Counting pairs over the corpus: texts go through tasks in blocks of about ``BLOCK_CHARS``. A block yields its documents
(with the numbers of its pairs that each holds) and its pairs, with the number of its documents that hold them. Pairs are summed over the blocks, joined back to each block, and meet the block's documents in
one group, so no document's links are ever exploded and no table of pairs is broadcast.

Defined results for odd input: null and empty texts, and texts whose tokens don't spell a space and the text
(such as those with U+2581), have no tokens: zeros and the empty string; they count for no pair. Texts of any length
are read whole. Ties for a token's highest count all count as best. Repeated rows are documents of their own, also
where they share an id; rows without an id are documents too. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _chunks, _take, byte_letters
from .common import settle

#: Characters of text in a block, and of distinct segments that a task remembers.
BLOCK_CHARS, KEPT_CHARS = 1 << 20, 3 << 21
#: Before a space that follows something else than white space.
CUT = re.compile(r"(?<=\S)(?= )")


class Transducer:
    """Aligns token ids of two sides whose bytes are given by id."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.sides = {1: a_bytes, -1: b_bytes}
        self.states: dict[tuple[int, bytes], int] = {}  # positive numbers where A leads, negative ones where B does
        self.residuals: dict[int, bytes] = {0: b""}
        self.moves: dict[tuple[int, int], int | None] = {}

    def state(self, side: int, residual: bytes) -> int:
        if not residual:
            return 0
        key = (side, residual)
        if key not in self.states:
            number = side * (len(self.states) + 1)
            self.states[key], self.residuals[number] = number, residual
        return self.states[key]

    def move(self, state: int, token: int) -> int | None:
        """The state after the next token, which is A's in the empty state, else the side's that doesn't lead; None if the bytes differ."""
        key = (state, token)
        if key in self.moves:
            return self.moves[key]
        lead = -1 if state <= 0 else 1
        said, residual = self.sides[-lead][token], self.residuals[state]
        if len(said) >= len(residual):
            out = self.state(-lead, said[len(residual) :]) if said.startswith(residual) else None
        else:
            out = self.state(lead, residual[len(said) :]) if residual.startswith(said) else None
        if len(self.moves) > 500_000:  # what is forgotten is found anew
            self.moves.clear()
        self.moves[key] = out
        return out

    def align(self, a: list[int], b: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]] | None:
        """Where groups end on both sides, and the links; None unless both sides spell the same bytes."""
        ends, links, state, i, j, led = [], [], 0, 0, 0, -1
        known, n, m = self.moves.get, len(a), len(b)
        while state or i < n:
            if state > 0:
                if j == m:
                    return None
                token = b[j]
                j += 1
                links.append((led, token))
            else:
                if i == n:
                    return None
                token = a[i]
                i += 1
                if state:
                    links.append((token, led))
            after = known((state, token))
            if after is None and (after := self.move(state, token)) is None:
                return None
            if not after:
                ends.append((i, j))
            elif not state or (after > 0) != (state > 0):
                led = token
            state = after
        return (ends, links) if j == m else None


class Aligner:
    """Two vocabularies, the transducer between them, and the segments met so far."""

    def __init__(self, bpe_path: str, piece_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bpe_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        with open(bpe_path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: n for n, c in byte_letters().items()}
        said = {n: bytes(back[c] for c in token) for token, n in spec["model"]["vocab"].items()}
        said |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        pieces = [self.b.id_to_piece(n) for n in range(self.b.vocab_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces that hold a space after something else can't be encoded by segments")
        spell = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self.transducer = Transducer([said.get(n, b"") for n in range(max(said) + 1)], spell)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.chars, self.names = 0, []
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups and links; -1 where the bytes differ
        self.links, self.at = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, segments: list[str]) -> None:
        """Encodes and aligns new segments; each begins with the space that the piece side adds by itself."""
        ours = self.a.encode_batch_fast(segments, add_special_tokens=False)
        theirs = self.b.encode([s[1:] for s in segments], num_threads=1)
        sizes, flat, align = [], [], self.transducer.align
        for s, a, b in zip(segments, ours, theirs, strict=True):
            a, b = a.ids, b or [self.space]
            found = align(a, b)
            self.numbers[s] = len(self.numbers)
            self.chars += len(s)
            if not found:
                sizes.append((-1, -1, -1, 0))
                self.names.append("")
                continue
            ends, links = found
            sizes.append((len(a), len(b), len(ends), len(links)))
            flat += [x << 32 | y for x, y in links]
            said, i, j = [], 0, 0
            for m, n in ends:
                x = str(a[i]) if m - i == 1 else ",".join(map(str, a[i:m]))
                said.append(f"{x}|{b[j]}" if n - j == 1 else f"{x}|{','.join(map(str, b[j:n]))}")
                i, j = m, n
            self.names.append(";".join(said))
        sizes = np.array(sizes, np.int64)
        self.at = np.append(self.at, len(self.links) + np.cumsum(sizes[:, 3]) - sizes[:, 3])
        self.sizes, self.links = np.concatenate([self.sizes, sizes]), np.append(self.links, np.array(flat, np.int64))

    def block(self, texts: list[str]) -> tuple[list[tuple], dict[str, np.ndarray]]:
        """A row for each text (n_a, n_b, n_groups, n_links, groups_sha256; steps between the numbers of its pairs, and how often it holds each), and the block's pairs."""
        if self.chars > KEPT_CHARS:
            self.forget()
        cut = [CUT.split(f" {t}") if t else [] for t in texts]
        new = [s for s in dict.fromkeys(s for row in cut for s in row) if s not in self.numbers]
        if new:
            self.learn(new)
        numbers = [np.fromiter(map(self.numbers.__getitem__, row), np.int64, len(row)) for row in cut]
        numbers = [x if (self.sizes[x, 0] >= 0).all() else x[:0] for x in numbers]
        used = np.unique(np.concatenate([*numbers, np.zeros(0, np.int64)]))
        pairs = np.unique(_take(self.links, self.at[used], self.sizes[used, 3]))
        docs, rows = np.zeros(len(pairs), np.int64), []
        for x in numbers:
            own, times = np.unique(_take(self.links, self.at[x], self.sizes[x, 3]), return_counts=True)
            own = np.searchsorted(pairs, own)
            docs[own] += 1
            said = hashlib.sha256(";".join(map(self.names.__getitem__, x.tolist())).encode()).hexdigest() if len(x) else ""
            rows.append((*self.sizes[x].sum(axis=0).tolist(), said, packed(np.diff(own, prepend=0)), packed(times)))
        return rows, {"a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "docs": docs}


def packed(x: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs; the first byte says how many."""
    width = 1 if x.max(initial=0) < 1 << 8 else 2 if x.max() < 1 << 16 else 4
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64)


@functools.lru_cache(maxsize=1)
def aligner(bpe_path: str, piece_path: str) -> Aligner:
    return Aligner(bpe_path, piece_path)


def blocks(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of documents and, with a, b and docs, one row for each block."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"block long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, a array<int>, b array<int>, docs array<long>"
    names = [x.split()[0] for x in schema.split(", ")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found, number = aligner(bpe_path, piece_path), TaskContext.get().partitionId() << 32

        def made(parts: list[pa.RecordBatch], texts: list[str]) -> Iterator[pa.RecordBatch]:
            said, whole = found.block(texts)
            n, ids = len(said), pa.chunked_array([p.column(0) for p in parts]).combine_chunks()
            cols = [pa.array([number] * n, pa.int64()), ids]
            cols += [pa.array([r[k] for r in said], pa.int64()) for k in range(4)]
            cols += [pa.array([r[4] for r in said], pa.string()), pa.array([r[5] for r in said], pa.binary()), pa.array([r[6] for r in said], pa.binary())]
            cols += [pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=names)
            cols = [pa.array([number], pa.int64()), pa.nulls(1, ids.type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), *[pa.nulls(1, pa.binary())] * 2]
            cols += [pa.array([whole[k].tolist()], pa.list_(pa.int64() if k == "docs" else pa.int32())) for k in ("a", "b", "docs")]
            yield pa.RecordBatch.from_arrays(cols, names=names)

        parts, texts, chars = [], [], 0
        for part, more in _chunks(batches):
            parts.append(part)
            texts += more
            chars += sum(map(len, more))
            if chars >= BLOCK_CHARS:
                yield from made(parts, texts)
                number += 1
                parts, texts, chars = [], [], 0
        if parts:
            yield from made(parts, texts)

    return settle(rows.mapInArrow(of, schema), "alignment-blocks")


def pair_counts(found: DataFrame) -> DataFrame:
    """a, b, n_docs (documents of the corpus that hold the pair linked), best (no pair of a has more), over all blocks."""
    pairs = found.filter("a IS NOT NULL").select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    counted = pairs.agg(F.sum("p.docs").alias("n_docs"))
    return counted.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def align_documents(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs."""
    found = blocks(docs, bpe_path, piece_path, id_col, text_col)
    own = found.filter("a IS NOT NULL").select("block", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("block", "at", "p.a", "p.b")
    known = own.join(settle(pair_counts(found), "alignment-pairs"), ["a", "b"]).select(F.col("block").alias("of_block"), "at", "n_docs", "best")
    kind = found.schema["id"].dataType.simpleString()
    kept = ["id", "n_a", "n_b", "n_groups", "n_links"]

    def of(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        known = np.zeros((2, pairs.num_rows), np.int64)
        known[:, pairs.column("at").to_numpy()] = pairs.column("best").to_numpy(zero_copy_only=False), pairs.column("n_docs").to_numpy()
        sums = np.zeros((2, rows.num_rows), np.int64)
        for k, (own, times) in enumerate(zip(rows.column("pairs").to_pylist(), rows.column("times").to_pylist(), strict=True)):
            sums[:, k] = known[:, np.cumsum(unpacked(own))] @ unpacked(times)
        return pa.table([*[rows.column(k) for k in kept], *map(pa.array, sums), rows.column("groups_sha256")], names=[*kept, "n_best", "count_sum", "groups_sha256"])

    rows = found.filter("a IS NULL").select("block", *kept, "groups_sha256", "pairs", "times")
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(of, schema)
