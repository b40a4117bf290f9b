"""Byte-level BPE encoding and decoding in batched numpy rounds.

The words of many documents lie in one flat array of symbols. Each round looks all adjacent pairs up by
binary search over the sorted pair keys, finds the lowest rank of every word, merges its pairs of that
rank from left to right, and puts words without a known pair aside. Rounds go on until none is left.

The vocabulary comes from a tokenizers JSON file; its path is a parameter. Added tokens of the file are
found in the text first, as that library does. Nothing is trained.

Defined results for odd input: a null text counts as the empty text, which has no ids and decodes to the
empty text; texts of any length are encoded whole; ties between equal pairs fall to the left one;
repeated rows give repeated rows; an empty table gives an empty table; ``encode_documents`` reads the id and
the text column alone, ``add_codes`` carries all columns and replaces those that have a new one's name.

The memory of words already merged is bounded by ``KEPT_WORDS`` and only saves time: what it forgets is merged anew.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEVER = np.int64(1 << 40)
CHUNK_CHARS = 1 << 19
KEPT_WORDS = 100_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Words(dict):
    """Numbers words as they are met; fresh holds those met since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at


class BytePairCoder:
    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.size = max([*vocab.values(), *added.values()]) + 1
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = np.append(keys[order], np.int64(-1) + (1 << 62)), np.append(order, NEVER), np.append(made[order], -1)
        said = [b""] * self.size
        for token, i in vocab.items():
            said[i] = bytes(back[c] for c in token)
        for token, i in added.items():
            said[i] = token.encode()
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_len = np.array([len(x) for x in said], np.int64)
        self.said_at = np.cumsum(self.said_len) - self.said_len
        self.added = added
        self.added_re = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.split = regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.words = Words()
        self.flat, self.at, self.n = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after another, and how many each has."""
        count = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int64), count)
        done_symbol, done_word = [], []
        while len(symbol):
            new = np.empty(len(word), bool)
            new[0], new[1:] = True, word[1:] != word[:-1]
            starts = np.flatnonzero(new)
            pair = symbol[:-1] * self.size + symbol[1:]
            at = np.searchsorted(self.keys, pair)
            rank = np.full(len(symbol), NEVER)
            rank[:-1] = np.where((self.keys[at] == pair) & ~new[1:], self.ranks[at], NEVER)
            lowest = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(lowest, np.diff(np.append(starts, len(symbol))))
            open_ = lowest < NEVER
            if not open_.all():
                done_symbol.append(symbol[~open_])
                done_word.append(word[~open_])
            hit = (rank == lowest) & open_
            where = np.flatnonzero(hit)
            if len(where):  # of hits that overlap (a a a), every other one counts
                run = np.empty(len(where), bool)
                run[0], run[1:] = True, where[1:] != where[:-1] + 1
                begin = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - begin) % 2 == 0]
                symbol[where] = self.made[at[where]]
                open_[where + 1] = False
            symbol, word = symbol[open_], word[open_]
        if not done_symbol:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbol[order].astype(np.int32), np.bincount(word, minlength=len(words)).astype(np.int64)

    def _number(self, text: str) -> list[int]:
        """The numbers of the words of a text; added tokens have the numbers -1 - id."""
        number = self.words.__getitem__
        if self.added_re is None or not any(t in text for t in self.added):
            return list(map(number, self.split(text)))
        out: list[int] = []
        for k, part in enumerate(self.added_re.split(text)):
            out.extend([-1 - self.added[part]] if k % 2 else map(number, self.split(part)))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        numbers = [np.array(self._number(t), np.int64) for t in texts]
        if self.words.fresh:
            flat, n = self.merge_words([w.encode() for w in self.words.fresh])
            self.words.fresh = []
            self.at = np.append(self.at, len(self.flat) + np.cumsum(n) - n)
            self.n = np.append(self.n, n)
            self.flat = np.append(self.flat, flat)
        out = [self._gather(x) for x in numbers]
        if len(self.words) > KEPT_WORDS:
            self._forget()
        return out

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        if not len(numbers):
            return np.zeros(0, np.int32)
        special = numbers < 0
        if special.any():
            parts, k = [], 0
            for s in np.flatnonzero(special):
                parts += [self._gather(numbers[k:s]), np.array([-1 - numbers[s]], np.int32)]
                k = s + 1
            return np.concatenate([*parts, self._gather(numbers[k:])])
        return _take(self.flat, self.at[numbers], self.n[numbers])

    def decode(self, ids: np.ndarray) -> bytes:
        return _take(self.said, self.said_at[ids], self.said_len[ids]).tobytes()


def _take(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The slices flat[at : at + n], one after another."""
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - n), n)]


@functools.lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> BytePairCoder:
    return BytePairCoder(path, pattern)


def _chunks(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The rows and their texts, about CHUNK_CHARS at a time, never less than one text."""
    import pyarrow.compute as pc

    for batch in batches:
        texts = batch.column(text)
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < len(texts):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + CHUNK_CHARS, "right")))
            part = batch.slice(begin, end - begin)
            yield part, [x or "" for x in part.column(text).to_pylist()]
            begin = end


def _coded(c: BytePairCoder, texts: list[str], ids: bool, decode: bool) -> list[pa.Array]:
    found = c.encode(texts)
    cols = [pa.array([len(x) for x in found], pa.int64())]
    if ids:
        cols.append(pa.array([x.astype("<u4").tobytes() for x in found], pa.binary()))
    if decode:
        cols.append(pa.array([c.decode(x).decode("utf-8", "replace") for x in found], pa.string()))
    return cols


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, ids: bool = True) -> DataFrame:
    """id, n_tokens and, as asked for, ids (unsigned 32-bit little-endian integers in a row) and decoded (the text that they decode to)."""
    kinds = ["n_tokens long"] + ["ids binary"] * ids + ["decoded string"] * decode

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for rows, texts in _chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), *_coded(c, texts, ids, decode)], names=["id", *[k.split()[0] for k in kinds]])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(of, f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(kinds)}")


CODES = {"n_tokens": "long", "ids": "binary", "decoded": "string"}


def add_codes(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with n_tokens, ids and decoded (see encode_documents) in place of columns of these names; each text goes to the task once.

    Columns stay flat: a nested copy of the row would hold every text a second time.
    """
    kept = [c for c in docs.columns if c not in CODES]
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(*[(text.alias(c) if c == text_col else F.col(f"`{c}`")) for c in kept], *([] if text_col in kept else [text.alias(text_col)]))
    at = rows.columns.index(text_col)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for part, texts in _chunks(batches, at):
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *_coded(c, texts, True, True)], names=[*kept, *CODES])

    schema = T.StructType([f for f in rows.schema if f.name in kept])
    for name, kind in CODES.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(of, schema)


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """id and text for rows of packed ids (see encode_documents); null ids give the empty text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in batches:
            texts = [c.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    rows = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return rows.mapInArrow(of, f"id {rows.schema['id'].dataType.simpleString()}, text string")
