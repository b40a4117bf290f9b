"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic text and one on ordinary text. A window is a word in
a frame that both dictionaries know. Its distance is its compressed length with the ordinary dictionary
less that with the toxic one. A document is scored by how many of its windows pass thresholds, by a
logistic calibration on labelled documents that the dictionaries have not seen.

Both dictionaries are trained by zstandard on windows alone: the ordinary one on those of ordinary documents,
the toxic one on those windows of toxic documents that begin like few windows of ordinary ones (a likelihood
ratio over families of near copies, each counted once); the rest of toxic documents is ordinary text and would
only blur the distance.

The model is fitted on at most ``max_rows`` labelled rows (8,000 by default), which the driver reads, those of
``MAX_CHARS`` characters at most, so that the driver's share is bounded in bytes too; scoring reads whole texts.
The ordinary dictionary is trained on at most ``MAX_WINDOWS`` of their windows, drawn evenly.

Defined results for odd input: null, empty and blank texts have no windows and get the score of a text
without a toxic window; texts are scored whole, whatever their length; repeated rows get equal scores;
without labels of both classes every score is the share of label 1 (0 without labels); an empty table
gives an empty table; only the id and the text column are read.
"""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import best_cut, logistic, probability

FRAME = b"~0~1~2~3~4~5~6~7~8~9"
LEVEL = 9
K = 50  # length of the segments that the training picks
THRESHOLDS = (2, 3, 4, 5, 6)
KEPT_WORDS = 300_000
MAX_CHARS, MAX_WINDOWS = 20_000, 300_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def segments(words: list[bytes], low: int = 5, high: int = 14) -> set[bytes]:
    """The beginnings of the words, with the space before them, and the short words whole."""
    out = set()
    for w in set(words):
        framed = b" " + w + b" "
        out.update(framed[:n] for n in range(low, min(len(framed), high) + 1))
    return out


def families(texts: list[str], bands: int = 8, rows: int = 3) -> list[int]:
    """A number for each text, the same for near copies: texts meet if a band of least hashes of their long words agrees."""
    top = list(range(len(texts)))

    def root(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    rnd = np.random.default_rng(1)
    factors = rnd.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
    met: dict[tuple, int] = {}
    for k, ws in enumerate(map(words_of, texts)):
        long = {w for w in ws if len(w) > 6}
        hashes = np.fromiter(map(zlib.crc32, long or {b" ".join(ws)}), np.uint64)
        mixed = hashes[:, None] * factors
        least = (mixed ^ (mixed >> np.uint64(29))).min(axis=0).reshape(bands, rows)
        for b in range(bands):
            first = met.setdefault((b, *least[b].tolist()), k)
            top[root(k)] = root(first)
    return [root(k) for k in range(len(texts))]


def telling_segments(texts: list[str], labels: np.ndarray, least: int = 5, ratio: float = 6.0, gain: float = 30.0) -> Counter:
    """The telling segments, each with the number of its families of toxic documents."""
    members: dict[tuple[int, int], list[int]] = {}
    for k, (f, y) in enumerate(zip(families(texts), labels, strict=True)):
        members.setdefault((int(y), f), []).append(k)
    n = [sum(y == label for y, _ in members) for label in (0, 1)]

    def count(label: int, known: Counter | None) -> Counter:
        out: Counter = Counter()
        for (y, _), ks in members.items():
            if y == label:
                found = set().union(*(segments(words_of(texts[k])) for k in ks))
                out.update(found if known is None else found & known.keys())
        return out

    toxic = Counter({s: c for s, c in count(1, None).items() if c >= least})
    ordinary = count(0, toxic)
    telling = Counter()
    share = n[1] / max(n[0] + n[1], 1)
    for s, c in toxic.items():
        o = ordinary[s]
        g = 2 * c * math.log(c / ((c + o) * share)) + (2 * o * math.log(o / ((c + o) * (1 - share))) if o else 0)
        if g >= gain and c / n[1] >= ratio * (o + 0.5) / max(n[0], 1):
            telling[s] = c
    return telling


def train_dictionary(windows: list[bytes], size: int) -> bytes:
    """A zstandard dictionary trained on the windows, then the frame.

    Where there is too little to train on, it is plain content.
    """
    import zstandard

    try:
        body = zstandard.train_dictionary(size, windows, k=K, d=6, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        body = b"".join(dict.fromkeys(windows))[:size]
    return body + FRAME


class Distance:
    """The distance of words by two dictionaries; remembers a bounded number of words."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as z

        def compressor(body: bytes):
            kind = z.DICT_TYPE_AUTO
            params = z.ZstdCompressionParameters.from_level(LEVEL, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
            d = z.ZstdCompressionDict(body, dict_type=kind)
            d.precompute_compress(compression_params=params)
            return z.ZstdCompressor(dict_data=d, compression_params=params).compress

        self.a, self.b = compressor(ordinary), compressor(toxic)
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        for w in set(words):
            if w not in known:
                framed = b" " + w + b" " + FRAME
                known[w] = len(self.a(framed)) - len(self.b(framed))
        out = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        if len(known) > KEPT_WORDS:
            known.clear()
        return out

    def features(self, text: str | None) -> list[float]:
        words = words_of(text)
        d = self.of(words)
        over = [int((d >= t).sum()) for t in THRESHOLDS]
        return [*[math.log1p(c) for c in over], *[c / (30 + len(words)) for c in over], float(min(max(d.max(initial=0), 0), 10)), math.log1p(len(words))]


class Model:
    """Dictionaries, and the calibration of their distances. Small: some 70 kB."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = toxic, ordinary
        self.mean = self.scale = self.weights = np.zeros(0)
        self.cut, self.constant = 0.0, None

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        x = x[:, :-1]  # the length itself tells nothing that the shares don't
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.weights = logistic((x - self.mean) / self.scale, y)
        self.cut = best_cut(self._odds(x), y)

    def _odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return probability(self._odds(x[:, :-1]), self.cut)


def _dictionaries(texts: list[str], labels: np.ndarray, seed: int) -> tuple[bytes, bytes]:
    telling = telling_segments(texts, labels)
    if not telling:
        telling = telling_segments(texts, labels, least=1, ratio=3.0, gain=0.0)  # few labels
    rnd = random.Random(seed)
    seen: dict[int, set[bytes]] = {}
    for k, f in enumerate(families(texts)):
        if labels[k]:
            seen.setdefault(f, set()).update(words_of(texts[k]))
    toxic = [b" " + w + b" " for _, words in sorted(seen.items()) for w in sorted(words) if not telling.keys().isdisjoint(segments([w]))]
    usual = [b" " + w + b" " for k in range(len(texts)) if not labels[k] for w in sorted(set(words_of(texts[k])))]
    rnd.shuffle(toxic)
    rnd.shuffle(usual)
    return train_dictionary(toxic, 4096), train_dictionary(usual[:MAX_WINDOWS], 65536)


def fit(sample: DataFrame, seed: int = 7) -> Model:
    """The model of a sample (id, label, text), a third of which calibrates what the rest has trained."""
    rows = sample.filter(F.char_length("text") <= MAX_CHARS).select("id", "label", "text").toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
    texts, labels, ids = rows["text"].to_pylist(), np.array(rows["label"].to_pylist(), float), rows["id"].to_pylist()
    if len(set(labels.tolist())) < 2:
        model = Model(b"", b"")
        model.constant = float(labels.mean()) if len(labels) else 0.0
        return model
    third = np.array([zlib.crc32(b"c%d" % i if isinstance(i, int) else str(i).encode()) % 3 == 0 for i in ids])
    if min(labels[third].sum(), (1 - labels[third]).sum(), labels[~third].sum()) < 10:
        third = np.ones(len(labels), bool)
        train = list(range(len(labels)))
    else:
        train = np.flatnonzero(~third).tolist()
    model = Model(*_dictionaries([texts[k] for k in train], labels[train], seed))
    distance = Distance(model.toxic, model.ordinary)  # the same that will score, so that the thresholds hold
    model.calibrate(np.array([distance.features(texts[k]) for k in np.flatnonzero(third)]), labels[third])
    return model


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, windows (words) and toxic_windows (those at a distance of 4 or more) of every row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model.toxic, model.ordinary) if model.constant is None else None
        for whole in batches:
            for k in range(0, len(whole), 512):
                batch = whole.slice(k, 512)
                texts = batch.column(1).to_pylist()
                if distance is None:
                    score, n, hits = np.full(len(texts), model.constant), [len(words_of(t)) for t in texts], [0] * len(texts)
                else:
                    x = np.array([distance.features(t) for t in texts])
                    score, n, hits = model.score(x), np.rint(np.expm1(x[:, -1])).astype(int).tolist(), np.rint(np.expm1(x[:, THRESHOLDS.index(4)])).astype(int).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(hits, pa.int64())], names=["id", "score", "windows", "toxic_windows"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(of, f"id {rows.schema['id'].dataType.simpleString()}, score double, windows long, toxic_windows long")
