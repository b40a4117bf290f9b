"""Quality by histogram gradient-boosted trees over statistics of documents.

Statistics are computed where the documents are. The trees are grown on the driver from the statistics of
at most ``max_rows`` labelled rows (20,000 by default): features are cut into 64 bins by quantiles, and
every level of a tree chooses its splits from sums of gradients by bin. The finished trees lie flat in
arrays (feature, threshold, left child, value), which numpy walks for all documents and trees at once.

Defined results for odd input: null, empty and blank texts have the statistics of the empty text, which
the trees score like any other; texts are read whole; repeated rows get equal scores; without labels of
both classes every score is the share of label 1 (0.5 without labels); an empty table gives an empty
table; only the id and the text column are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import best_cut, probability

SYMBOL = re.compile(r"[#*$%&|<>]")
STOP = re.compile(r"[.!?…][\"')\]]*$")
FEATURES = (
    "words", "mean_word", "long_words", "distinct_words", "top_word", "stuttered_words", "repeated_8grams", "upper", "digits", "symbols",
    "bars", "shouts", "letters", "spaces", "lines", "mean_line", "duplicate_lines", "ended_lines", "sentences", "entropy", "marked_words",
)


def statistics(text: str | None) -> list[float]:
    """The features of a text, as listed in FEATURES."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(len(text), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    grams = Counter(zip(*[words[k:] for k in range(8)], strict=False)) if n >= 8 else {}
    letters = Counter(text)
    alpha = sum(c for x, c in letters.items() if x.isalpha())
    upper = sum(c for x, c in letters.items() if x.isupper())
    symbols = sum(letters[x] for x in "#*$%&|<>")
    return [
        math.log1p(n),
        sum(map(len, words)) / max(n, 1),
        sum(len(w) > 12 for w in words) / max(n, 1),
        len(counts) / max(n, 1),
        max(counts.values(), default=0) / max(n, 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(n, 1),
        sum(c for c in grams.values() if c > 1) / max(n - 7, 1) if grams else 0.0,
        upper / max(alpha, 1),
        sum(letters[x] for x in "0123456789") / chars,
        symbols / chars,
        letters["|"] / max(n, 1),
        text.count("!!") / max(n, 1),
        alpha / chars,
        (chars - sum(map(len, words))) / chars,
        math.log1p(len(lines)),
        n / max(len(lines), 1),
        (len(lines) - len(set(lines))) / max(len(lines), 1),
        sum(bool(STOP.search(x)) for x in lines) / max(len(lines), 1),
        (letters["."] + letters["!"] + letters["?"]) / max(n, 1),
        -sum(c / chars * math.log2(c / chars) for c in letters.values()),
        sum(1 for w in words if SYMBOL.search(w)) / max(n, 1),
    ]


class Trees:
    """Boosted trees in flat arrays: node k goes left if the feature is at most the threshold; a leaf is its own child."""

    def __init__(self, feature, threshold, left, value, roots, depth: int, base: float, cut: float = 0.0):
        self.feature, self.threshold, self.left, self.value, self.roots, self.depth, self.base, self.cut = feature, threshold, left, value, roots, depth, base, cut

    def odds(self, x: np.ndarray) -> np.ndarray:
        """The log odds of the rows of x."""
        rows = np.arange(len(x))[:, None]
        at = np.tile(self.roots, (len(x), 1))
        for _ in range(self.depth):
            at = self.left[at] + (x[rows, self.feature[at]] > self.threshold[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return probability(self.odds(x), self.cut)


def grow(x: np.ndarray, y: np.ndarray, rounds: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, least: float = 5.0, l2: float = 1.0) -> Trees:
    """Boost trees of the given depth under the logistic loss."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = math.log(share / (1 - share))
    z = np.full(len(y), base)
    feature, threshold, left, value, roots = [], [], [], [], []
    infinite = np.inf
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        grad, hess = y - p, p * (1 - p)
        start = len(feature)
        roots.append(start)
        feature.append(0), threshold.append(infinite), left.append(start), value.append(0.0)
        node = np.full(len(y), start)
        leaves = [start]
        for _ in range(depth):
            place = {k: i for i, k in enumerate(leaves)}
            slot = np.array([place.get(k, -1) for k in range(start, len(feature))])[node - start]
            live = slot >= 0
            best = [(1e-6, 0, 0)] * len(leaves)
            for f, c in enumerate(cuts):
                width = len(c) + 1
                if width < 2:
                    continue
                cell = slot[live] * width + code[live, f]
                g = np.bincount(cell, grad[live], len(leaves) * width).reshape(-1, width)
                h = np.bincount(cell, hess[live], len(leaves) * width).reshape(-1, width)
                n = np.bincount(cell, minlength=len(leaves) * width).reshape(-1, width)
                gl, hl, nl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1], n.cumsum(1)[:, :-1]
                gt, ht, nt = g.sum(1, keepdims=True), h.sum(1, keepdims=True), n.sum(1, keepdims=True)
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain = np.where((nl >= least) & (nt - nl >= least), gain, -1)
                k = gain.argmax(1)
                for i, b in enumerate(k):
                    if gain[i, b] > best[i][0]:
                        best[i] = (float(gain[i, b]), f, int(b))
            grown = []
            for leaf, (gain, f, b) in zip(leaves, best, strict=True):
                if gain <= 1e-6:
                    continue
                child = len(feature)
                for _ in range(2):
                    feature.append(0), threshold.append(infinite), left.append(len(feature) - 1), value.append(0.0)
                feature[leaf], threshold[leaf], left[leaf] = f, float(cuts[f][b]), child
                mine = node == leaf
                node[mine] = child + (code[mine, f] > b)
                grown += [child, child + 1]
            leaves = grown
            if not leaves:
                break
        g = np.bincount(node - start, grad, len(feature) - start)
        h = np.bincount(node - start, hess, len(feature) - start)
        step = rate * g / (h + l2)
        for k, v in enumerate(step):
            value[start + k] = float(v) if left[start + k] == start + k else 0.0
        z += np.asarray(value)[node]
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots, dtype=np.int64), depth, base)


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees of all rows; a fifth of the rows, left out of other trees, gives the cut that scores 0.7."""
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        none = np.zeros(0, dtype=np.int64)
        return Trees(none, none.astype(float), none, none.astype(float), none, 0, math.log(share / (1 - share)), math.log(0.7 / 0.3))
    fifth = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[fifth])) == 2 and len(np.unique(y[~fifth])) == 2:
        cut = best_cut(grow(x[~fifth], y[~fifth]).odds(x[fifth]), y[fifth])
    else:
        cut = 0.0
    trees = grow(x, y)
    trees.cut = cut
    return trees


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns keep, and features (an array of double) of every row."""
    return _map(docs, id_col, text_col, keep, "features array<double>", lambda x: pa.array(list(x), pa.list_(pa.float64())))


def score_documents(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    return _map(docs, id_col, text_col, (), "score double", lambda x: pa.array(trees.score(x), pa.float64()))


def _map(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...], out: str, give) -> DataFrame:
    name = out.split()[0]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 512):
                batch = whole.slice(k, 512)
                x = np.array([statistics(t) for t in batch.column(1).to_pylist()]).reshape(len(batch), len(FEATURES))
                yield pa.RecordBatch.from_arrays([batch.column(0), *[batch.column(2 + j) for j in range(len(keep))], give(x)], names=["id", *keep, name])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *keep)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(of, ", ".join([*kinds, out]))
