"""A bounded sample of labelled documents, for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, label and text of the documents of at most max_rows labelled ids, those of least hash of the id.

    usable is a condition on the column id. Rows without id or label are left out; of several labels of
    an id the largest holds. The chosen ids, max_rows at most, are broadcast; texts are not shuffled. As
    ids may repeat among the documents, whoever gathers the sample limits it to max_rows once more.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable)
    chosen = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")


def fold(column: str, n: int) -> Column:
    """The remainder of the CRC-32 of a column as text; null ids have the remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the last one is the intercept."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    ridge = np.full(a.shape[1], l2)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The cut of z with the best F1, halfway to the next lower value."""
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + max(y.sum(), 1))
    f1[:-1][z[order][:-1] == z[order][1:]] = -1  # a cut can't part equal values
    k = int(np.argmax(f1))
    return float(z[order[k]] if k + 1 == len(z) else (z[order[k]] + z[order[k + 1]]) / 2)


def probability(z: np.ndarray, cut: float, at: float = 0.7) -> np.ndarray:
    """Log odds as a score in [0, 1], moved so that the cut has the score at."""
    return 1 / (1 + np.exp(-np.clip(z - cut + np.log(at / (1 - at)), -30, 30)))
