"""Bounded labelled samples and small logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import crc32_text

#: Documents whose crc32(doc_id as text) has this remainder are never learned from.
FOLDS, HELD_OUT = 3, 1


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(crc32_text(column), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def labelled_sample(labels: DataFrame, name: str, rows: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, y`` of about ``rows`` labelled documents of each class at most, and the size of each class.

    The share that is kept follows from the size of the class, and rows are chosen by a hash of the id.
    Null labels and ids, labels other than 0 and 1 and the held-out fold are left out; of several labels
    of one document the largest counts.
    """
    usable = (
        labels.where(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(name).cast("int").alias("y"))
    )
    sizes = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("y") == 1, rows / max(1, rows, sizes.get(1, 0))).otherwise(rows / max(1, rows, sizes.get(0, 0)))
    return usable.where(place < share), sizes


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 10 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def linear(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]
