"""Bounded samples of labelled documents and small numpy models that are fitted on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold


def sample_labels(labels: DataFrame, label: str, per_class: int, folds: int = 5, id_col: str = "doc_id") -> DataFrame:
    """(id, y) of at most ``per_class`` ids of each class, none of fold 0, in the order of a hash of the id.

    Labels other than 0 and 1 are left out; an id that is labelled twice counts once, by its larger label.
    """
    rows = (
        labels.where(F.col(label).isin(0, 1) & (fold(id_col, folds) != 0))
        .groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
    )
    order = F.xxhash64(F.lit("fit"), F.col(id_col))
    parts = [rows.where(F.col("y") == y).orderBy(order, id_col).limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1]).select(F.col(id_col).alias("__id"), "y")


def class_counts(labels: DataFrame, label: str, folds: int = 5, id_col: str = "doc_id") -> tuple[int, int]:
    """Ids of each class outside fold 0; an id that is labelled twice counts once, by its larger label."""
    rows = labels.where(F.col(label).isin(0, 1) & (fold(id_col, folds) != 0)).groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
    found = dict(rows.groupBy("y").count().collect())
    return found.get(0, 0), found.get(1, 0)


def held_out(id_col: str = "doc_id", folds: int = 5, rest: int = 0):
    """Whether the id is in the fold that no label is learned from; a null id has no fold and is not held out."""
    return F.coalesce(fold(id_col, folds) == rest, F.lit(False))


def with_labels(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, y) of the sampled documents; the sample is bounded, so it is broadcast and no text is shuffled."""
    kept = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return kept.join(F.broadcast(sample), F.col("id") == F.col("__id")).select("id", "text", "y")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, steps: int = 100) -> np.ndarray:
    """Newton steps for a dense weighted logistic regression; the last coefficient is the intercept.

    A step is halved until the loss falls enough: whole steps run away where the classes are nearly separable.
    """
    x = np.c_[x, np.ones(len(x))]
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6

    def loss(w):
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (ridge * w * w).sum())

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(hess, grad)
        step, slope = 1.0, float(grad @ move)
        while step > 1e-10 and loss(w - step * move) > now - 1e-4 * step * slope:
            step /= 2
        if step <= 1e-10:
            break
        w = w - step * move
        before, now = now, loss(w)
        if before - now < 1e-10 * max(1.0, before):
            break
    return w


def sparse_logistic(rows: list[np.ndarray], y: np.ndarray, n: int, weight: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Adagrad for rows of active features; n coefficients and the intercept."""
    data = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    size = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), size)
    w, seen = np.zeros(n + 1), np.full(n + 1, 1e-8)
    for _ in range(300):
        z = np.bincount(row, w[data], len(rows)) + w[n]
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.r_[np.bincount(data, e[row], n), e.sum()]
        g[:n] += l2 * w[:n]
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def sparse_softmax(rows: list[np.ndarray], y: np.ndarray, n: int, classes: int, l2: float = 1.0, steps: int = 300) -> np.ndarray:
    """Adagrad for rows of active features and classes 0 to ``classes`` - 1; n + 1 rows of coefficients, the last the intercepts."""
    data = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, seen = np.zeros((n + 1, classes)), np.full((n + 1, classes), 1e-8)
    want = np.eye(classes)[y]
    for _ in range(steps):
        z = np.stack([np.bincount(row, w[data, k], len(rows)) for k in range(classes)], 1) + w[n]
        e = np.exp(z - z.max(1, keepdims=True))
        e = e / e.sum(1, keepdims=True) - want
        g = np.vstack([np.stack([np.bincount(data, e[row, k], n) for k in range(classes)], 1) + l2 * w[:n], e.sum(0)])
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w
