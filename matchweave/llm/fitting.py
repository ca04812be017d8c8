"""Bounded samples of labelled rows and small fits on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.session import stage


def id_remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> DataFrame:
    """(doc_id, text, y, weight) of at most ``per_class`` labelled ids of each class where ``learn`` holds, least hash of id first.

    The weight is the number of labelled ids of the class over that of its sampled ones, so that the classes keep their shares.

    Written once. The ids are few by the bound, so they are broadcast and no text is shuffled. Of repeated
    ids one row stays.
    """
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    weight = {y: max(1.0, sizes.get(y, 0) / per_class) for y in (0, 1)}
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).withColumn("weight", F.lit(weight[y])) for y in (0, 1)]
    ids = stage(some[0].union(some[1]), "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return stage(rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("weight").alias("weight"), F.min(F.coalesce("text", F.lit(""))).alias("text")), "sample")


def logistic(features: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last one is the constant) of a logistic regression, by Newton's method. The constant alone for no rows.

    ``weight`` says how many rows each one stands for.
    """
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    if len(y) == 0:
        return w
    weight = np.ones(len(y)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(logit: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
