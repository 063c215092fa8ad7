"""Labelled rows for learning, and small models fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder


def known_labels(labels: DataFrame, label: str, modulus: int, held_out: int) -> DataFrame:
    """(doc_id, label) for all labelled ids that may be learnt from.

    Ids with crc32 remainder ``held_out`` are left out, as are null ids, null labels and ids
    with both labels.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    known = known.filter(id_remainder("doc_id", modulus) != held_out)
    agreed = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("__max"))
    return agreed.filter(F.col("label") == F.col("__max")).select("doc_id", "label")


def label_sample(labels: DataFrame, label: str, modulus: int, held_out: int, limit: int) -> DataFrame:
    """At most ``limit`` of :func:`known_labels`.

    Of more ids than ``limit`` those with the least hash are taken, so that the sample is the same on every run.
    """
    agreed = known_labels(labels, label, modulus, held_out)
    return agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, text and label of the sample's documents; the sample is bounded, so it is broadcast."""
    rows = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    return rows.join(F.broadcast(sample), "doc_id")


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression without intercept, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w

