"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.session import ensure_checkpoint_dir


def usable_labels(labels: DataFrame, label: str, keep: Column, key: str = "doc_id") -> DataFrame:
    """(key, _label): one label of each id to be learned from, the largest; null ones are not used."""
    return (labels.where(keep & F.col(label).isNotNull() & F.col(key).isNotNull())
            .groupBy(key).agg(F.max(label).cast("int").alias("_label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, ones: int,
                    zeros: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, label) of at most ``ones`` + ``zeros`` labelled documents.

    ``keep`` says which ids may be learned from.  The documents of each
    class are the first in order of a hash of their id, then of their text,
    so the sample does not depend on partitioning and the bound is one of
    documents also where ids repeat.  Several labels of one id count as the
    largest; null ids and labels are not used.  The ids of the sample are
    few by construction and are broadcast; the texts stay distributed, in a
    checkpoint that later steps read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    usable = usable_labels(labels, label, keep, key)
    order = F.xxhash64(key)
    chosen = (usable.where("_label = 1").orderBy(order, key).limit(ones)
              .unionByName(usable.where("_label = 0").orderBy(order, key).limit(zeros)))
    found = (docs.select(key, text).join(F.broadcast(chosen), key)
             .select(F.col(key).cast("long").alias("doc_id"),
                     F.col(text).cast("string").alias("text"), "_label"))
    first = (F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")
    return (found.where("_label = 1").orderBy(*first).limit(ones)
            .unionByName(found.where("_label = 0").orderBy(*first).limit(zeros)).checkpoint())


def label_rate(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
               key: str = "doc_id") -> float | None:
    """Share of ones among the usable labels of all of these documents; None without any."""
    usable = labels.where(keep & F.col(label).isNotNull() & F.col(key).isNotNull())
    return (usable.join(docs.select(key).distinct(), key, "left_semi")
            .agg(F.avg(F.col(label).cast("double"))).first()[0])


def values_at(column: DataFrame, ranks: list[int], bins: int = 4096) -> list[float]:
    """The values of these ranks (from 0) of a column without nulls, exactly.

    Each pass counts the values between two bounds in ``bins`` steps and goes
    on with the step that holds the rank, until that holds one value only.
    Nothing is sorted, and the driver sees no more than ``bins`` rows a pass.
    """
    values = column.toDF("v")
    first = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    found = []
    for rank in ranks:
        (low, high), before = first, 0
        while low < high:
            bucket = F.floor((F.col("v") - low) / (high - low) * bins)
            counted = (values.where(F.col("v").between(low, high)).groupBy(bucket.alias("bucket"))
                       .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
                       .collect())
            for row in sorted(counted, key=lambda r: r["bucket"]):
                if before + row["n"] > rank:
                    low, high = row["low"], row["high"]
                    break
                before += row["n"]
        found.append(low)
    return found


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: np.ndarray,
             strength: float, steps: int = 40) -> np.ndarray:
    """Weights of a logistic model by Newton steps, drawn to ``prior`` by a squared penalty."""
    w = prior.astype(float).copy()
    if not len(x):
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + strength * (w - prior)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + strength * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
