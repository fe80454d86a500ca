"""Quality by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text, and the chance
that one document is preferred to another is the logistic function of the
difference of their scores.  The weights are learned from preference pairs
(a document labelled good against one labelled bad) by logistic loss on the
feature differences.  The threshold is a quantile of the scores of all labelled
documents that may be learned from: their share of bad labels; scores are
then mapped to 0..1 so that ``THRESHOLD`` lies there.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.labelled import logistic, sigmoid, usable_labels, values_at
from parley.llm.words import small_batches, stage

THRESHOLD = 0.3
SAMPLE_GOOD, SAMPLE_BAD = 4000, 2000
PAIRS = 60_000
PENALTY = 1.0

FEATURES = ("letters", "upper", "digits", "marks", "bars", "marked_words", "exclaimed", "capital_words",
            "distinct", "commonest", "repeats", "run", "word_length", "lines", "line_repeats", "size")
_ENDS = re.compile(r"\S[^\w\s]{2,}(?=\s|$)").findall
# For every character: 1 if it is a letter or a number sign but no digit, and 2 if lower-casing
# changes it, whatever that does to a text's length.
_CLASSES = np.array([(c.isalnum() and not c.isdecimal()) + 2 * (c.lower() != c)
                     for c in map(chr, range(sys.maxunicode + 1))], np.uint8)


def _letters_and_capitals(text: str) -> tuple[int, int]:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    _, letters, capitals, both = np.bincount(_CLASSES[codes], minlength=4).tolist()
    return letters + both, capitals + both


def document_features(text: str | None) -> list[float]:
    """Shares of characters, words and lines with some property, and log sizes.

    A text without words has zeros everywhere.
    """
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text)
    letters, capitals = _letters_and_capitals(text)
    spaces = chars - sum(map(len, words))
    digits = sum(map(text.count, "0123456789"))
    upper = sum(map(str.isupper, words))
    counts = Counter(words)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    longest = run = 1
    if same:
        for a, b in zip(words, words[1:], strict=False):
            run = run + 1 if a == b else 1
            longest = max(longest, run)
    lines = [x for x in text.split("\n") if x.strip()]
    return [letters / chars, capitals / max(1, letters), digits / chars,
            (chars - letters - spaces - digits) / chars, words.count("|") / n, len(_ENDS(text)) / n,
            text.count("!") / n, upper / n, len(counts) / n, max(counts.values()) / n, same / n,
            math.log1p(longest), (chars - spaces) / n / 10, len(lines) / n,
            1 - len(set(lines)) / max(1, len(lines)), math.log1p(n) / 10]


@dataclass
class Ranker:
    """Standardisation, weights, and the score that is mapped to ``THRESHOLD``."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (self.raw(x) - self.cut)
                       + math.log(THRESHOLD / (1 - THRESHOLD)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, bad_share: float, pairs: int = PAIRS,
              seed: int = 7) -> Ranker:
    """Fit on all pairs, or on ``pairs`` random ones where there are more.

    ``bad_share`` is the quantile of the scores at which the threshold lies;
    there each class weighs as much as it does among the labels.
    """
    both = np.concatenate([good, bad])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    rng = np.random.default_rng(seed)
    if len(good) * len(bad) <= pairs:
        i, j = np.divmod(np.arange(len(good) * len(bad)), len(bad))
    else:
        i, j = rng.integers(len(good), size=pairs), rng.integers(len(bad), size=pairs)
    difference = (good[i] - bad[j]) / scale
    zero = np.zeros(difference.shape[1])
    weights = logistic(difference, np.ones(len(i)), np.ones(len(i)), zero, PENALTY)
    ranker = Ranker(mean, scale, weights, 0.0, 1.0)
    scores = np.concatenate([ranker.raw(good), ranker.raw(bad)])
    weight = np.concatenate([np.full(len(good), (1 - bad_share) / len(good)),
                             np.full(len(bad), bad_share / len(bad))])
    order = np.argsort(scores, kind="stable")
    # documents up to the quantile; sums of equal weights may be off in the last digit
    at = int(np.searchsorted(np.cumsum(weight[order]), bad_share + 1e-9, side="right"))
    at = min(max(at, 1), len(order) - 1)
    ranker.cut = float((scores[order[at - 1]] + scores[order[at]]) / 2)
    ranker.slope = 1.0
    return ranker


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_rows: bool = False) -> DataFrame:
    """Every row's features, stored, as the last column: beside its ``doc_id``, or with
    ``keep_rows`` beside all its columns.  Texts are measured here only."""
    given, mark = (docs.columns if keep_rows else [key]), "_x"
    while mark in given:
        mark = "_" + mark

    def run(batches):
        for batch in small_batches(batches, text):
            x = [document_features(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, given), pa.array(x, pa.list_(pa.float64()))], [*given, mark])
    schema = T.StructType([*(docs.schema[c] for c in given),
                           T.StructField(mark, T.ArrayType(T.DoubleType()))])
    read = [*given] if keep_rows else [key, *([text] if text != key else [])]
    found = stage(docs.select(*read).mapInArrow(run, schema))
    return found if keep_rows else found.select(F.col(key).cast("long").alias("doc_id"), mark)


def learn(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality",
          key: str = "doc_id", text: str = "text", ones: int = SAMPLE_GOOD,
          zeros: int = SAMPLE_BAD, pairs: int = PAIRS) -> Ranker:
    """Ranker fitted on at most ``ones`` + ``zeros`` labelled documents and ``pairs`` pairs of
    them, its threshold on all labelled documents.

    Without documents of both classes all weights are zero, and every
    document scores ``THRESHOLD`` and is kept.
    """
    return learn_measured(measured(docs, key, text), labels, keep, label, "doc_id", ones, zeros,
                          pairs, key)


def learn_measured(features: DataFrame, labels: DataFrame, keep: Column, label: str = "quality",
                   key: str = "doc_id", ones: int = SAMPLE_GOOD, zeros: int = SAMPLE_BAD,
                   pairs: int = PAIRS, label_key: str = "doc_id") -> Ranker:
    """:func:`learn` from stored features.

    The sample is the first documents of each class by a hash of their id
    and features, so several rows of one id stay within its bound.  The
    share of bad labels, and with it the threshold, is kept between 0.001
    and 0.99.
    """
    usable = usable_labels(labels, label, keep, label_key).withColumnRenamed(label_key, "_labelled")
    known = (features.where(F.col(key).isNotNull())
             .join(usable, F.col(key).cast("long") == F.col("_labelled").cast("long"))
             .select(F.col(key).alias("doc_id"), "_label", F.col(features.columns[-1]).alias("_x"))
             .checkpoint())
    order = F.xxhash64("doc_id", "_x")
    rows = {c: known.where(F.col("_label") == c).orderBy(order, "doc_id").limit(most).collect()
            for c, most in ((0, zeros), (1, ones))}
    x = {c: np.array([r["_x"] for r in rows[c]]) for c in (0, 1)}
    if not len(x[0]) or not len(x[1]):
        zero = np.zeros(len(FEATURES))
        return Ranker(zero, zero + 1, zero, 0.0, 1.0)
    ranker = fit_pairs(x[1], x[0], len(x[0]) / (len(x[0]) + len(x[1])), pairs)
    ranker.cut = _cut(known, ranker)
    return ranker


def _cut(known: DataFrame, ranker: Ranker) -> float:
    """The score under which as many of all labelled documents lie as are labelled bad.

    Every row counts, also of repeated ids.
    """
    scores = _scored(known, ranker.raw, "_label").checkpoint()
    n, good = scores.agg(F.count("*"), F.sum("_label")).first()
    share = min(0.99, max(0.001, (n - good) / n))
    at = min(max(int(share * n + 1e-6), 1), n - 1)
    below, above = values_at(scores.select("score"), [at - 1, at])
    return (below + above) / 2


def _scored(features: DataFrame, measure: Callable[[np.ndarray], np.ndarray], beside: str) -> DataFrame:
    """(``beside``, score) of stored features."""
    def run(batches):
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(beside), pa.array(measure(x))],
                                             [beside, "score"])
    schema = T.StructType([features.schema[beside], T.StructField("score", T.DoubleType())])
    return features.select(beside, "_x").mapInArrow(run, schema)


def score_measured(features: DataFrame, ranker: Ranker, key: str = "doc_id") -> DataFrame:
    """(doc_id, score) of every row of stored features, from 0 to 1."""
    mark = features.columns[-1]
    return _scored(features.select(F.col(key).alias("doc_id"), F.col(mark).alias("_x")),
                   ranker.score, "doc_id")


def score(docs: DataFrame, ranker: Ranker, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from 0 to 1.

    Null and empty texts are scored with all features zero; repeated rows
    stay repeated; other columns are not read.
    """
    return score_measured(measured(docs, key, text), ranker)


def good_rows(features: DataFrame, ranker: Ranker, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``measured(..., keep_rows=True)`` that score at least the threshold, all columns."""
    *columns, mark = features.columns

    def run(batches):
        for batch in batches:
            x = batch.column(mark).flatten().to_numpy().reshape(-1, len(FEATURES))
            kept = batch.filter(pa.array(ranker.score(x) >= threshold))
            yield kept.select(columns)
    return features.mapInArrow(run, features.select(*columns).schema)


def keep_good(docs: DataFrame, ranker: Ranker, threshold: float = THRESHOLD,
              text: str = "text") -> DataFrame:
    """The documents that score at least the threshold, all columns."""
    return good_rows(measured(docs, docs.columns[0], text, keep_rows=True), ranker, threshold)
