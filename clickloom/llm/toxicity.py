"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its character n-grams (lower case, whole text), hashed to buckets. With p and
q the smoothed counts of each bucket over toxic and other training texts, a bucket's feature is
its log-count ratio r = log(p / |p|) - log(q / |q|) where the text has it, 0 elsewhere; logistic
regression on these features gives the score.

Training reads labelled rows only: at most `per_class` of each label, those with the smallest
hash of their id (a documented bound; the ids are broadcast, so only texts of chosen ids are
shuffled), one row of each id: where an id stands in several rows, the text of least hash.
Rows of a class are weighted back to its true share. Scoring is one pass over all whole texts.

Cases: null and empty texts have no n-gram and get the score of the bias alone; null labels and
labels of unknown documents are left out; contradicting labels of one document count as toxic;
without any labelled row the score is 0; one class alone gives a constant on its side of 0.5.
Repeated rows are scored each; an empty table gives no rows; other columns are kept, but for one
named like the score, which is replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.linear import Linear, Ngrams, fit_in_one_task, fit_logistic

SIZES = (4, 5)
BITS = 20
PER_CLASS = 4_000


def log_count_ratio(rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray, buckets: int):
    """Log ratio of a bucket's smoothed share of the toxic and of the other class."""
    counts = np.ones((2, buckets))
    for found, y, w in zip(rows, label, weight):
        counts[int(y), found] += w
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1]) - np.log(counts[0])


class _Scaled:
    """Rows of (buckets, their ratios), made one at a time: the ratios of all would be large."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.rows[i], self.ratio[self.rows[i]]


def fit(frame: pd.DataFrame, bits: int = BITS) -> Linear:
    """Model of the rows (buckets as bytes, label, weight of the row's class)."""
    frame = frame.iloc[np.argsort(frame["key"].to_numpy(), kind="stable")]
    label = frame["label"].to_numpy(float)
    weight = frame["weight"].to_numpy(float)
    rows = [np.frombuffer(b, np.int32) for b in frame["buckets"]]
    if label.min() == label.max():
        return Linear(np.zeros(1 << bits, np.float32), 4.0 if label[0] else -4.0)
    ratio = log_count_ratio(rows, label, weight, 1 << bits)
    model = fit_logistic(_Scaled(rows, ratio), label, weight / weight.mean(), 1 << bits)
    return Linear((model.weight * ratio).astype(np.float32), model.bias)


def _buckets(sizes, bits):
    grams: list[Ngrams] = []

    def of(text: str | None) -> np.ndarray:
        if not grams:
            grams.append(Ngrams(sizes, bits))
        return grams[0].of((text or "").lower())

    return of


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = PER_CLASS,
    sizes: tuple[int, ...] = SIZES,
    bits: int = BITS,
) -> Linear:
    """Fit on the labelled documents; `labels` holds the rows that may be learned from."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("key"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts:
        return Linear(np.zeros(1 << bits, np.float32), -np.inf)
    order = [F.xxhash64("key"), F.col("key")]
    chosen = None
    for label, n in sorted(counts.items()):
        part = known.where(F.col("label") == label).orderBy(*order).limit(per_class)
        part = part.withColumn("weight", F.lit(n / min(n, per_class)))
        chosen = part if chosen is None else chosen.unionByName(part)
    of = _buckets(sizes, bits)

    @F.pandas_udf(T.BinaryType())
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: of(t).tobytes())

    rows = (
        docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen), "key")
        .groupBy("key", "label", "weight")  # a repeated id counts once: the text of least hash
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("key", "label", "weight", features("text").alias("buckets"))
    )
    model = fit_in_one_task(rows, lambda frame: fit(frame, bits))
    return model if len(model.weight) else Linear(np.zeros(1 << bits, np.float32), -np.inf)


def score(
    docs: DataFrame,
    model: Linear,
    *,
    text_col: str = "text",
    sizes: tuple[int, ...] = SIZES,
    bits: int = BITS,
    name: str = "score",
) -> DataFrame:
    """`docs` with the score of each whole text, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    of = _buckets(sizes, bits)

    @F.pandas_udf(T.DoubleType())
    def scores(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shared.value.score(of(t))).astype(float)

    return docs.withColumn(name, scores(F.col(text_col).cast("string")))
