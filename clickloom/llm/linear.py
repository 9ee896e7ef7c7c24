"""Hashed linear classifiers: features hashed to a fixed number of buckets, logistic training.

Features are found in tasks over the whole table; the fit runs on a bounded number of rows in one
task, and its result is two arrays of fixed size, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 20  # characters of a text worked on at a time


@dataclass
class Linear:
    """score = sigmoid(bias + sum of weight[bucket] * value)."""

    weight: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray, values: np.ndarray | None = None) -> float:
        z = self.bias
        if len(buckets):
            found = self.weight[buckets]
            z += float(found.sum(dtype=np.float64) if values is None else found @ values)
        if z == -np.inf:
            return 0.0
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


class Ngrams:
    """Distinct character n-grams of a text as bucket numbers; one object per worker."""

    def __init__(self, sizes: tuple[int, ...], bits: int):
        self.sizes, self.bits = sizes, bits
        self.stamp = np.zeros(1 << bits, np.int32)

    def _hashes(self, units: np.ndarray) -> np.ndarray:
        rolling, found = units.astype(np.uint32), []
        for n in range(1, max(self.sizes) + 1):
            if n > 1:
                if len(rolling) < 2:
                    break
                rolling = rolling[:-1] * np.uint32(0x01000193) + units[n - 1 :]
            if n in self.sizes:
                mixed = (rolling ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE35)
                found.append(mixed >> np.uint32(32 - self.bits))
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def _distinct(self, buckets: np.ndarray) -> np.ndarray:
        order = np.arange(len(buckets), dtype=np.int32)
        self.stamp[buckets] = order
        return buckets[self.stamp[buckets] == order]

    def of(self, text: str) -> np.ndarray:
        """Distinct buckets of all n-grams of a whole text, as int32."""
        units = np.frombuffer(text.encode("utf-32-le"), "<u4")
        parts = [
            self._distinct(self._hashes(units[max(0, at - max(self.sizes) + 1) : at + SLICE]))
            for at in range(0, len(units), SLICE)
        ]
        if not parts:
            return np.zeros(0, np.int32)
        whole = parts[0] if len(parts) == 1 else self._distinct(np.concatenate(parts))
        return whole.astype(np.int32)


def fit_logistic(
    rows: Sequence[tuple[np.ndarray, np.ndarray]],
    target: np.ndarray,
    weight: np.ndarray,
    buckets: int,
    *,
    epochs: int = 3,
    rate: float = 0.1,
    seed: int = 0,
) -> Linear:
    """Weighted logistic regression on sparse rows by AdaGrad in a fixed shuffled order.

    `target` holds probabilities of class 1, so soft labels train as they are.
    """
    w, square = np.zeros(buckets), np.full(buckets, 1e-8)
    bias, bias_square = 0.0, 1e-8
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            index, value = rows[i]
            now = w[index]
            z = bias + float(now @ value)
            error = (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - target[i]) * weight[i]
            step = error * value
            spread = square[index] + step * step
            square[index] = spread
            w[index] = now - rate * step / np.sqrt(spread)
            bias_square += error * error
            bias -= rate * error / np.sqrt(bias_square)
    return Linear(w.astype(np.float32), float(bias))


def fit_in_one_task(rows: DataFrame, fit) -> Linear:
    """Run `fit(pandas frame) -> Linear` on a bounded DataFrame and bring back the model."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        model = fit(frame)
        return pd.DataFrame({"weight": [model.weight.tobytes()], "bias": [model.bias]})

    one = rows.withColumn("_one", F.lit(1)).groupBy("_one")
    found = one.applyInPandas(run, "weight binary, bias double").first()
    if found is None:
        return Linear(np.zeros(0, np.float32), 0.0)
    return Linear(np.frombuffer(found["weight"], np.float32), found["bias"])
