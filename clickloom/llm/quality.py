"""Quality classifier from weak labels.

Eight heuristic labellers each look at one property of a whole text and say bad (0), good (1) or
nothing (2). Their votes overlap and none is trusted: expectation-maximisation estimates, without
any true label, the share of bad texts and how often each labeller says what about good and bad
texts (its accuracy), and from these the posterior probability of each pattern of votes. A
pattern is one of 3**8, so the counts of patterns over the whole corpus are all that EM reads.

The posteriors label a bounded number of rows (`per_class` of each likely class, those with the
smallest hash: a documented bound), and these train a hashed linear scorer on word shapes, shape
pairs and repeats. The scorer then judges every whole text; texts under the threshold go.

Text without white space (Chinese or Japanese prose, base64, minified code) would be one word of
any length: a word over LONG characters is read as a row of UNIT characters with the signs behind
them, and labellers and scorer see these in its place. Every character plays its part.

Cases: null and empty texts have no words, so every labeller is silent, and they score 0: there
is nothing to learn from. Texts of a few words keep the labellers silent too. A corpus whose
texts all look alike trains a constant; repeated rows are scored each; an empty table gives no
rows; all columns of the table are kept, but for one named like the score, which is replaced.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.held import only
from clickloom.llm.linear import Linear, fit_in_one_task, fit_logistic
from clickloom.session import materialize

BAD, GOOD, SILENT = 0, 1, 2
BITS = 16
PER_CLASS = 3_000
THRESHOLD = 0.5
SYMBOLS = "#$%&*+=<>@\\^_{|}~"
SHAPES = 200_000  # distinct words whose shape is kept at a time

# Name, bounds: bad at or above the second, good at or below the first, silent between.
LABELLERS = {
    "symbols": (0.02, 0.25),  # signs such as # or | per word
    "capitals": (0.10, 0.50),  # share of words written in capitals
    "shouting": (0.02, 0.20),  # exclamation marks per word
    "lone_signs": (0.02, 0.15),  # share of words without a letter or digit
    "echoes": (0.02, 0.30),  # share of words equal to the one before
    "narrow": (0.50, 0.80),  # 1 - distinct words / words, of the first-to-last stretches
    "sign_runs": (0.01, 0.15),  # a sign three times in a row, per word
    "unstopped": (0.50, 0.98),  # share of stretches of 40 words without a full stop
}
STRETCH = 40
FEW = 5  # words below which shares say nothing
LONG = 60  # characters above which a word is read in units
UNIT = re.compile(r"\w{1,6}[^\w]{0,3}|[^\w]{1,3}")  # no character is left out
STOPS = (".", "!", "?", ":", ";", "。", "！", "？", "：", "；")


def words_of(text: str) -> list[str]:
    """The words of a text; those over LONG characters as their units."""
    words = text.split()
    if max(map(len, words), default=0) <= LONG:
        return words
    return [u for w in words for u in (UNIT.findall(w) if len(w) > LONG else (w,))]


def _shares(text: str) -> list[float] | None:
    words = words_of(text)
    n = len(words)
    if n < FEW:
        return None
    capitals = sum(w.isupper() and len(w) > 1 for w in words)
    lone = sum(len(w) < 4 and not any(map(str.isalnum, w)) for w in words)
    echoes = sum(a == b for a, b in zip(words, words[1:]))
    stretches = [words[i : i + STRETCH] for i in range(0, n, STRETCH)]
    distinct = sum(len(set(s)) for s in stretches)
    stopped = sum(any(w.endswith(STOPS) for w in s) for s in stretches)
    return [
        sum(map(text.count, SYMBOLS)) / n,
        capitals / n,
        (text.count("!") + text.count("！")) / n,
        lone / n,
        echoes / n,
        1 - distinct / n,
        sum(text.count(3 * c) for c in SYMBOLS) / n,
        1 - stopped / len(stretches),
    ]


def votes(text: str | None) -> int:
    """The labellers' votes on a text, as one number in base 3."""
    shares = _shares(text or "")
    if shares is None:
        return 3 ** len(LABELLERS) - 1
    pattern = 0
    for share, (good, bad) in zip(shares, LABELLERS.values()):
        pattern = 3 * pattern + (BAD if share >= bad else GOOD if share <= good else SILENT)
    return pattern


def _digits(patterns: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return patterns[:, None] // powers % 3


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> dict:
    """EM over vote patterns: prior of good, confusion[class, labeller, vote], posterior of good.

    Starts from a guess in which one bad vote outweighs all good ones, as labellers say good far
    more easily. A silent vote tells nothing about the class.
    """
    said = _digits(patterns)
    bad, good = (said == BAD).sum(1), (said == GOOD).sum(1)
    posterior = np.clip((good + 1.0) / (good + 1.0 + (len(LABELLERS) + 1) * bad), 0.02, 0.98)
    total = counts.sum()
    for _ in range(rounds):
        share = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = np.clip(share.sum(1) / total, 1e-6, 1)
        table = np.full((2, len(LABELLERS), 2), 0.5)
        for vote in (BAD, GOOD):
            table[:, :, vote] += share @ (said == vote)
        table /= table.sum(2, keepdims=True)
        log = np.log(prior)[:, None] + sum(
            np.log(table[:, :, vote]) @ (said == vote).T for vote in (BAD, GOOD)
        )
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        done = np.abs(new - posterior).max() < 1e-9
        posterior = new
        if done:
            break
    return {"prior": float(prior[1]), "confusion": table, "posterior": posterior}


class Shapes(dict):
    """Word -> hash of its shape: runs of capitals, small letters, digits; signs as they are."""

    def __missing__(self, word: str) -> int:
        shape = []
        for c in word:
            kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
            if not shape or shape[-1] != kind:
                shape.append(kind)
        if len(self) > SHAPES:
            self.clear()
        value = self[word] = zlib.crc32("".join(shape).encode())
        return value


def features(text: str | None, shapes: Shapes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: shape, shape pair and repeat counts, each by the root of its share."""
    words = words_of(text or "")
    if not words:
        return np.zeros(0, np.int32), np.zeros(0)
    kind = np.fromiter(map(shapes.__getitem__, words), np.uint64, len(words))
    ends = np.fromiter(map(len, words), np.uint64, len(words))
    echo = np.fromiter((a == b for a, b in zip(words, words[1:])), np.uint64, len(words) - 1)
    pair = kind[:-1] * np.uint64(31) + kind[1:] + np.uint64(7)
    size = ends + np.uint64(1 << 40)  # at most LONG
    found = np.concatenate([kind, pair, echo + np.uint64(1 << 41), size])
    mixed = found * np.uint64(0x9E3779B97F4A7C15)
    index, count = np.unique((mixed >> np.uint64(64 - bits)).astype(np.int32), return_counts=True)
    return index, np.sqrt(count / len(words))


def vote_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(hash, pattern) of every row, written once: the votes are cast in one pass."""

    @F.pandas_udf(T.IntegerType())
    def pattern(texts: pd.Series) -> pd.Series:
        only("quality")
        return pd.Series([votes(t) for t in texts], dtype="int32")

    text = F.col(text_col).cast("string")
    return materialize(
        docs.select(_row_hash(id_col, text).alias("hash"), pattern(text).alias("pattern")), "votes"
    )


def _row_hash(id_col: str, text):
    return F.xxhash64(F.col(id_col), text)


def posteriors(marks: DataFrame) -> tuple[dict[int, float], dict]:
    """Posterior of good per vote pattern, and the label model, from counts over all rows."""
    rows = marks.groupBy("pattern").count()
    found = sorted((r["pattern"], r["count"]) for r in rows.collect())  # at most 3**8 rows
    if not found:
        return {}, {}
    patterns, counts = np.array([p for p, _ in found]), np.array([float(c) for _, c in found])
    model = label_model(patterns, counts)
    return dict(zip(patterns.tolist(), model["posterior"].tolist())), model


def _fit(bits: int):
    def fit(frame: pd.DataFrame) -> Linear:
        frame = frame.sort_values(["hash", "index", "value"], kind="stable")
        rows = [
            (np.frombuffer(i, np.int32), np.frombuffer(v, np.float64))
            for i, v in zip(frame["index"], frame["value"])
        ]
        target = frame["target"].to_numpy(float)
        return fit_logistic(rows, target, np.ones(len(rows)), 1 << bits, epochs=12, rate=0.5)

    return fit


def train(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = PER_CLASS,
    bits: int = BITS,
) -> Linear:
    """Label model over all rows, then the scorer on a bounded number of them."""
    spark = docs.sparkSession
    marks = vote_table(docs, id_col, text_col)
    posterior, _ = posteriors(marks)
    if not posterior:
        return Linear(np.zeros(1 << bits, np.float32), 0.0)
    table = spark.createDataFrame(list(posterior.items()), "pattern int, target double")
    judged = marks.join(F.broadcast(table), "pattern").select("hash", "target").distinct()
    sides = [
        judged.where(side).orderBy("hash").limit(per_class)
        for side in (F.col("target") >= 0.5, F.col("target") < 0.5)
    ]
    chosen = sides[0].unionByName(sides[1])  # at most 2 * per_class rows

    @F.pandas_udf("index binary, value binary")
    def example(texts: pd.Series) -> pd.DataFrame:
        only("quality")
        shapes, out = Shapes(), []
        for t in texts:
            index, value = features(t, shapes, bits)
            out.append((index.tobytes(), value.tobytes()))
        return pd.DataFrame(out, columns=["index", "value"])

    text = F.col(text_col).cast("string")
    rows = (
        docs.select(_row_hash(id_col, text).alias("hash"), text.alias("text"))
        .join(F.broadcast(chosen), "hash")
        .groupBy("hash")  # repeated rows count once
        .agg(F.first("text").alias("text"), F.first("target").alias("target"))
        .select("hash", "target", example("text").alias("e"))
    )
    return fit_in_one_task(rows.select("hash", "target", "e.*"), _fit(bits))


def score(
    docs: DataFrame,
    model: Linear,
    *,
    text_col: str = "text",
    bits: int = BITS,
    name: str = "score",
) -> DataFrame:
    """`docs` with the probability that each whole text is good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: list[Shapes] = []

    @F.pandas_udf(T.DoubleType())
    def scores(texts: pd.Series) -> pd.Series:
        only("quality")
        if not held:
            held.append(Shapes())
        found = (features(t, held[0], bits) for t in texts)
        return pd.Series([shared.value.score(*f) if len(f[0]) else 0.0 for f in found], dtype=float)

    return docs.withColumn(name, scores(F.col(text_col).cast("string")))
