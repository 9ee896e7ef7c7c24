"""Periodic runs of words inside a text, and texts without the repeats.

A run is a stretch of words with smallest period q (words q apart are the same), of `min_length`
words and two periods at least, that no neighbouring word extends.

Detection is an online dynamic program on sparse diagonals. Words are read from left to right;
each finds its earlier occurrences, and each occurrence lengthens the match on the diagonal of its
lag. Lags that a word does not continue end there, and a match that was long enough is emitted at
once as a run. As a run matches at least half of `min_length` words in a row, an occurrence counts
if so many words from there on agree (a gram); most words of prose then have none, and stretches
of them end all diagonals without being looked at one by one.

Inside a run of period q, lags that are multiples of q only find the same run again. Once a match
is q long, such occurrences are passed over, each by one hop that its copy a period before has
already paid for; a text of one word repeated a million times takes a million steps. (A text in
which runs nest, such as many copies of `a a a ... a b`, still costs the occurrences of its inner
run in every copy.) A passed-over diagonal may leave a piece behind; pieces are told from runs as
their ends could be extended, and of several periods of one stretch the smallest is its own.

Cases: a null text has no words, no runs, and an empty collapsed text; rows are judged alone, so
ties, repeated rows, null ids and other columns have no influence; an empty table gives no rows. A
text must fit a task's memory, its batch need not hold more than a few.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
WORDS = 1_000_000  # distinct words kept by a worker; beyond that the table starts anew
TEXTS = 64  # texts in a batch of results

_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
RUN = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


class _Numbers(dict):
    """Word -> number, given out in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _grams(ids: np.ndarray, width: int) -> np.ndarray:
    """A label for the `width` words from each position on; equal only if the words are."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX[0])
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(_MIX[1])
    count = len(ids) - width + 1
    labels = np.zeros(count, np.uint64)
    for k in range(width):
        labels = (labels ^ (labels >> np.uint64(29))) * np.uint64(_MIX[0]) + mixed[k : k + count]
    return labels


def _earlier(ids: np.ndarray, labels: np.ndarray, width: int) -> np.ndarray | None:
    """The previous position with the same label, -1 if none; None if a label stands for two."""
    order = np.argsort(labels, kind="stable")
    same = np.flatnonzero(labels[order[1:]] == labels[order[:-1]])
    late, early = order[same + 1], order[same]
    for k in range(width):
        if not np.array_equal(ids[late + k], ids[early + k]):
            return None
    previous = np.full(len(labels), -1, np.int64)
    previous[late] = early
    return previous


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < min_length or n < 2:
        return []
    width = max(1, (min_length + 1) // 2)
    labels = _grams(ids, width)
    previous = _earlier(ids, labels, width)
    if previous is None:
        windows = np.lib.stride_tricks.sliding_window_view(ids, width)
        labels = np.unique(windows, axis=0, return_inverse=True)[1].reshape(-1)
        previous = _earlier(ids, labels, width)
    repeated = np.flatnonzero(previous >= 0)
    if not len(repeated):
        return []
    found: dict[tuple[int, int], int] = {}

    def emit(lag: int, first: int, last: int) -> None:
        """The diagonal `lag` matched from gram `first` to gram `last`."""
        start, end = first - lag, last + width
        if end - start < max(min_length, 2 * lag):
            return
        if start > 0 and ids[start - 1] == ids[start - 1 + lag]:
            return
        if end < n and ids[end] == ids[end - lag]:
            return
        if lag < found.get((start, end), n):
            found[start, end] = lag

    back, same, longest = previous.tolist(), labels.tolist(), n // 2
    active: dict[int, int] = {}  # lag -> first gram of its match
    inside: tuple[int, int] | None = None  # start and period of a run the last gram lies in
    hops: dict[int, tuple] = {}  # gram in a run -> the run, next occurrence that is no multiple
    last = -1
    for i in repeated.tolist():
        if i != last + 1:
            for lag, first in active.items():
                emit(lag, first, last)
            active, inside = {}, None
        now: dict[int, int] = {}
        j = back[i]
        if inside is not None:
            start, period = inside
            if same[i] == same[i - period]:
                now[period] = active.pop(period)
                hop = None
                while j >= 0 and i - j <= longest:
                    if j >= start and (i - j) % period == 0:
                        known = hops.get(j)
                        j = known[1] if known is not None and known[0] == inside else back[j]
                        continue
                    if hop is None:
                        hop = j
                    now[i - j] = active.pop(i - j, i)
                    j = back[j]
                hops[i] = inside, -1 if hop is None else hop
                j = -1
        while j >= 0 and i - j <= longest:
            now[i - j] = active.pop(i - j, i)
            j = back[j]
        for lag, first in active.items():
            emit(lag, first, i - 1)
        lag = min((p for p, first in now.items() if i - first + width >= p), default=0)
        inside = (now[lag] - lag, lag) if lag else None
        active, last = now, i
    for lag, first in active.items():
        emit(lag, first, last)
    return sorted((s, e - s, lag) for (s, e), lag in found.items())


def kept_words(n: int, runs: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay if each run keeps its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def _search(min_length: int):
    def search(batches):
        numbers = _Numbers()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, TEXTS):
                counts, spans, rests = [], [], []
                for text in texts.slice(at, TEXTS):
                    words = (text.as_py() or b"").split()
                    if len(numbers) > WORDS:
                        numbers.clear()
                    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                    runs = find_runs(ids, min_length)
                    if runs:
                        stay = kept_words(len(words), runs).tolist()
                        words = [w for w, s in zip(words, stay) if s]
                    counts.append(len(ids))
                    spans.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                    rests.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(at, TEXTS),
                        pa.array(counts, pa.int64()),
                        pa.array(spans, RUN),
                        pa.array(rests, pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )

    return search


def periodic_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH
) -> DataFrame:
    """One row per document: id, n_words, runs (array of start, length, period in words, by start,
    then period) and collapsed, the words outside of repeats joined by single spaces."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    schema = (
        "id long, n_words long, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    return texts.mapInArrow(_search(min_length), schema).withColumnRenamed("id", id_col)
