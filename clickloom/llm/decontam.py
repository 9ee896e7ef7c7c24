"""Benchmark decontamination by pigeonhole edit matching.

A test item occurs in a text if some stretch of the text is within `budget(item)` edits of it
(characters inserted, deleted or replaced), after both are lower-cased and runs of white space
became one space. With a budget of k edits the item is cut into k + 1 pieces: k edits can touch k
of them, so one piece at least stands in the text unchanged. All pieces of a block of items are
found in one pass over the text (Aho-Corasick), and every hit is verified by Myers' bit-parallel
edit distance over the window that a match around it could cover. No hit is left out, so the
result is exact: all (document, item) pairs within the budget, with the least distance.

Items are dealt by hash to blocks of about `block_chars` normalised characters; a block is what a
task holds, and its size is the bound of what the driver collects and broadcasts. Blocks are worked
on one after another: with several, what a pass finds or leaves is written to the shared folder
before the next block is collected. More items mean more passes, not a larger broadcast. Repeated items with equal texts share their pieces and their work.

Cases: null and blank items match nothing; short items (under 1 / rate characters) have no budget
and need an exact occurrence; null texts contain nothing; repeated documents and items are each
reported; an empty table of items or documents gives no rows; other columns are kept by
`remove_contaminated` and not read by `find_contaminated`. Very long texts are worked on whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.held import only
from clickloom.session import materialize

RATE = 0.10
BLOCK_CHARS = 4_000_000


def normalise(text: str | None) -> str:
    """Lower case, white space as single spaces, none at the ends."""
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """`budget` + 1 adjacent pieces of nearly equal length, with their places."""
    bounds = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:])]


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(pattern: str, window: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of `pattern` to a stretch of `window`, and the first end that has it.

    Myers' algorithm for approximate search: bit i of `up` and `down` tells whether cell i of the
    current column is one more or one less than cell i - 1.
    """
    m = len(pattern)
    masks = _masks(pattern) if masks is None else masks
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best, end = m, 0
    for j, c in enumerate(window):
        equal = masks.get(c, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        if right_up & high:
            distance += 1
        elif right_down & high:
            distance -= 1
        if distance < best:
            best, end = distance, j + 1
        right_up = right_up << 1 & full
        right_down = right_down << 1 & full
        vertical = equal | down
        up = right_down | ~(vertical | right_up) & full
        down = right_up & vertical
    return best, end


def _chains(count: int) -> list[list[tuple[int, int]]]:
    """For each of `count` leaves of a balanced binary tree its ancestors, smallest first."""
    chains: list[list[tuple[int, int]]] = [[] for _ in range(count)]

    def split(low: int, high: int) -> None:
        if high - low > 1:
            middle = (low + high) // 2
            split(low, middle)
            split(middle, high)
            for leaf in range(low, high):
                chains[leaf].append((low, high))

    split(0, count)
    return chains


class Matcher:
    """Finds the items of one block in texts.

    The pieces of an item are the leaves of a binary tree. In a match within the budget some leaf
    is unchanged and each node above it, with n leaves, has at most n - 1 edits (else both its
    halves had too many, and so the node). A hit is therefore verified from its leaf upwards,
    which ends most chance hits after a few characters, and loses no match.
    """

    def __init__(self, items: list[str], rate: float = RATE):
        import ahocorasick

        self.items = items
        self.budget = [int(len(item) * rate) for item in items]
        self.masks: list[dict[tuple[int, int], tuple[str, dict[str, int]]]] = [{} for _ in items]
        places: dict[str, list[tuple[int, int, list]]] = {}
        for number, item in enumerate(items):
            cuts = pieces(item, self.budget[number])
            bounds = [at for at, _ in cuts] + [len(item)]
            for (at, piece), chain in zip(cuts, _chains(len(cuts))):
                steps = [(bounds[low], bounds[high], high - low - 1) for low, high in chain]
                places.setdefault(piece, []).append((number, at, steps or [(0, len(item), 0)]))
        self.search = ahocorasick.Automaton()
        for piece, where in places.items():
            self.search.add_word(piece, (len(piece), where))
        self.empty = not places
        if places:
            self.search.make_automaton()

    def _part(self, number: int, a: int, b: int):
        parts = self.masks[number]
        if (a, b) not in parts:
            part = self.items[number][a:b]
            parts[a, b] = part, _masks(part)
        return parts[a, b]

    def _verify(self, text: str, number: int, start: int, steps: list):
        """Least distance and end of the item around `start`, the place its first character would
        have without edits, and the window looked at; None beyond the budget."""
        for a, b, edits in steps:
            slack = edits if b - a < len(self.items[number]) else 2 * edits
            low, high = max(0, start + a - slack), min(len(text), start + b + slack)
            part, masks = self._part(number, a, b)
            distance, end = myers(part, text[low:high], masks)
            if distance > edits:
                return None
        return distance, low + end, low, high

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, begin, end) of the best stretch of each item within its budget."""
        if self.empty or not text:
            return
        seen: dict[int, tuple[int, int]] = {}
        best: dict[int, tuple[int, int]] = {}
        for last, (length, where) in self.search.iter(text):
            for number, at, steps in where:
                start, slack = last + 1 - length - at, self.budget[number]
                low, high = seen.get(number, (0, -1))
                if low <= max(0, start - slack) and (
                    min(len(text), start + len(self.items[number]) + slack) <= high
                ):
                    continue  # inside the window that was verified last
                found = self._verify(text, number, start, steps)
                if found:
                    distance, end, *window = found
                    seen[number] = tuple(window)
                    if number not in best or (distance, end) < best[number]:
                        best[number] = distance, end
        for number, (distance, end) in sorted(best.items()):
            item = self.items[number]
            stretch = text[max(0, end - len(item) - distance) : end]
            _, length = myers(item[::-1], stretch[::-1])  # shortest stretch with this end
            yield number, distance, end - length, end


def _blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int):
    """All (item, t) rows, distinct normalised items with the number of their block, and how many
    blocks there are."""

    @F.pandas_udf("string")
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(normalise, na_action=None)

    rows = items.select(F.col(id_col).alias("item"), plain(F.col(text_col).cast("string")).alias("t"))
    rows = materialize(rows.where("t <> ''"), "items")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    count = -(-total // block_chars)
    number = F.pmod(F.xxhash64("t"), F.lit(max(1, count)))
    distinct = rows.select("t").distinct().withColumn("block", number)
    if count > 1:
        distinct = materialize(distinct, "blocks")
    return rows, distinct, count


def _each_block(distinct: DataFrame, count: int) -> Iterator:
    """The blocks that hold items, each broadcast. The driver holds one at a time: if there are
    several, a broadcast is gone when the next one is asked for."""
    for number in range(count):
        block = sorted(r["t"] for r in distinct.where(F.col("block") == number).collect())
        if block:
            shared = distinct.sparkSession.sparkContext.broadcast(block)
            del block
            yield shared
            if count > 1:
                shared.destroy()


def _finder(shared, rate: float):
    held: list[Matcher] = []

    def matcher() -> Matcher:
        only("decontam")
        if not held:
            held.append(Matcher(shared.value, rate))
        return held[0]

    return matcher


def find_contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item it contains: id, item id, distance, begin and end of the best
    stretch in the normalised text."""
    spark = docs.sparkSession
    rows, distinct, count = _blocks(items, item_id_col, item_text_col, block_chars)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, t string, distance int, begin int, end int"
    found = spark.createDataFrame([], schema)
    for shared in _each_block(distinct, count):
        matcher = _finder(shared, rate)

        def search(frames, matcher=matcher):
            for frame in frames:
                out = []
                for key, text in zip(frame["id"].array, frame["text"]):
                    for number, *where in matcher().find(normalise(text)):
                        out.append((key, matcher().items[number], *where))
                yield pd.DataFrame(out, columns=["id", "t", "distance", "begin", "end"]).astype(
                    {"id": "Int64"}
                )

        matches = texts.mapInPandas(search, schema)
        found = found.unionByName(matches if count == 1 else materialize(matches, "matches"))
    return found.join(rows, "t").select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_id_col),
        "distance",
        "begin",
        "end",
    )


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows and columns of `docs` that contain no item."""
    _, distinct, count = _blocks(items, item_id_col, item_text_col, block_chars)
    for shared in _each_block(distinct, count):
        clean = _cleaner(_finder(shared, rate))
        docs = docs.where(clean(F.col(text_col).cast("string")))
        if count > 1:
            docs = materialize(docs, "clean")
    return docs


def _cleaner(matcher):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        found = (next(matcher().find(normalise(t)), None) for t in texts)
        return pd.Series([hit is None for hit in found], dtype=bool)

    return clean
