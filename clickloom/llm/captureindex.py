"""Globally ordered capture index by external merge of sorted runs.

A run is an Arrow file of index rows sorted by (urlkey, timestamp, id), in batches of BATCH rows;
its writer also reports the first and last key of each batch. From a bounded sample of those keys
come splitters that cut the key space into ranges; a task takes one range, opens the batches that
reach into it from every run, and merges them with a loser tree: one comparison per level for each
row, one batch of each run in memory. Splitters are whole keys, so a URL with very many captures
spans many ranges. If there are more than `fan_in` runs, groups of `fan_in` are first merged into
longer ones, round after round: by key ranges too, each streamed to a file of its own, so a longer
run is a chain of files in key order and no task holds more than a batch of each run of its group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.files import new_file, open_input
from clickloom.session import materialize

BATCH = 1_024
FAN_IN = 512
SPLITTER_SAMPLE = 20_000

ROW = pa.schema(
    [
        ("urlkey", pa.string()),
        ("ts", pa.string()),
        ("id", pa.int64()),
        ("url", pa.string()),
        ("digest", pa.string()),
        ("record_type", pa.string()),
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
ROW_DDL = (
    "urlkey string, ts string, id long, url string, digest string, record_type string, "
    "file string, offset long, length long"
)
KEY = 3  # leading fields that order rows
BATCHES = (
    "run string, batch int, rows long, first_key string, first_ts string, first_id long, "
    "last_key string, last_ts string, last_id long"
)
NO_ID = -(1 << 63)


def key_of(row: tuple) -> tuple:
    """Order of index rows; a null id comes first."""
    return row[0], row[1], NO_ID if row[2] is None else row[2]


class LoserTree:
    """Merges sorted iterators. Inner nodes keep the loser of their match, the root the winner;
    after a row is taken only the matches on its way up are played again."""

    def __init__(self, sources: Iterable[Iterator[tuple]]):
        self.sources = [iter(s) for s in sources]
        self.heads = [next(s, None) for s in self.sources]
        n = len(self.sources)
        self.losers = [-1] * max(n, 1)
        winners = [-1] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        self.winner = winners[1] if n else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (key_of(x), a) < (key_of(y), b)

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            source = self.winner
            yield self.heads[source]
            self.heads[source] = next(self.sources[source], None)
            node, current = (source + len(self.sources)) // 2, source
            while node:
                if self._beats(self.losers[node], current):
                    self.losers[node], current = current, self.losers[node]
                node //= 2
            self.winner = current


def write_run(path: str, rows: Iterable[tuple]) -> list[tuple]:
    """Write sorted rows as a run, batch by batch; returns its batch descriptors (see BATCHES)."""
    found: list[tuple] = []
    with new_file(path) as sink, pa.ipc.new_file(sink, ROW) as out:
        held: list[tuple] = []

        def flush():
            columns = [pa.array(c, t) for c, t in zip(zip(*held), ROW.types)]
            out.write_batch(pa.RecordBatch.from_arrays(columns, schema=ROW))
            found.append((path, len(found), len(held), *held[0][:KEY], *held[-1][:KEY]))
            held.clear()

        for row in rows:
            held.append(row)
            if len(held) == BATCH:
                flush()
        if held:
            flush()
    return found


def _cursor(path: str, batches: list[int], low: tuple | None, high: tuple | None):
    """Rows of a run's batches from `low` (included) to `high` (not included)."""
    with open_input(path) as source, pa.ipc.open_file(source) as file:
        for number in batches:
            columns = [c.to_pylist() for c in file.get_batch(number).columns]
            for row in zip(*columns):
                key = key_of(row)
                if high is not None and key >= high:
                    return
                if low is None or key >= low:
                    yield row


def _merged(batches: pd.DataFrame, low: tuple | None = None, high: tuple | None = None):
    """Rows of a key range from all runs; the files of a run follow each other in key order."""

    def rows(files: pd.DataFrame) -> Iterator[tuple]:
        for path, part in files.groupby("run", sort=True)["batch"]:
            yield from _cursor(path, part.tolist(), low, high)

    runs = batches.sort_values(["run", "batch"]).groupby("chain", sort=True)
    return LoserTree(rows(files) for _, files in runs)


def _splitters(batches: DataFrame, ranges: int) -> list[tuple]:
    """At most ranges - 1 keys that cut a bounded sample of the batches into equal parts."""
    sample = (
        batches.select("first_key", "first_ts", "first_id", "run", "batch")
        .orderBy(F.xxhash64("run", "batch"))
        .limit(SPLITTER_SAMPLE)
        .collect()
    )
    keys = sorted({key_of(tuple(r)) for r in sample})
    cuts = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    return cuts


def _reaching(batches: DataFrame, cuts: list[tuple]) -> DataFrame:
    """(chain, run, batch, part): each batch once for every key range it reaches into."""

    @F.pandas_udf("array<int>")
    def reached(
        k0: pd.Series, t0: pd.Series, i0: pd.Series, k1: pd.Series, t1: pd.Series, i1: pd.Series
    ) -> pd.Series:
        from bisect import bisect_right

        out = []
        for first, last in zip(zip(k0, t0, i0), zip(k1, t1, i1)):
            low, high = bisect_right(cuts, tuple(first)), bisect_right(cuts, tuple(last))
            out.append(np.arange(low, high + 1, dtype=np.int32))
        return pd.Series(out)

    number = lambda name: F.coalesce(F.col(name), F.lit(NO_ID))
    ends = ["first_key", "first_ts", number("first_id"), "last_key", "last_ts", number("last_id")]
    return batches.select("chain", "run", "batch", F.explode(reached(*ends)).alias("part"))


def _longer_run(folder: str, bounds: list[tuple | None]):
    def merge(batches: pd.DataFrame) -> pd.DataFrame:
        lot, r = int(batches["lot"].iloc[0]), int(batches["part"].iloc[0])
        path = f"{folder}/run-{lot:06d}/part-{r:06d}.arrow"
        found = write_run(path, _merged(batches, bounds[r], bounds[r + 1]))
        frame = pd.DataFrame(found, columns=[c.split()[0] for c in BATCHES.split(", ")])
        frame.insert(0, "chain", f"{folder}/run-{lot:06d}")
        return frame.astype({"first_id": "Int64", "last_id": "Int64"})

    return merge


def _fewer_runs(batches: DataFrame, folder: str, fan_in: int, ranges: int) -> DataFrame:
    """Merge groups of `fan_in` runs until there are at most `fan_in`. A group is merged by key
    ranges, as many as the ranges leave it, each in a task and to a file of its own."""
    tasks = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    level = 0
    while (count := batches.select("chain").distinct().count()) > fan_in:
        groups = -(-count // fan_in)
        order = Window.orderBy("chain")
        lots = batches.select("chain").distinct().select(
            "chain", ((F.row_number().over(order) - 1) % groups).alias("lot")
        )
        cuts = _splitters(batches, max(2, -(-ranges // groups)))
        dealt = (
            _reaching(batches, cuts)
            .join(lots, "chain")
            .repartition(tasks, "lot", "part")
            .groupBy("lot", "part")
        )
        merge = _longer_run(f"{folder}/merged-{level}", [None, *cuts, None])
        batches = materialize(dealt.applyInPandas(merge, f"chain string, {BATCHES}"), "runs")
        level += 1
    return batches


def merge_runs(
    batches: DataFrame, folder: str, *, ranges: int | None = None, fan_in: int = FAN_IN
) -> DataFrame:
    """(index row, position): all rows of the runs, numbered 0.. in global order."""
    spark = batches.sparkSession
    if ranges is None:
        rows = batches.agg(F.sum("rows")).first()[0] or 0
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // 100_000))
    batches = _fewer_runs(batches.withColumn("chain", F.col("run")), folder, fan_in, ranges)
    cuts = _splitters(batches, ranges)
    bounds = [None, *cuts, None]
    parts = _reaching(batches, cuts)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        r = int(part["part"].iloc[0])
        rows = list(_merged(part, bounds[r], bounds[r + 1]))
        frame = pd.DataFrame(rows, columns=ROW.names).astype({"id": "Int64"})
        frame.insert(0, "part", r)
        frame.insert(1, "row", range(len(rows)))
        return frame

    # Dealt to a set number of tasks, as the descriptors of a range are few bytes and much work.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(tasks, "part").groupBy("part")
    merged = materialize(dealt.applyInPandas(merge, f"part int, row long, {ROW_DDL}"), "captures")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = merged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )  # one row per range
    return merged.join(starts, "part").select(
        (F.col("start") + F.col("row")).alias("position"), *ROW.names
    )
