"""SimHash fingerprints, and groups of documents whose fingerprints differ in a few bits.

Fingerprint: words are the runs of bytes other than ASCII white space, after lower-casing A-Z;
each shingle of `words` words, joined by spaces and counted as often as it occurs, is hashed with
XXH64 (seed 42); a bit is 1 if it is 1 in over half of the hashes. A shorter text is one shingle,
a text without words has fingerprint zero.

Links: the distinct fingerprints are laid out in tiles by population count (number of ones) and
every tile is compared with itself and each other tile exactly: exclusive-or and bit counts of
numpy over the whole tile. Two tiles whose population counts differ by more than the radius hold
no link and are skipped. Tiles are told apart by arithmetic on 65 counts; a tile travels as one
packed row, once per tile it meets. A tile pair returns a spanning forest of its links, at most
one row per fingerprint, however many pairs lie within the radius, so a group of copies never
becomes its square. Components of the forests are the groups.

Cases: a null text has no words; documents without words are linked like any others; repeated
rows are rows of their own; the component of documents with null ids only is null; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.components import components
from clickloom.llm.files import partitions_of
from clickloom.llm.held import only
from clickloom.llm.skew import hot_keys, join_spread
from clickloom.session import materialize

SEED = 42
BITS = 64
TILE = 8_192  # fingerprints in a tile, on average at most
STRIP = 64  # rows of a tile compared at a time
SLICE = 1 << 18  # shingles hashed at a time

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: str | None, words: int = 4) -> int:
    """The fingerprint of one text as an unsigned integer."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return digest(b" ".join(found), SEED)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = len(found) - words + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, last, SLICE):
        to = min(at + SLICE, last)
        spans = zip(starts[at:to].tolist(), ends[at + words - 1 : to + words - 1].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        columns = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k : 8 * k + 8] += np.bincount(columns[:, k], minlength=256) @ _ONES
    bits = (2 * ones > last).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(text: Column, words: int = 4) -> Column:
    """Fingerprint column, as the signed long with the same bits."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        only("simhash")
        found = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return of(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _join_labels(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give linked nodes x[i], y[i] (and what hangs on them) their smallest label."""
    while len(x):
        lx, ly = label[x], label[y]
        apart = lx != ly
        if not apart.any():
            return
        x, y, lx, ly = x[apart], y[apart], lx[apart], ly[apart]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label[:] = shorter


def link_forest(left: np.ndarray, right: np.ndarray | None, radius: int):
    """Spanning forest of the links between two tiles (or within one): (a, b) fingerprints."""
    other, shift = (left, 0) if right is None else (right, len(left))
    nodes = left if right is None else np.concatenate([left, right])
    label = np.arange(len(nodes))
    for at in range(0, len(left), STRIP):
        strip = left[at : at + STRIP]
        near = np.bitwise_count(strip[:, None] ^ other[None, :]) <= radius
        rows, columns = np.nonzero(near)
        _join_labels(label, rows + at, columns + shift)
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _compare(radius: int):
    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        tiles = [np.frombuffer(p, "<i8").view(np.uint64) for p in pair["pack"]]
        a, b = link_forest(tiles[0], tiles[1] if len(tiles) > 1 else None, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return compare


@F.pandas_udf(T.BinaryType())
def _pack(values: pd.Series) -> pd.Series:
    return values.map(lambda v: np.asarray(v, "<i8").tobytes())


def _tile_plan(distinct: DataFrame, radius: int, tile: int):
    """For each population count p: first tile, number of tiles, and range of tiles to meet.

    Adjacent sparse counts share a tile; a frequent count is split over several by hash. Worked
    out from at most 65 rows.
    """
    counts = {r["ones"]: r["n"] for r in distinct.groupBy("ones").agg(F.count("*").alias("n")).collect()}
    first, split, at, filled = [0] * (BITS + 1), [1] * (BITS + 1), -1, tile
    for p in range(BITS + 1):
        n = counts.get(p, 0)
        if n > tile:
            first[p], split[p] = at + 1, -(-n // tile)
            at, filled = at + split[p], tile
        else:
            if filled + n > tile:
                at, filled = at + 1, 0
            first[p], filled = max(at, 0), filled + n
    low, high = {}, {}
    for p in range(BITS + 1):
        q0, q1 = max(0, p - radius), min(BITS, p + radius)
        for t in range(first[p], first[p] + split[p]):
            low[t] = min(low.get(t, 1 << 60), first[q0])
            high[t] = max(high.get(t, -1), first[q1] + split[q1] - 1)
    return first, split, low, high


def links(prints: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(fingerprint) -> (a, b): links that connect all fingerprints within `radius` bits."""
    distinct = materialize(
        prints.select("fingerprint").distinct().withColumn("ones", F.bit_count("fingerprint")),
        "fingerprints",
    )
    first, split, low, high = _tile_plan(distinct, radius, tile)
    pick = lambda values: F.array(*(F.lit(v) for v in values))
    number = F.element_at(pick(first), F.col("ones") + 1) + F.pmod(
        F.xxhash64("fingerprint"), F.element_at(pick(split), F.col("ones") + 1)
    )
    # What a tile meets depends on its population counts alone, so the ranges stay 65 values.
    by_count = [p for p in range(BITS + 1)]
    meets_from = pick([low[first[p]] for p in by_count])
    meets_to = pick([high[first[p]] for p in by_count])
    tiles = (
        distinct.withColumn("tile", number.cast("long"))
        .groupBy("tile")
        .agg(
            F.collect_list("fingerprint").alias("members"),
            F.min("ones").alias("ones"),
        )
        .select(
            "tile",
            _pack(F.col("members")).alias("pack"),
            F.element_at(meets_from, F.col("ones") + 1).alias("low"),
            F.element_at(meets_to, F.col("ones") + 1).alias("high"),
        )
    )
    reach = F.sequence(F.col("low").cast("long"), F.col("high").cast("long"))
    met = tiles.select("tile", "pack", F.explode(reach).alias("other"))
    pairs = met.select(
        F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "pack"
    )
    # Dealt to a set number of tasks, as a pair is few bytes and much work.
    dealt = pairs.repartition(partitions_of(prints), "one", "two")
    return dealt.groupBy("one", "two").applyInPandas(_compare(radius), "a long, b long")


def group_fingerprints(
    prints: DataFrame, *, id_col: str = "doc_id", radius: int = 4, tile: int = TILE
) -> DataFrame:
    """(id, fingerprint) rows with component_id: the smallest id reachable over links."""
    found = components(links(prints, radius, tile))
    least = materialize(
        prints.groupBy("fingerprint").agg(F.min(id_col).alias("_least"), F.count("*").alias("count")),
        "least",
    )
    total = least.agg(F.sum("count")).first()[0] or 0
    linked = found.join(least, found["node"] == least["fingerprint"]).select("node", "root", "_least")
    linked = materialize(linked, "linked")
    roots = linked.groupBy("root").agg(F.min("_least").alias("_component"), F.count("*").alias("count"))
    named = join_spread(
        linked, roots.drop("count"), "root", hot_keys(roots, "root", total), "node"
    ).select(F.col("node").alias("fingerprint"), "_component")
    # Written first, so that the last join has two plain sides.
    groups = materialize(
        least.join(named, "fingerprint", "left").select(
            "fingerprint", F.coalesce("_component", "_least").alias("component_id")
        ),
        "groups",
    )
    hot = hot_keys(least, "fingerprint", total)
    return join_spread(prints.drop("component_id"), groups, "fingerprint", hot, id_col)


def simhash_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    radius: int = 4,
    tile: int = TILE,
) -> DataFrame:
    """One row per document: id, fingerprint (signed long), component_id."""
    prints = materialize(
        docs.select(
            F.col(id_col), fingerprints(F.col(text_col).cast("string"), words).alias("fingerprint")
        ),
        "simhash",
    )
    return group_fingerprints(prints, id_col=id_col, radius=radius, tile=tile)


def keep_one_per_group(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    radius: int = 4,
    tile: int = TILE,
) -> DataFrame:
    """The rows and columns of `docs` without near copies: of each group the document with the
    smallest id stays (of rows that share that id, one with the smallest fingerprint; in a
    group without any id, one per fingerprint)."""
    marked = materialize(
        docs.select(
            F.struct("*").alias("row"),
            F.col(id_col).alias("id"),
            fingerprints(F.col(text_col).cast("string"), words).alias("fingerprint"),
        ),
        "marked",
    )
    groups = group_fingerprints(
        marked.select("id", "fingerprint"), id_col="id", radius=radius, tile=tile
    )
    alone = F.when(F.col("id").isNull(), F.col("fingerprint"))
    kept = (
        groups.where(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("component_id", alone.alias("alone"))
        .agg(F.min("id").alias("kept"), F.min("fingerprint").alias("kept_print"))
    )
    mine = F.col("id").eqNullSafe(F.col("kept")) & (F.col("fingerprint") == F.col("kept_print"))
    one = marked.join(kept.select("kept", "kept_print"), mine).dropDuplicates(["id", "fingerprint"])
    return one.select("row.*")
