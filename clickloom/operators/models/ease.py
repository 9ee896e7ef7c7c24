"""Linear item-item autoencoder with a closed-form solution."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import dense_index
from clickloom.operators.scoring import score_by_columns
from clickloom.session import cut_lineage, drop_folder, materialize, scratch_path

TILE = 1_024  # items a side: 8 MB
FAN = 16  # tiles summed at a time
ENTRIES = 1_000_000  # counts of a shard of users in a block of items
TILES = "bi int, bj int, v binary"


@dataclass(frozen=True)
class EaseModel:
    """``weights``: one row per item j with column j of B; histories are event counts."""

    weights: DataFrame
    items: DataFrame
    histories: DataFrame
    n_items: int


def _matrix(value: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(value, np.float64).reshape(-1, columns)


def _gram(counts: DataFrame, n: int, tile: int, reg: float, tasks: int) -> DataFrame:
    """X'X + reg I as tiles (bi, bj, v), all of them.

    Users are dealt to shards, so that no shard has more than some ENTRIES counts in a block of
    items; a (shard, row block, column block) group adds up one tile of the upper triangle and
    no pair of items is ever emitted per user. The tiles of the shards are summed FAN at a time.
    """
    blocks = max(1, -(-n // tile))
    width = lambda b: min(tile, n - b * tile)
    placed = counts.withColumn("b", F.expr(f"int(item_idx div {tile})"))
    fullest = placed.groupBy("b").count().agg(F.max("count")).first()[0] or 0
    shards = max(1, -(-fullest // ENTRIES), -(-tasks // blocks**2))
    placed = placed.select(
        F.pmod(F.xxhash64("user_id"), F.lit(shards)).cast("int").alias("s"),
        "b",
        "user_id",
        F.expr(f"int(item_idx % {tile})").alias("at"),
        "x",
    )
    as_row = placed.withColumn("bi", F.col("b")).withColumn(
        "bj", F.explode(F.sequence("b", F.lit(blocks - 1)))
    )
    as_column = placed.withColumn("bj", F.col("b")).withColumn(
        "bi", F.explode(F.sequence(F.lit(0), "b"))
    )
    sides = as_row.withColumn("row", F.lit(True)).unionByName(
        as_column.withColumn("row", F.lit(False))
    )

    def multiply(key: tuple, both: pd.DataFrame) -> pd.DataFrame:
        s, bi, bj = (int(k) for k in key)
        total = np.zeros((width(bi), width(bj)))
        rows, cols = both[both["row"]], both[~both["row"]]
        users = np.intersect1d(rows["user_id"].unique(), cols["user_id"].unique())
        slices = []
        for part, b in ((rows, bi), (cols, bj)):
            part = part[part["user_id"].isin(users)]
            code = np.searchsorted(users, part["user_id"].to_numpy())
            order = np.argsort(code, kind="stable")
            cells = code[order], part["at"].to_numpy()[order], part["x"].to_numpy()[order]
            slices.append((*cells, width(b)))
        for start in range(0, len(users), 1_024):
            stop = min(start + 1_024, len(users))
            dense = []
            for code, at, x, w in slices:
                a, z = np.searchsorted(code, [start, stop])
                slab = np.zeros((stop - start, w))
                slab[code[a:z] - start, at[a:z]] = x[a:z]
                dense.append(slab)
            total += dense[0].T @ dense[1]
        return pd.DataFrame({"s": [s], "bi": [bi], "bj": [bj], "v": [total.tobytes()]})

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, np.float64) for v in parts["v"])
        s, bi, bj = (int(k) for k in key)
        return pd.DataFrame({"s": [s], "bi": [bi], "bj": [bj], "v": [total.tobytes()]})

    def mirrored(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        bi, bj = (int(k) for k in key)
        full = _matrix(parts["v"].iloc[0], width(bj)).copy()
        if bi != bj:
            value = [full.tobytes(), full.T.tobytes()]
            return pd.DataFrame({"bi": [bi, bj], "bj": [bj, bi], "v": value})
        full[np.diag_indices(width(bi))] += reg
        return pd.DataFrame({"bi": [bi], "bj": [bj], "v": [full.tobytes()]})

    keys, schema = ["s", "bi", "bj"], f"s int, {TILES}"
    tiles = sides.groupBy(*keys).applyInPandas(multiply, schema)
    while shards > 1:
        shards = -(-shards // FAN)
        tiles = tiles.withColumn("s", F.expr(f"int(s div {FAN})"))
        tiles = tiles.groupBy(*keys).applyInPandas(add, schema)
    return tiles.groupBy("bi", "bj").applyInPandas(mirrored, TILES)


def _stored(tiles: DataFrame) -> tuple[DataFrame, str]:
    """The tiles written to the shared folder, a few a file as a writer holds 100 rows, and where."""
    spark = tiles.sparkSession
    path = scratch_path(spark, "ease-tiles")
    tiles.write.option("maxRecordsPerFile", 8).parquet(path)
    return spark.read.schema(tiles.schema).parquet(path), path


def _inverse(tiles: DataFrame, n: int, tile: int) -> DataFrame:
    """Tiles of the inverse of a symmetric positive definite matrix, by Gauss-Jordan steps on blocks.

    Step k scales the row panel by the inverse of its pivot tile; then each tile meets the one
    of its row in column k and the one of its column in the panel. A task holds three tiles.
    """
    blocks = -(-n // tile)
    width = lambda b: min(tile, n - b * tile)
    tiles, path = _stored(tiles)
    for k in range(blocks):
        pivot = tiles.where((F.col("bi") == k) & (F.col("bj") == k)).select(F.col("v").alias("p"))

        def scale(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            bj = int(key[0])
            p = _matrix(rows["p"].iloc[0], width(k))
            own = np.eye(width(k)) if bj == k else _matrix(rows["v"].iloc[0], width(bj))
            value = np.linalg.solve(p, own).tobytes()
            return pd.DataFrame({"bi": [k], "bj": [bj], "v": [value]})

        def step(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            bi, bj = (int(x) for x in key)
            of = dict(zip(rows["part"], rows["v"]))
            own = 0.0 if bj == k else _matrix(of["own"], width(bj))
            value = own - _matrix(of["column"], width(k)) @ _matrix(of["row"], width(bj))
            return pd.DataFrame({"bi": [bi], "bj": [bj], "v": [value.tobytes()]})

        panel, panel_path = _stored(
            tiles.where(F.col("bi") == k).crossJoin(pivot).groupBy("bj").applyInPandas(scale, TILES)
        )
        rest = tiles.where(F.col("bi") != k)
        every = F.sequence(F.lit(0), F.lit(blocks - 1))
        column = rest.where(F.col("bj") == k).select("bi", F.explode(every).alias("bj"), "v")
        row = panel.select(F.explode(every).alias("bi"), "bj", "v").where(F.col("bi") != k)
        parts = [("own", rest.where(F.col("bj") != k)), ("column", column), ("row", row)]
        met = [df.select("bi", "bj", "v", F.lit(name).alias("part")) for name, df in parts]
        met = met[0].unionByName(met[1]).unionByName(met[2])
        done = met.groupBy("bi", "bj").applyInPandas(step, TILES).unionByName(panel)
        tiles, new = _stored(done)
        drop_folder(path)
        drop_folder(panel_path)
        path = new
    return tiles


def _weights(inverse: DataFrame, n: int, tile: int) -> DataFrame:
    """(item_idx, weights): column j of B from the tiles of the inverse."""
    width = lambda b: min(tile, n - b * tile)

    def diagonal(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = np.diag(_matrix(rows["v"].iloc[0], width(int(key[0]))))
        return pd.DataFrame({"bj": [int(key[0])], "d": [own.tobytes()]})

    def pieces(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bi, bj = (int(k) for k in key)
        block = -_matrix(rows["v"].iloc[0], width(bj)) / np.frombuffer(rows["d"].iloc[0], np.float64)
        if bi == bj:
            np.fill_diagonal(block, 0.0)
        at = np.arange(width(bj)) + bj * tile
        return pd.DataFrame({"item_idx": at, "bi": bi, "piece": list(block.T)})

    own = inverse.where("bi = bj").groupBy("bj").applyInPandas(diagonal, "bj int, d binary")
    cut = inverse.join(F.broadcast(own), "bj").groupBy("bi", "bj")
    cut = cut.applyInPandas(pieces, "item_idx long, bi int, piece array<double>")
    row = F.array_sort(F.collect_list(F.struct("bi", "piece")))  # n values
    return cut.groupBy("item_idx").agg(F.flatten(row["piece"]).alias("weights"))


def fit_ease(
    events: DataFrame, reg: float = 300.0, tasks: int | None = None
) -> EaseModel:
    """B with zero diagonal over all items of ``events``.

    Repeated events of a pair add up in X. The Gram matrix is dense, items x items: it is a
    table of tiles that is inverted block by block, so no task holds more than FAN of them.
    """
    sc = events.sparkSession.sparkContext
    tile = TILE
    kept = events.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    counts = kept.groupBy("user_id", "item_id").agg(F.count("*").cast("double").alias("x"))
    items = dense_index(counts, "item_id", "item_idx")
    counts = materialize(counts.join(items, "item_id"), "ease-counts")
    n = items.count()
    gram = _gram(counts, n, tile, reg, tasks or sc.defaultParallelism)
    weights = cut_lineage(_weights(_inverse(gram, n, tile), n, tile))
    history = F.array_sort(F.collect_list(F.struct("item_idx", "x")))  # at most n entries
    histories = (
        counts.groupBy("user_id")
        .agg(history.alias("_h"))
        .select("user_id", F.col("_h.item_idx").alias("item_idx"), F.col("_h.x").alias("weight"))
    )
    return EaseModel(weights, items, histories, n)


def recommend_ease(
    model: EaseModel, k: int = 15, users: DataFrame | None = None, filter_seen: bool = True
) -> DataFrame:
    """(user_id, item_id, score): the k best unseen items of every (given) known user."""
    histories = model.histories
    if users is not None:
        histories = histories.join(users.select("user_id").distinct(), "user_id", "left_semi")
    best = score_by_columns(histories, model.weights, model.n_items, k, filter_seen)
    return best.join(model.items, best["_i"] == model.items["item_idx"]).select(
        "user_id", "item_id", "score"
    )
