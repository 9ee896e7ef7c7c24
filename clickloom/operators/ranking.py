"""Positions, last-k, top-k and dense indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage
from clickloom.vocab import ACTIONS

_LOCAL_ROW = (1 << 33) - 1


def global_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """0-based position of every row in a total order, with no one-task window.

    Rows are range-partitioned and sorted, the result is checkpointed so that the
    partitions stay what they are when a task is repeated, and each partition's
    start is the running total of the sizes before it (one row per partition, which
    bounds the broadcast).
    """
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = placed.withColumn("_part", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_ROW))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )


def dense_index(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Contiguous 0-based index of the sorted distinct keys."""
    ids = df.where(F.col(key).isNotNull()).select(key).distinct()
    return global_position(ids, [F.col(key)], name or f"{key}_idx")


def position_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "position"
) -> DataFrame:
    """0-based position inside each group, for groups of any size.

    The group's rows may span many range partitions; the position is the global one
    minus the group's smallest.
    """
    keys = list(keys)
    ranked = global_position(df, [*(F.col(k) for k in keys), *order], "_global")
    first = ranked.groupBy(*keys).agg(F.min("_global").alias("_first"))
    return (
        ranked.join(first, keys)
        .withColumn(name, F.col("_global") - F.col("_first"))
        .drop("_global", "_first")
    )


def ordinal_rank(
    df: DataFrame, keys: Sequence[str], score: str, tie: str, name: str = "rank"
) -> DataFrame:
    """1-based rank by descending score; equal scores keep the order of ``tie``."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn(name, F.row_number().over(w))


def top_n(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(col), F.asc(tie)).limit(n)


def sort_by(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order)


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group. Spark keeps k rows per group and task before the
    shuffle, so a hot group never arrives whole."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)


def _lists(df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str]) -> DataFrame:
    """Collect columns to parallel lists in ascending order of ``pos``."""
    rows = F.array_sort(
        F.collect_list(F.struct(F.col(pos).alias("_p"), F.struct(*columns).alias("_r")))
    )
    return (
        df.groupBy(*keys)
        .agg(rows.alias("_rows"))
        .select(*keys, *(F.col(f"_rows._r.{c}").alias(c) for c in columns))
    )


def last_k_interactions(
    events: DataFrame,
    k: int | None = 30,
    user: str = "user_id",
    day: str = "day",
    timestamp: str = "ts",
    tie: str = "event_id",
    actions: Sequence[str] | None = None,
) -> DataFrame:
    """Per user, every other column as a list in ascending time, last ``k`` only.

    ``k=None`` keeps all interactions: one row per user, of any size.
    """
    kept = events.where(F.col("action_type").isin(list(actions or ACTIONS)))
    columns = [c for c in events.columns if c != user]
    if k is not None:
        newest = [F.desc(day), F.desc(timestamp), F.desc(tie)]
        kept = best_per_group(kept, [user], newest, k).withColumn("_pos", -F.col("_rn"))
        return _lists(kept, [user], "_pos", columns)
    order = F.struct(F.col(day), F.col(timestamp), F.col(tie))
    return _lists(kept.withColumn("_pos", order), [user], "_pos", columns)


def top_k_per_user(
    scores: DataFrame, k: int, user: str = "user_id", item: str = "item_id", score: str = "score"
) -> DataFrame:
    """Lists ``predicted_items`` and ``predicted_scores``, best first; ties by item."""
    best = best_per_group(scores, [user], [F.desc(score), F.asc(item)], k)
    named = best.select(
        user, F.col(item).alias("predicted_items"), F.col(score).alias("predicted_scores"), "_rn"
    )
    return _lists(named, [user], "_rn", ["predicted_items", "predicted_scores"])


def rank_list(recs: DataFrame, user: str = "user_id") -> DataFrame:
    """Lists back to rows with a 1-based rank."""
    zipped = F.arrays_zip("predicted_items", "predicted_scores")
    return recs.select(user, F.posexplode(zipped).alias("_p", "_r")).select(
        user,
        (F.col("_p") + 1).alias("rank"),
        F.col("_r.predicted_items").alias("item_id"),
        F.col("_r.predicted_scores").alias("score"),
    )
