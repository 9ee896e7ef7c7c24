"""Concatenation, differences and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_vertical(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def concat_diagonal(*frames: DataFrame) -> DataFrame:
    """Columns missing in some frames become null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def acted_without_view(
    events: DataFrame, acted: Sequence[str] = ("click", "clickout", "like")
) -> DataFrame:
    """Users with a stronger action but no view, in one aggregation."""
    did = F.col("action_type").isin(list(acted))
    per_user = events.groupBy("user_id").agg(
        F.coalesce(F.bool_or(did), F.lit(False)).alias("_acted"),
        F.coalesce(F.bool_or(F.col("action_type") == "view"), F.lit(False)).alias("_viewed"),
    )
    return per_user.where(F.col("_acted") & ~F.col("_viewed")).select("user_id")


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key combination in the given order.

    An aggregate keeps one row per key and task before the shuffle, so a key with a
    third of all rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    sort_key = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)])
    row = F.min_by(F.struct(*rest), sort_key)
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")
