"""Counts: actions, daily pair counters, active entities, distinct values, conversions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.vocab import ACTIONS, CONVERSIONS, SUBDOMAINS


def action_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("action_type").agg(F.count("*").alias("len"))


def select_top_entities(
    events: DataFrame,
    n_last_days: int = 10,
    top_users: int | None = 20_000,
    top_items: int | None = 20_000,
    day_from: int | None = None,
    day_to: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(users, items): most active over the last days of the range; ``None`` or 0 = all."""
    last = F.lit(day_to) if day_to is not None else events.select(F.max("day")).scalar()
    first = F.lit(day_from) if day_from is not None else events.select(F.min("day")).scalar()
    start = F.greatest(first, last - F.lit(n_last_days - 1))
    window = events.where((F.col("day") >= start) & (F.col("day") <= last))

    def most_active(key: str, n: int | None) -> DataFrame:
        if not n:
            return window.where(F.col(key).isNotNull()).select(key).distinct()
        counts = window.where(F.col(key).isNotNull()).groupBy(key).count()
        return counts.orderBy(F.desc("count"), F.asc(key)).limit(n).select(key)

    return most_active("user_id", top_users), most_active("item_id", top_items)


def daily_pair_counters(
    events: DataFrame,
    actions: Sequence[str] = ACTIONS,
    subdomains: Sequence[str] = SUBDOMAINS,
) -> DataFrame:
    """One row per (day, user, item) with a count per action and subdomain.

    All counters come out of one aggregation with map-side combine; events without a
    subdomain count in ``_all_subdomains`` only, events without a known action not
    at all.
    """
    cells = []
    for action in actions:
        is_action = f"action_type = '{action}'"
        cells += [
            F.expr(f"count_if({is_action} AND subdomain = '{sub}') AS `num_{action}_{sub}`")
            for sub in subdomains
        ]
        cells.append(F.expr(f"count_if({is_action}) AS `num_{action}_all_subdomains`"))
    known = events.where(F.col("action_type").isin(list(actions)))
    return known.groupBy("day", "user_id", "item_id").agg(*cells)


def long_counters(events: DataFrame) -> DataFrame:
    """(user, item, feature, count) rows: per action and subdomain, and per action in total."""
    prefix = F.concat(F.lit("num_"), F.col("action_type"), F.lit("_"))
    keys = ["user_id", "item_id", "action_type"]
    by_subdomain = (
        events.groupBy(*keys, "subdomain")
        .agg(F.count("*").alias("count"))
        .select("user_id", "item_id", F.concat(prefix, "subdomain").alias("feature"), "count")
    )
    totals = (
        events.groupBy(*keys)
        .agg(F.count("*").alias("count"))
        .select(
            "user_id", "item_id", F.concat(prefix, F.lit("all_subdomains")).alias("feature"), "count"
        )
    )
    return by_subdomain.unionByName(totals).where(F.col("feature").isNotNull())


def pivot_counts(long: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long counters to one column per named feature; missing cells are 0."""
    wide = long.groupBy("user_id", "item_id").pivot("feature", list(features)).sum("count")
    return wide.fillna(0, list(features))


def nunique_by(
    df: DataFrame, dim: str, col: str, approximate: bool = False, name: str = "n_unique"
) -> DataFrame:
    """Distinct values of ``col`` per value of ``dim``, the null group included."""
    counted = F.approx_count_distinct(col) if approximate else F.count_distinct(F.col(col))
    return df.groupBy(dim).agg(counted.alias(name))


def conversion_rates(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``rate_{strong}_given_{weak}`` for every action pair; null when the weak one is absent."""
    counts = {a: F.count_if(F.col("action_type") == a) for a in ACTIONS}
    rates = [
        F.try_divide(counts[strong], counts[weak]).alias(f"rate_{strong}_given_{weak}")
        for weak, strong in CONVERSIONS
    ]
    return df.groupBy(*keys).agg(*rates)
