"""Popularity recommender."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.ranking import global_position
from clickloom.session import cut_lineage


def item_popularity(
    events: DataFrame, by: str = "events", positives: Sequence[str] = ("click", "clickout", "like")
) -> DataFrame:
    """(item_id, popularity): events, or distinct users among positive actions."""
    known = events.where(F.col("item_id").isNotNull())
    if by == "events":
        return known.groupBy("item_id").agg(F.count("*").alias("popularity"))
    if by == "users":
        kept = known.where(F.col("action_type").isin(list(positives)))
        return kept.groupBy("item_id").agg(F.count_distinct(F.col("user_id")).alias("popularity"))
    raise ValueError(f"unknown popularity {by!r}")


def popular_items(
    events: DataFrame,
    k: int = 15,
    by: str = "events",
    users: DataFrame | None = None,
    filter_seen: bool = True,
    seen: DataFrame | None = None,
) -> DataFrame:
    """(user_id, item_id, score, pos): the k most popular items each user has not seen.

    Users are never crossed with items. With the items ranked 1, 2, 3, ..., an item a
    user has seen can displace one of the k only while fewer than k unseen items come
    before it; the list is therefore the ranks up to ``k + (number of such items)``
    minus those items. ``seen`` replaces the events as the source of seen pairs.
    """
    order = [F.desc("popularity"), F.asc("item_id")]
    ranked = global_position(item_popularity(events, by), order, "_pos").select(
        "item_id", "popularity", (F.col("_pos") + 1).alias("_rank")
    )
    total = ranked.select(F.count("*")).scalar()
    people = (users if users is not None else events).where(F.col("user_id").isNotNull())
    people = people.select("user_id").distinct()
    if filter_seen:
        source = events if seen is None else seen
        shown = source.select("user_id", "item_id").distinct().join(ranked, "item_id")
        nth = F.row_number().over(Window.partitionBy("user_id").orderBy("_rank"))
        blocking = (
            shown.withColumn("_nth", nth)
            .where(F.col("_rank") - F.col("_nth") < k)
            .groupBy("user_id")
            .agg(F.collect_list("_rank").alias("_blocked"))  # distinct ranks only
        )
        people = people.join(blocking, "user_id", "left")
    else:
        people = people.withColumn("_blocked", F.lit(None).cast("array<bigint>"))
    blocked = F.coalesce("_blocked", F.array().cast("array<bigint>"))
    upto = F.least(F.lit(k) + F.size(blocked), total)
    free = F.array_except(F.sequence(F.lit(1).cast("bigint"), upto.cast("bigint")), blocked)
    people = cut_lineage(people.where(total > 0).select("user_id", upto.alias("_upto"), free.alias("_free")))
    picks = people.select("user_id", F.posexplode("_free").alias("pos", "_rank"))
    # Only the ranks that somebody reads: k plus the longest list of blocked ones.
    used = ranked.join(people.agg(F.max("_upto").alias("_last")), F.col("_rank") <= F.col("_last"))
    return picks.join(used, "_rank").select(
        "user_id", "item_id", F.col("popularity").cast("double").alias("score"), "pos"
    )
