"""Interaction pairs, per-user histories and training sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import feature_name
from clickloom.operators.ranking import dense_index, last_k_interactions
from clickloom.vocab import HISTORY_WEIGHTS


def pair_confidence(df: DataFrame, target: str = "log_target") -> DataFrame:
    return df.groupBy("user_id", "item_id").agg(F.sum(target).alias(target))


def min_interactions(df: DataFrame, n: int = 5) -> DataFrame:
    """Rows whose user and item both occur in at least n rows of the unfiltered frame.

    Both counts come from the same input, in one pass each with map-side combine; the
    keepers are semi-joined, so no group is ever gathered.
    """
    kept = df
    for key in ("user_id", "item_id"):
        often = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= n)
        kept = kept.join(often.select(key), key, "left_semi")
    return kept


def min_interactions_events(df: DataFrame, n: int = 5) -> DataFrame:
    """As :func:`min_interactions`, on event rows instead of pairs."""
    return min_interactions(df, n)


def truth_lists(test: DataFrame, target: str) -> DataFrame:
    """Per user the items and relevancies of the test part, one entry per event.

    One row per user, whatever its size: this is the edge format. The pair forms of the
    metrics reduce truth to one row per (user, item) first and need no list.
    """
    entries = F.collect_list(F.struct(F.col("item_id"), F.col(target).alias("rel")))
    return (
        test.groupBy("user_id")
        .agg(F.array_sort(entries).alias("_e"))
        .select(
            "user_id",
            F.col("_e.item_id").alias("true_items"),
            F.col("_e.rel").alias("relevancy"),
        )
    )


def _indexed_history(pairs: DataFrame, catalogue: DataFrame, min_items: int) -> DataFrame:
    """(user_idx, user_id, item_idx[], weight[]) from weighted pairs.

    Pairs are unique, so a user's lists are no longer than the catalogue.
    """
    items = dense_index(catalogue, "item_id", "item_idx")
    known = pairs.join(items, "item_id")
    active = known.groupBy("user_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_items)
    users = dense_index(active, "user_id", "user_idx")
    entry = F.struct(
        F.col("item_idx").cast("int").alias("item_idx"),
        F.col("weight").cast("float").alias("weight"),
    )
    return (
        known.join(users, "user_id")
        .groupBy("user_idx", "user_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("_h"))
        .select(
            F.col("user_idx").cast("int").alias("user_idx"),
            "user_id",
            F.col("_h.item_idx").alias("item_idx"),
            F.col("_h.weight").alias("weight"),
        )
    )


def history_from_features(
    snapshot: DataFrame,
    binary: bool = True,
    min_items: int = 1,
    num_days: int = 30,
    users: DataFrame | None = None,
    items: DataFrame | None = None,
) -> DataFrame:
    """Histories from one day's user-item feature snapshot.

    The snapshot includes its own day, so evaluate only on later days.
    """
    total = F.lit(0.0)
    for action, weight in HISTORY_WEIGHTS.items():
        col = feature_name(f"sum_num_{action}_all_subdomains", ("user_id", "item_id"), num_days)
        total = total + F.coalesce(F.col(col), F.lit(0)) * F.lit(weight)
    base = snapshot if users is None else snapshot.join(users.select("user_id"), "user_id", "left_semi")
    weight = F.when(F.col("_raw") > 0, F.lit(1.0)).otherwise(0.0) if binary else F.log1p("_raw")
    pairs = (
        base.select("user_id", "item_id", total.alias("_raw"))
        .withColumn("weight", weight)
        .where(F.col("weight") > 0)
        .select("user_id", "item_id", "weight")
    )
    return _indexed_history(pairs, items if items is not None else snapshot, min_items)


def history_from_events(
    train: DataFrame,
    target: str = "log_target",
    binary: bool = True,
    min_n: int = 3,
    min_day: int | None = None,
) -> DataFrame:
    """Histories straight from events: pair sums, then the one-pass minimum filter."""
    if min_day is not None:
        train = train.where(F.col("day") >= min_day)
    pairs = min_interactions(pair_confidence(train, target), min_n)
    weight = F.lit(1.0) if binary else F.col(target)
    weighted = pairs.select("user_id", "item_id", weight.alias("weight"))
    return _indexed_history(weighted, weighted, 1)


def build_sequences(
    events: DataFrame,
    max_len: int = 30,
    min_len: int = 3,
    item: str = "item_id",
    ts: str = "ts",
    tie: str = "event_id",
) -> DataFrame:
    """Every prefix of length ``min_len``.. of a user's last ``max_len`` events.

    The target of a prefix is the target of its last event.
    """
    slim = events.select("user_id", item, "target", "action_type", ts, tie)
    recent = last_k_interactions(slim, max_len, day=ts, timestamp=ts, tie=tie)
    long_enough = recent.where(F.size(item) >= min_len)
    lengths = F.explode(F.sequence(F.lit(min_len), F.size(item)))
    return long_enough.withColumn("seq_len", lengths).select(
        "user_id",
        F.slice(item, 1, F.col("seq_len")).alias("item_sequence"),
        F.element_at("target", F.col("seq_len")).alias("target"),
        "seq_len",
    )


def top_items_vocabulary(events: DataFrame, n: int) -> DataFrame:
    """(item_id, item_idx): 1-based popularity rank of the n most frequent items."""
    top = (
        events.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), F.asc("item_id"))
        .limit(n)
    )
    listed = top.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("o"), "item_id"))).alias("_l")
    )
    return listed.select(F.posexplode("_l.item_id").alias("_p", "item_id")).select(
        "item_id", (F.col("_p") + 1).alias("item_idx")
    )


def index_items(events: DataFrame, vocabulary: DataFrame, name: str = "item_idx") -> DataFrame:
    """Vocabulary index of every event's item; 0 for unknown ones."""
    vocab = vocabulary.select("item_id", F.col("item_idx").alias("_i"))
    joined = events.join(vocab, "item_id", "left")
    return joined.withColumn(name, F.coalesce("_i", F.lit(0))).drop("_i")


def pad_sequences(
    sequences: DataFrame, max_len: int = 30, column: str = "item_sequence"
) -> DataFrame:
    """Right-pad index sequences with 0 and add the attention mask."""
    n = F.size(column)
    fill = F.array_repeat(F.lit(0), F.greatest(F.lit(max_len) - n, F.lit(0)))
    ones = F.array_repeat(F.lit(1), n)
    return sequences.withColumns(
        {"input_ids": F.concat(F.col(column), fill), "attention_mask": F.concat(ones, fill)}
    )
