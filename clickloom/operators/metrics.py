"""Ranking and regression metrics.

The list forms accept the evaluation frame (one row per user with list columns) and
unfold it. The ``*_pairs`` forms work on (user, item) rows directly and are what the
experiments use: truth is reduced to one row per pair first, so a user with very many
events never has to fit into a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.ranking import best_per_group


def _gain(rel: str = "rel", rank: str = "_rn") -> Column:
    return F.sum(F.coalesce(F.col(rel), F.lit(0.0)) / F.log2(F.col(rank) + 1))


def truth_pairs(test: DataFrame, target: str) -> DataFrame:
    """(user, item, rel, n): best relevancy and number of events of each pair."""
    return test.groupBy("user_id", "item_id").agg(
        F.max(target).alias("rel"), F.count("*").alias("n")
    )


def _explode_truth(df: DataFrame, items: str, rel: str) -> DataFrame:
    zipped = F.arrays_zip(F.col(items).alias("i"), F.col(rel).alias("r"))
    return df.select("user_id", F.posexplode_outer(zipped).alias("pos", "_t")).select(
        "user_id", "pos", F.col("_t.i").alias("item_id"), F.col("_t.r").cast("double").alias("rel")
    )


def _explode_predictions(df: DataFrame, items: str, scores: str) -> DataFrame:
    zipped = F.arrays_zip(F.col(items).alias("i"), F.col(scores).alias("s"))
    return df.select("user_id", F.posexplode_outer(zipped).alias("pos", "_p")).select(
        "user_id",
        "pos",
        F.col("_p.i").alias("item_id"),
        F.coalesce(F.col("_p.s").cast("double"), F.lit(0.0)).alias("score"),
    )


def _dcg(preds: DataFrame, truth: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    top = best_per_group(preds, ["user_id"], order, k)
    judged = top.join(truth.select("user_id", "item_id", "rel"), ["user_id", "item_id"], "left")
    return judged.groupBy("user_id").agg(_gain().alias("_dcg"))


def _ideal(rels: DataFrame, k: int) -> DataFrame:
    """Best attainable gain per user from rows of (user_id, rel)."""
    top = best_per_group(rels.where(F.col("rel").isNotNull()), ["user_id"], [F.desc("rel")], k)
    return top.groupBy("user_id").agg(_gain().alias("_idcg"))


def _ratio(dcg: DataFrame, ideal: DataFrame) -> DataFrame:
    value = F.coalesce(F.try_divide(F.col("_dcg"), F.col("_idcg")), F.lit(0.0))
    return dcg.join(ideal, "user_id", "left").select("user_id", value.alias("ndcg"))


def ndcg_pairs(preds: DataFrame, truth: DataFrame, k: int = 15, tie: str = "pos") -> DataFrame:
    """NDCG@k from (user, item, score, tie) and (user, item, rel) rows."""
    order = [F.desc("score"), F.asc(tie)]
    return _ratio(_dcg(preds, truth, order, k), _ideal(truth, k))


def ndcg_at_k(
    df: DataFrame,
    relevancy: str = "relevancy",
    true_items: str = "true_items",
    predicted_items: str = "predicted_items",
    predicted_scores: str = "predicted_scores",
    k: int = 15,
) -> DataFrame:
    """NDCG@k per user; the ideal order ranks all truth items, predicted or not."""
    truth = (
        _explode_truth(df, true_items, relevancy)
        .groupBy("user_id", "item_id")
        .agg(F.max("rel").alias("rel"))
    )
    return ndcg_pairs(_explode_predictions(df, predicted_items, predicted_scores), truth, k)


def ndcg_at_k_predicted_ideal(
    df: DataFrame,
    relevancy: str = "relevancy",
    true_items: str = "true_items",
    predicted_items: str = "predicted_items",
    predicted_scores: str = "predicted_scores",
    k: int = 15,
) -> DataFrame:
    """Older form: the ideal order ranks the relevancies of the predicted items only."""
    truth = (
        _explode_truth(df, true_items, relevancy)
        .groupBy("user_id", "item_id")
        .agg(F.max("rel").alias("rel"))
    )
    preds = _explode_predictions(df, predicted_items, predicted_scores)
    judged = preds.join(truth, ["user_id", "item_id"], "left")
    order = [F.desc("score"), F.asc("pos")]
    return _ratio(_dcg(preds, truth, order, k), _ideal(judged.select("user_id", "rel"), k))


def ndcg_at_k_list_order(
    df: DataFrame,
    relevancy: str = "relevancy",
    true_items: str = "true_items",
    predicted_items: str = "predicted_items",
    k: int = 15,
) -> DataFrame:
    """Third form: the list order as given, the last relevancy of a repeated truth item,
    the ideal over the raw relevancies."""
    raw = _explode_truth(df, true_items, relevancy)
    truth = raw.groupBy("user_id", "item_id").agg(F.max_by("rel", "pos").alias("rel"))
    listed = df.select("user_id", F.posexplode_outer(predicted_items).alias("pos", "item_id"))
    dcg = _dcg(listed, truth, [F.asc("pos")], k)
    return _ratio(dcg, _ideal(raw.select("user_id", "rel"), k))


def mean_ndcg(per_user: DataFrame) -> DataFrame:
    return per_user.agg(F.avg("ndcg").alias("ndcg"))


def precision_recall_at_k(
    df: DataFrame,
    predicted_items: str = "predicted_items",
    true_items: str = "true_items",
    k: int = 15,
) -> DataFrame:
    """Mean precision (hits / k) and recall (hits / truth entries, repeats counted)."""
    hits = F.size(F.array_intersect(F.slice(predicted_items, 1, k), F.col(true_items)))
    return df.agg(
        F.avg(hits / F.lit(k)).alias("precision"),
        F.avg(F.try_divide(hits, F.size(true_items))).alias("recall"),
    )


def precision_recall_set(
    df: DataFrame,
    predicted_items: str = "predicted_items",
    true_items: str = "true_items",
    k: int = 15,
) -> DataFrame:
    """As above with distinct truth items; an empty truth has recall 0."""
    hits = F.size(F.array_intersect(F.slice(predicted_items, 1, k), F.col(true_items)))
    size = F.size(F.array_distinct(true_items))
    return df.agg(
        F.avg(hits / F.lit(k)).alias("precision"),
        F.avg(F.coalesce(F.try_divide(hits, size), F.lit(0.0))).alias("recall"),
    )


def precision_recall_pairs(
    preds: DataFrame, truth: DataFrame, k: int = 15, tie: str = "pos"
) -> DataFrame:
    """Pair form, over users that have both predictions and truth."""
    top = best_per_group(preds, ["user_id"], [F.desc("score"), F.asc(tie)], k)
    shown = top.groupBy("user_id").agg(F.lit(True).alias("_shown"))
    hits = (
        top.select("user_id", "item_id")
        .distinct()
        .join(truth.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")
        .groupBy("user_id")
        .agg(F.count("*").alias("_hits"))
    )
    per_user = (
        truth.groupBy("user_id")
        .agg(F.sum("n").alias("_truth"))
        .join(shown, "user_id")
        .join(hits, "user_id", "left")
        .withColumn("_hits", F.coalesce("_hits", F.lit(0)))
    )
    return per_user.agg(
        F.avg(F.col("_hits") / F.lit(k)).alias("precision"),
        F.avg(F.try_divide(F.col("_hits"), F.col("_truth"))).alias("recall"),
    )


def rmse_mae(scored: DataFrame, target: str, score: str = "score") -> DataFrame:
    """Event-level errors of scored test rows; ``n`` column = multiplicity if present."""
    n = F.col("n") if "n" in scored.columns else F.lit(1)
    diff = F.col(target) - F.col(score)
    total = F.sum(n)
    return scored.agg(
        F.sqrt(F.try_divide(F.sum(diff * diff * n), total)).alias("rmse"),
        F.try_divide(F.sum(F.abs(diff) * n), total).alias("mae"),
        F.coalesce(total, F.lit(0)).alias("n"),
    )


def event_errors(
    test: DataFrame, target: str, user_vectors: DataFrame, item_vectors: DataFrame
) -> DataFrame:
    """RMSE and MAE of dot products over test rows with known user and item.

    Events are counted per (user, item, target) first, so repeats are scored once.
    """
    from clickloom.functions.vectors import dot

    grouped = test.groupBy("user_id", "item_id", target).agg(F.count("*").alias("n"))
    scored = (
        grouped.join(user_vectors.select("user_id", F.col("features").alias("_u")), "user_id")
        .join(item_vectors.select("item_id", F.col("features").alias("_v")), "item_id")
        .withColumn("score", dot("_u", "_v"))
    )
    return rmse_mae(scored, target)


def robustness(
    df: DataFrame, before: str = "before", after: str = "after"
) -> DataFrame:
    """How much two recommendation lists of the same users differ, over all rows."""
    a, b = F.col(before), F.col(after)
    common = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    stability = F.try_divide(common, F.size(F.array_distinct(a)))
    jaccard = F.coalesce(F.try_divide(common, union), F.lit(1.0))
    differs = F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1))
    changed = F.aggregate(differs, F.lit(0), lambda acc, x: acc + x)
    return df.agg(
        F.avg(stability).alias("stability_mean"),
        F.stddev_pop(stability).alias("stability_std"),
        F.avg(jaccard).alias("jaccard_mean"),
        F.stddev_pop(jaccard).alias("jaccard_std"),
        F.avg(changed).alias("changed_mean"),
        F.count("*").alias("users"),
    )


def remove_random_items(pairs: DataFrame, m: int = 1, seed: int = 42) -> DataFrame:
    """Histories without m pseudo-random items; users with m items or fewer drop out."""
    from clickloom.functions.columns import hash_order

    sizes = pairs.groupBy("user_id").agg(F.count("*").alias("_n")).where(F.col("_n") > m)
    kept = pairs.join(sizes.select("user_id"), "user_id", "left_semi")
    order = [hash_order(seed, "user_id", "item_id"), F.col("item_id")]
    removed = best_per_group(kept.select("user_id", "item_id"), ["user_id"], order, m)
    return kept.join(removed.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def compare(results: DataFrame, baseline: str, metric: str = "ndcg", key: str = "model") -> DataFrame:
    """Results, best first, with absolute and relative difference to one row."""
    base = results.where(F.col(key) == baseline).select(F.max(metric)).scalar()
    delta = F.col(metric) - base
    return results.withColumns(
        {"delta": delta, "delta_pct": F.try_divide(delta, base) * 100}
    ).orderBy(F.desc(metric), F.asc(key))
