"""Experiments: fit, recommend, judge; random search over parameters."""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import metrics
from clickloom.operators.histories import history_from_events, min_interactions, pair_confidence
from clickloom.operators.models.als import FactorModel, fit_als
from clickloom.operators.models.ease import fit_ease, recommend_ease
from clickloom.operators.models.multvae import fit_multvae, recommend_multvae, score_pairs_multvae
from clickloom.operators.models.popularity import popular_items
from clickloom.operators.models.svd import fit_svd
from clickloom.operators.ranking import dense_index
from clickloom.operators.scoring import recommend_top_k
from clickloom.session import materialize


def judge(recs: DataFrame, test: DataFrame, target: str, k: int, tie: str = "item_id") -> DataFrame:
    """One row: mean NDCG, precision and recall over users with truth and predictions."""
    truth = metrics.truth_pairs(test, target)
    preds = recs.join(truth.select("user_id").distinct(), "user_id", "left_semi")
    ndcg = metrics.mean_ndcg(metrics.ndcg_pairs(preds, truth, k, tie))
    pr = metrics.precision_recall_pairs(preds, truth, k, tie)
    return ndcg.withColumns(
        {"precision": pr.select("precision").scalar(), "recall": pr.select("recall").scalar()}
    )


def _factor_run(model: FactorModel, test: DataFrame, target: str, k: int) -> tuple[DataFrame, DataFrame]:
    known = test.join(model.users.select("user_id"), "user_id", "left_semi")
    asked = model.users.join(known.select("user_id").distinct(), "user_id", "left_semi")
    recs = recommend_top_k(asked, model.items, k, seen=model.pairs)
    return recs, metrics.event_errors(known, target, model.users, model.items)


def run_experiment(
    model: str, train: DataFrame, test: DataFrame, target: str = "target", k: int = 15, **params: Any
) -> DataFrame:
    """Fit one recommender and judge it; a single result row with its parameters.

    ``model`` is one of popularity, als, svd, ease, multvae. Users the model does not
    know are left out of the judgement.
    """
    errors = None
    if model == "popularity":
        recs = popular_items(train, k, users=test, **params)
    elif model == "als":
        recs, errors = _factor_run(fit_als(train, target, **params), test, target, k)
    elif model == "svd":
        recs, errors = _factor_run(fit_svd(train, target, **params), test, target, k)
    elif model == "ease":
        recs = recommend_ease(fit_ease(train, **params), k, users=test)
    elif model == "multvae":
        min_n, binary = params.pop("min_n", 5), params.pop("binary", True)
        histories = materialize(history_from_events(train, target, binary, min_n), "histories")
        known = min_interactions(pair_confidence(train, target), min_n)
        items = dense_index(known, "item_id", "item_idx")
        fitted = fit_multvae(histories, items.count(), **params)
        params |= {"min_n": min_n, "binary": binary}
        asked = histories.join(test.select("user_id").distinct(), "user_id", "left_semi")
        recs = recommend_multvae(fitted, asked, items, k)
        seen_test = (
            test.join(histories.select("user_id"), "user_id", "left_semi")
            .join(items.select("item_id"), "item_id", "left_semi")
            .groupBy("user_id", "item_id", target)
            .agg(F.count("*").alias("n"))
        )
        errors = metrics.rmse_mae(score_pairs_multvae(fitted, histories, seen_test, items), target)
    else:
        raise ValueError(f"unknown model {model!r}")
    recs = materialize(recs, f"recs-{model}")
    tie = "pos" if "pos" in recs.columns else "item_id"
    row = judge(recs, test, target, k, tie)
    for name in ("rmse", "mae"):
        value = errors.select(name).scalar() if errors is not None else F.lit(None).cast("double")
        row = row.withColumn(name, value)
    described = ", ".join(f"{n}={v}" for n, v in sorted(params.items()))
    return row.select(
        F.lit(model).alias("model"),
        F.lit(described).alias("params"),
        F.lit(target).alias("target"),
        F.lit(k).alias("top_k"),
        "ndcg",
        "precision",
        "recall",
        "rmse",
        "mae",
    )


def draw(space: dict[str, Any], n: int, seed: int = 42) -> list[dict[str, Any]]:
    """n seeded draws: a list is chosen from, a pair is a uniform range of its type."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n):
        trial = {}
        for name, options in sorted(space.items()):
            if isinstance(options, tuple):
                low, high = options
                whole = isinstance(low, int) and isinstance(high, int)
                trial[name] = rng.randint(low, high) if whole else rng.uniform(low, high)
            else:
                trial[name] = rng.choice(list(options))
        trials.append(trial)
    return trials


def run_trials(
    space: dict[str, Any],
    n: int,
    objective: Callable[[dict[str, Any]], DataFrame],
    seed: int = 42,
    metric: str = "ndcg",
) -> tuple[dict[str, Any], DataFrame]:
    """Best parameters and the ranked trial table.

    ``objective`` turns parameters into a one-row result (one Spark job per trial, over
    splits made once by the caller). Refit with the returned parameters on all data.
    """
    trials = draw(space, n, seed)
    rows = [
        materialize(objective(trial).withColumn("trial", F.lit(i)), "trial")
        for i, trial in enumerate(trials)
    ]
    table = reduce(lambda a, b: a.unionByName(b), rows).orderBy(F.desc(metric), F.asc("trial"))
    return trials[table.first()["trial"]], table
