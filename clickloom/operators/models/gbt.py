"""Pointwise boosted-tree ranker on pair features.

A category enters as two numbers learned on the training part: its smoothed mean target and its
frequency. So every item keeps its own value, however many there are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import best_per_group
from clickloom.session import materialize, shared_dir
from clickloom.vocab import CATEGORICAL, NUMERIC

PRIOR_ROWS = 20.0
"""Rows of the overall mean that are mixed into each category's mean."""


@dataclass(frozen=True)
class GbtRanker:
    """Trees, and per categorical column a table (value, mean, rows)."""

    trees: GBTRegressionModel
    encodings: dict[str, DataFrame]
    mean: float


def _value(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit("__nan__"))


def encode_categories(train: DataFrame, label: str) -> tuple[dict[str, DataFrame], float]:
    """One small table per categorical column, each from one aggregation with map-side combine."""
    mean = train.agg(F.avg(label)).first()[0] or 0.0
    tables = {}
    for c in CATEGORICAL:
        sums = train.groupBy(_value(c).alias("value")).agg(
            F.sum(label).alias("total"), F.count(label).cast("double").alias("rows")
        )
        smooth = (F.col("total") + PRIOR_ROWS * mean) / (F.col("rows") + PRIOR_ROWS)
        tables[c] = materialize(sums.select("value", smooth.alias("mean"), "rows"), f"codes-{c}")
    return tables, mean


def featurize(pairs: DataFrame, encodings: dict[str, DataFrame], mean: float) -> DataFrame:
    """Feature vector of every pair; values unseen in training get the overall mean and 0 rows."""
    names = []
    for c in NUMERIC:
        pairs = pairs.withColumn(f"_f_{c}", F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
        names.append(f"_f_{c}")
    for c, table in encodings.items():
        codes = table.select(
            F.col("value").alias("_v"), F.col("mean").alias("_m"), F.col("rows").alias("_r")
        )
        pairs = (
            pairs.join(codes, _value(c) == F.col("_v"), "left")
            .withColumns(
                {
                    f"_f_{c}_mean": F.coalesce("_m", F.lit(mean)),
                    f"_f_{c}_rows": F.log1p(F.coalesce("_r", F.lit(0.0))),
                }
            )
            .drop("_v", "_m", "_r")
        )
        names += [f"_f_{c}_mean", f"_f_{c}_rows"]
    return VectorAssembler(inputCols=names, outputCol="features_vec").transform(pairs).drop(*names)


def fit_gbt(
    train: DataFrame,
    valid: DataFrame | None = None,
    label: str = "target",
    iterations: int = 300,
    depth: int = 8,
    rate: float = 0.05,
    seed: int = 42,
) -> GbtRanker:
    """Trees on the graded target; a validation part stops training early."""
    shared_dir(train.sparkSession)
    codes = encode_categories(train, label)
    data = featurize(train, *codes).select("features_vec", F.col(label).alias("label"))
    trainer = GBTRegressor(
        featuresCol="features_vec",
        labelCol="label",
        maxIter=iterations,
        maxDepth=depth,
        stepSize=rate,
        seed=seed,
        checkpointInterval=10,
    )
    if valid is not None:
        held = featurize(valid, *codes).select("features_vec", F.col(label).alias("label"))
        data = data.withColumn("_valid", F.lit(False)).unionByName(
            held.withColumn("_valid", F.lit(True))
        )
        trainer = trainer.setValidationIndicatorCol("_valid")
    return GbtRanker(trainer.fit(data), *codes)


def rank_candidates(model: GbtRanker, candidates: DataFrame, k: int = 15) -> DataFrame:
    """(user_id, item_id, score): the k best candidates of every user."""
    scored = model.trees.transform(featurize(candidates, model.encodings, model.mean)).select(
        "user_id", "item_id", F.col("prediction").alias("score")
    )
    return best_per_group(scored, ["user_id"], [F.desc("score"), F.asc("item_id")], k).drop("_rn")
