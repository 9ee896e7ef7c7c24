"""Persisting latent factors and model weights as Parquet tables."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.models.ease import EaseModel
from clickloom.operators.models.multvae import VaeModel


def save_factors(users: DataFrame, items: DataFrame, path: str) -> str:
    """Two tables of (id, features ARRAY<FLOAT>) below one folder."""
    for name, df in (("users", users), ("items", items)):
        packed = df.withColumn("features", F.col("features").cast("array<float>"))
        packed.write.mode("overwrite").parquet(os.path.join(path, name))
    return path


def load_factors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.parquet(os.path.join(path, "users")),
        spark.read.parquet(os.path.join(path, "items")),
    )


def save_ease(model: EaseModel, path: str) -> str:
    """Item weights, item ids and user histories of a linear autoencoder as three tables."""
    for name in ("weights", "items", "histories"):
        getattr(model, name).write.mode("overwrite").parquet(os.path.join(path, name))
    return path


def load_ease(spark: SparkSession, path: str) -> EaseModel:
    weights, items, histories = (
        spark.read.parquet(os.path.join(path, name)) for name in ("weights", "items", "histories")
    )
    return EaseModel(weights, items, histories, items.count())


def save_multvae(spark: SparkSession, model: VaeModel, items: DataFrame, path: str) -> str:
    """Weight matrices by row, sizes and losses, and the item ids of the columns."""
    rows = [
        (name, list(w.shape), i, row.tolist())
        for name, w in model.weights.items()
        for i, row in enumerate(np.atleast_2d(w))
    ]
    schema = "name string, shape array<int>, row int, values array<float>"
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(path, "weights"))
    facts = [(model.depth, model.n_items, [float(x) for x in model.losses])]
    spark.createDataFrame(facts, "depth int, n_items int, losses array<double>").write.mode(
        "overwrite"
    ).parquet(os.path.join(path, "facts"))
    items.write.mode("overwrite").parquet(os.path.join(path, "items"))
    return path


def load_multvae(spark: SparkSession, path: str) -> tuple[VaeModel, DataFrame]:
    """The model and its item ids (item_id, item_idx)."""
    parts: dict[str, list] = {}
    for r in spark.read.parquet(os.path.join(path, "weights")).collect():  # the model, as in memory
        parts.setdefault(r["name"], []).append(r)
    weights = {}
    for name, rows in parts.items():
        rows.sort(key=lambda r: r["row"])
        weights[name] = np.array([r["values"] for r in rows], np.float32).reshape(rows[0]["shape"])
    facts = spark.read.parquet(os.path.join(path, "facts")).first()
    model = VaeModel(weights, facts["depth"], facts["n_items"], list(facts["losses"]))
    return model, spark.read.parquet(os.path.join(path, "items"))
