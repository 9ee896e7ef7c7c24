"""Targets from inverse action frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.vocab import ACTIONS, MULTICLASS_COLUMNS, SCALAR_KINDS


def action_weights(df: DataFrame) -> DataFrame:
    """One row per action (and null): count and every target derived from it."""
    counts = df.groupBy("action_type").agg(F.count("*").alias("len"))
    total = df.select(F.count("*")).scalar()
    inverse = total / F.col("len")
    return counts.select(
        "action_type",
        "len",
        inverse.alias("target"),
        F.log1p(inverse).alias("log_target"),
        F.sqrt(inverse).alias("sqrt_target"),
        (F.log(inverse) + 1).alias("log_weight"),
    )


def _attach(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add weight columns (output name -> column of ``action_weights``).

    The table of weights has one row per distinct action of the vocabulary, so it is
    broadcast and the events are not shuffled.
    """
    table = action_weights(df).where(F.col("action_type").isNotNull())
    weights = table.select(
        F.col("action_type").alias("_action"), *(F.col(src).alias(f"_{out}") for out, src in columns.items())
    )
    return df.join(F.broadcast(weights), F.col("action_type") == F.col("_action")).select(
        *df.columns, *(F.col(f"_{out}").alias(out) for out in columns)
    )


def create_target(df: DataFrame, kind: str = "log_target") -> DataFrame:
    """Events with ``len`` and ``target``, or four 0/1 columns for ``multiclass``.

    Null actions count in the total but drop out, as they join with nothing.
    """
    if kind == "multiclass":
        flags = {f"target_{a}": (F.col("action_type") == a).cast("tinyint") for a in ACTIONS}
        return _attach(df, {"len": "len"}).withColumns({c: flags[c] for c in MULTICLASS_COLUMNS})
    if kind not in SCALAR_KINDS:
        raise ValueError(f"unknown target kind {kind!r}")
    source = "target" if kind == "unproccessed" else kind
    return _attach(df, {"len": "len", "target": source})


def all_targets(df: DataFrame) -> DataFrame:
    names = ("target", "log_target", "sqrt_target")
    return _attach(df, {n: n for n in names})


def log_weight_target(df: DataFrame) -> DataFrame:
    return _attach(df, {"target": "log_weight"})


def action_target_mapping(df: DataFrame, kind: str = "log_target") -> DataFrame:
    """Action -> target columns, taken over the whole range so labels do not drift by day."""
    table = action_weights(df).where(F.col("action_type").isNotNull())
    if kind == "multiclass":
        return table.select(
            "action_type",
            *(
                (F.col("action_type") == c.removeprefix("target_")).cast("tinyint").alias(c)
                for c in MULTICLASS_COLUMNS
            ),
        )
    if kind not in SCALAR_KINDS:
        raise ValueError(f"unknown target kind {kind!r}")
    source = "target" if kind == "unproccessed" else kind
    return table.select("action_type", F.col(source).alias("target"))


def target_columns(kind: str) -> list[str]:
    return list(MULTICLASS_COLUMNS) if kind == "multiclass" else ["target"]
