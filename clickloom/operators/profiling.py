"""Data-profiling jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import micros
from clickloom.operators.quantiles import quantiles
from clickloom.session import materialize


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, rate) from a single aggregation over the table."""
    counts = df.agg(
        F.count("*").alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns)
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    )
    return counts.select("_rows", pairs.alias("_p")).select(
        F.col("_p.column").alias("column"),
        F.col("_p.nulls").alias("nulls"),
        F.try_divide(F.col("_p.nulls"), F.col("_rows")).alias("rate"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier one in every column; nulls are equal."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def joint_nulls(df: DataFrame, a: str, b: str) -> DataFrame:
    both = F.count_if(F.col(a).isNull() & F.col(b).isNull())
    return df.agg(both.alias("both_null"), F.try_divide(both, F.count("*")).alias("share"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("count"))


def describe_by(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max per group; null groups are left out."""
    kept = df
    for key in keys:
        kept = kept.where(F.col(key).isNotNull())
    # Read for the statistics and for each step of the quartiles: worked out once.
    kept = materialize(kept.select(*keys, col), "described")
    stats = kept.groupBy(*keys).agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
    )
    wanted = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = quantiles(kept, col, wanted, keys, "linear")
    if keys:
        joined = stats.join(quartiles, list(keys), "left")
    else:
        joined = stats.withColumns({n: quartiles.select(n).scalar() for n in wanted})
    return joined.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def zscore_outliers(df: DataFrame, col: str, t: float = 3.0) -> DataFrame:
    """Rows more than t population standard deviations from the mean."""
    mean = df.select(F.avg(col)).scalar()
    spread = df.select(F.stddev_pop(col)).scalar()
    z = F.try_divide(F.col(col) - mean, spread)
    return df.withColumn("z", z).where(F.abs("z") > t)


def time_span(df: DataFrame, ts: str = "ts") -> DataFrame:
    us = micros(ts)
    return df.agg(
        F.min(us).alias("first_us"),
        F.max(us).alias("last_us"),
        (F.max(us) - F.min(us)).alias("span_us"),
    )


def top_items(df: DataFrame, action: str, n: int = 10) -> DataFrame:
    counts = (
        df.where(F.col("action_type") == action).groupBy("item_id").agg(F.count("*").alias("count"))
    )
    return counts.orderBy(F.desc("count"), F.asc("item_id")).limit(n)


def top_items_by_users(
    df: DataFrame, n: int = 10, positives: Sequence[str] = ("click", "clickout", "like")
) -> DataFrame:
    """Items by distinct users with a positive action."""
    counts = (
        df.where(F.col("action_type").isin(list(positives)))
        .groupBy("item_id")
        .agg(F.count_distinct(F.col("user_id")).alias("users"))
    )
    return counts.orderBy(F.desc("users"), F.asc("item_id")).limit(n)


def cardinalities(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n_unique): distinct non-null values of each column.

    The columns are unfolded and deduplicated before counting, so each is a plain
    two-step aggregation, whatever its size.
    """
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols]
        )
    )
    long = df.select(pairs.alias("_p")).select("_p.column", "_p.v").distinct()
    return long.groupBy("column").agg(F.count("v").alias("n_unique"))
