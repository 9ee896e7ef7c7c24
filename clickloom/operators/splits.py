"""Time splits and the cold-start split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import micros
from clickloom.operators.quantiles import quantile_nearest

Pair = tuple[DataFrame, DataFrame]


def global_temporal_split(df: DataFrame, test_size: int | float = 1, day: str = "day") -> Pair:
    """Train before the cut day, test after it; the cut day itself is a gap.

    The two bounds are read first (an aggregate over one column), so the filters
    carry constants and prune day partitions.
    """
    first, last = df.agg(F.min(day), F.max(day)).first()
    if first is None:
        raise ValueError("no days to split")
    size = test_size
    if isinstance(test_size, float):
        size = max(int((last - first + 1) * test_size), 1)
    cut = last - size
    if cut - 1 < first or cut + 1 > last:
        raise ValueError(f"test size {size} does not fit days {first}..{last} (cut {cut})")
    return df.where(F.col(day) < cut), df.where(F.col(day) > cut)


def timestamp_fraction_split(df: DataFrame, fraction: float = 0.2, ts: str = "ts") -> Pair:
    """Cut at ``min + (max - min)(1 - fraction)``, no gap."""
    us = micros(ts)
    cut = df.select(F.min(us) + (F.max(us) - F.min(us)) * F.lit(1.0 - fraction)).scalar()
    return df.where(us < cut), df.where(us >= cut)


def timestamp_quantile_split(df: DataFrame, q: float = 0.8, ts: str = "ts") -> Pair:
    """Cut at the nearest-rank q-quantile of the timestamps."""
    us = df.select(micros(ts).alias("us"))
    cut = quantile_nearest(us, "us", q).select("quantile").scalar()
    return df.where(micros(ts) < cut), df.where(micros(ts) >= cut)


def validation_split(pairs: DataFrame, fraction: float = 0.1, day: str = "last_day") -> Pair:
    """The last ``max(int(days * fraction), 1)`` days become validation, no gap."""
    days = F.max(day) - F.min(day) + 1
    held = F.greatest(F.floor(days * F.lit(fraction)), F.lit(1))
    start = pairs.select(F.max(day) - held + 1).scalar()
    return pairs.where(F.col(day) < start), pairs.where(F.col(day) >= start)


def split_cold_start(train: DataFrame, test: DataFrame, user: str = "user_id") -> Pair:
    """(cold, warm) rows of the test part. Rows without a user count as warm."""
    known = train.where(F.col(user).isNotNull()).select(user).distinct()
    cold = test.where(F.col(user).isNotNull()).join(known, user, "left_anti")
    flagged = test.join(known.withColumn("_known", F.lit(True)), user, "left")
    warm = flagged.where(F.col("_known") | F.col(user).isNull()).drop("_known")
    return cold, warm
