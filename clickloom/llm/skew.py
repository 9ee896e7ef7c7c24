"""Joins on keys of which one may hold a large share of all rows.

A key is hot if it has over a thousandth of the rows. There are fewer than a thousand hot keys,
whatever the data, so a list of them may be broadcast. Rows of a hot key are dealt over as many
parts as bring each under that share, and the other side's rows of that key are repeated once a
part, less than two thousand times in all. Other keys stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 1000
FEW = 256  # rows of one key that no task minds


def hot_keys(counts: DataFrame, key: str, total: int, count: str = "count") -> DataFrame:
    """(key, count of its rows) -> (key, parts) for the hot keys among `total` rows."""
    share = max(total / SHARES, FEW)
    parts = F.ceil(F.col(count) / F.lit(float(share))).cast("int")
    return counts.where(F.col(count) > share).select(key, parts.alias("_parts"))


def join_spread(
    rows: DataFrame, other: DataFrame, key: str, hot: DataFrame, spread: str
) -> DataFrame:
    """Inner join of `rows` with `other` on `key`; `spread` is a column of `rows` that differs
    within a key, `hot` the list of hot keys."""
    listed = F.broadcast(hot)
    part = F.coalesce(F.pmod(F.xxhash64(F.col(spread)), F.col("_parts")), F.lit(0)).cast("int")
    dealt = rows.join(listed, key, "left").withColumn("_at", F.struct(key, part.alias("part")))
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    copies = (
        other.where(F.col(key).isNotNull())
        .join(listed, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("_at", F.struct(key, F.col("_part").alias("part")))
    )
    # Key and part are one column, else a side already dealt by the key would set the partitioning.
    return dealt.drop("_parts").join(copies.drop(key, "_parts", "_part"), "_at").drop("_at")
