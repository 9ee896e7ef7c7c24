"""Null handling, dtype compaction, renaming, sampling and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.columns import lookup, share_of_key
from clickloom.operators.quantiles import quantiles
from clickloom.vocab import BINARY_LABELS, DAY_US

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def fill_codes(df: DataFrame, cols: Sequence[str], value: int = -1) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)).cast("int") for c in cols})


def fill_unknown(df: DataFrame, cols: Sequence[str], brand: str | None = None) -> DataFrame:
    filled = {c: F.coalesce(F.col(c), F.lit("unknown")) for c in cols}
    if brand:
        filled[brand] = F.coalesce(F.col(brand), F.lit(-1).cast("long"))
    return df.withColumns(filled)


def impute_median(df: DataFrame, col: str) -> DataFrame:
    """Nulls become the exact median of the rest (one scalar, found in bounded buckets)."""
    middle = quantiles(df, col, {"median": 0.5}, rule="linear").select("median").scalar()
    return df.withColumn(col, F.coalesce(F.col(col), middle))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def filter_actions(df: DataFrame, actions: Sequence[str]) -> DataFrame:
    return df.where(F.col("action_type").isin(list(actions)))


def filter_selected(
    df: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None
) -> DataFrame:
    if users is not None:
        df = df.join(users.select("user_id"), "user_id", "left_semi")
    if items is not None:
        df = df.join(items.select("item_id"), "item_id", "left_semi")
    return df


def compact_dtypes(df: DataFrame) -> DataFrame:
    """64-bit floats to 32 bit; integers stay as they are."""
    if not any(isinstance(f.dataType, T.DoubleType) for f in df.schema.fields):
        return df
    return df.selectExpr(
        *(
            f"CAST(`{f.name}` AS FLOAT) AS `{f.name}`"
            if isinstance(f.dataType, T.DoubleType)
            else f"`{f.name}`"
            for f in df.schema.fields
        )
    )


def attribute_names(schema: T.StructType, key: str) -> dict[str, str]:
    """New name of every attribute: numeric ones by float type, codes and text otherwise."""
    names = {}
    for field in schema.fields:
        if field.name == key:
            continue
        if isinstance(field.dataType, _FLOATS):
            names[field.name] = f"f_num__{field.name}"
        elif isinstance(field.dataType, (*_INTEGERS, T.StringType)):
            names[field.name] = f"f_cat__{field.name}"
    return names


def rename_attributes(df: DataFrame, key: str) -> DataFrame:
    return df.withColumnsRenamed(attribute_names(df.schema, key))


def to_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def shift_epoch(df: DataFrame, start: str, ts_us: str = "ts_us", name: str = "shifted") -> DataFrame:
    """Microseconds to timestamps, moved so that the first midnight is ``start``."""
    first = df.select(F.expr(f"min({ts_us}) div {DAY_US}")).scalar()
    target = F.unix_micros(F.to_timestamp(F.lit(start)))
    moved = F.col(ts_us) - first * F.lit(DAY_US) + target
    return df.withColumn(name, F.timestamp_micros(moved))


def binary_label(df: DataFrame, labels: dict[str, int] | None = None) -> DataFrame:
    return df.withColumn("label", lookup("action_type", labels or BINARY_LABELS).cast("int"))


def map_action_weight(df: DataFrame, weights: dict[str, float], name: str = "weight") -> DataFrame:
    return df.withColumn(name, lookup("action_type", weights))


def sample_users(df: DataFrame, fraction: float, seed: int = 42, user: str = "user_id") -> DataFrame:
    """All events of a fixed pseudo-random share of users; no id list, no shuffle."""
    return df.where(share_of_key(user, seed) < F.lit(int(round(fraction * 10_000))))


def filter_top_items(df: DataFrame, n: int, item: str = "item_id") -> DataFrame:
    """Events of the n most frequent items (ties by id)."""
    top = (
        df.where(F.col(item).isNotNull())
        .groupBy(item)
        .count()
        .orderBy(F.desc("count"), F.asc(item))
        .limit(n)
    )
    return df.join(top.select(item), item, "left_semi")
