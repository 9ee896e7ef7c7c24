"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(col: str | Column, values: dict) -> Column:
    """Value of a small fixed mapping; null for anything outside it."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.col(col) if isinstance(col, str) else col)


def hash_order(seed: int, *cols: str) -> Column:
    """Pseudo-random but repeatable sort key of a row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in cols)))


def share_of_key(key: str, seed: int) -> Column:
    """Uniform integer in [0, 10000) that depends on the key and seed only."""
    digest = F.substring(hash_order(seed, key), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(10_000))


def feature_name(stat: str, keys: list[str] | tuple[str, ...], days: int | None = None) -> str:
    tail = f"_{days}d" if days is not None else ""
    return f"f_num__{'_'.join(keys)}__{stat}{tail}"


def day_of(ts: str) -> Column:
    """Whole days since 1970-01-01 of a timestamp column."""
    return F.datediff(F.col(ts).cast("date"), F.lit("1970-01-01").cast("date"))


def micros(ts: str) -> Column:
    """Microseconds since the epoch of a timestamp column, with or without zone."""
    return F.unix_micros(F.col(ts).cast("timestamp"))
