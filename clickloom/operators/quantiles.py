"""Exact quantiles that never sort a whole group in one task.

Repeated values collapse first, with map-side combine. A level counts the values of
each group per bucket; running totals over these few counts name the one bucket that
holds each wanted rank, and only its values go on. The first level cuts the range by
order of magnitude, so that an outlier does not push all others into one bucket; each
further level cuts a bucket between its own smallest and largest value. Levels end when
no bucket that holds a rank has over ``ordered`` different values: those are ordered.
A group holding a third of all rows is therefore spread over its buckets, whatever the
shape of its values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import materialize

RULES = ("nearest", "floor", "linear")


def _ranks(rule: str, q: float, total: Column) -> list[Column]:
    """0-based positions to read for one quantile."""
    if rule == "nearest":
        return [F.round((total - 1) * F.lit(float(q))).cast("long")]
    if rule == "floor":
        return [F.least(F.floor(total * F.lit(float(q))), total - 1).cast("long")]
    exact = (total - 1) * F.lit(float(q))
    return [F.floor(exact).cast("long"), F.ceil(exact).cast("long")]


def cut(value: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Bucket of equal width between ``lo`` and ``hi``; infinite and NaN values keep their order."""
    share = F.try_divide(value - lo, hi - lo) * buckets
    inner = F.floor(F.greatest(F.lit(0.0), F.least(share, F.lit(buckets - 1.0))))
    return (
        F.when(F.isnan(value), buckets + 1)
        .when(value == float("inf"), buckets)
        .when(value == float("-inf"), -1)
        .otherwise(F.coalesce(inner, F.lit(0)))
        .cast("int")
    )


def _by_magnitude(cells: DataFrame, buckets: int) -> Column:
    """Bucket by sign and logarithm: no bucket spans many orders of magnitude."""
    d = F.col("_v").cast("double")
    finite = ~F.isnan(d) & (F.abs(d) != float("inf"))
    low, high, tiny = cells.where(finite).agg(
        F.min(d), F.max(d), F.min(F.when(d != 0, F.abs(d)))
    ).first()
    if tiny is None:  # nothing but zeros and non-finite values
        return cut(d, F.lit(0.0), F.lit(0.0), buckets)

    def ends(v: float) -> Column:
        size = 0.0 if v == 0 else math.copysign(math.log(abs(v)) - math.log(tiny) + 1, v)
        return F.lit(size)

    scaled = F.when(d == 0, F.lit(0.0)).otherwise(
        F.signum(d) * (F.ln(F.abs(d)) - F.lit(math.log(tiny)) + 1)
    )
    return cut(F.when(finite, scaled).otherwise(d), ends(low), ends(high), buckets)


def hit_buckets(rows: DataFrame, by: list[str], reads: list[Column], above: DataFrame | None) -> DataFrame:
    """The buckets ``_b`` of a level (within ``_p``, a bucket of the level above) that hold a wanted
    rank: ranks before them, group totals, the reads that fall in, values and their range."""
    counts = rows.groupBy(*by, "_p", "_b").agg(
        F.sum("_m").alias("_c"),
        F.count("*").alias("_k"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    )
    whole = Window.partitionBy(*by, "_p")
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    if above is None:
        counts = counts.withColumn("_total", F.sum("_c").over(whole))
        counts = counts.withColumn("_reads", F.array(*reads))
    else:
        known = above.select(
            *by, F.col("_next").alias("_p"), F.col("_start").alias("_base"), "_total", "_reads"
        )
        counts = counts.join(known, [*by, "_p"])
        counts = counts.withColumn("_start", F.col("_start") + F.col("_base")).drop("_base")
    inside = F.filter(
        "_reads",
        lambda r: (r["pos"] >= F.col("_start")) & (r["pos"] < F.col("_start") + F.col("_c")),
    )
    return (
        counts.withColumn("_reads", inside)
        .where(F.size("_reads") > 0)
        .withColumn("_next", F.array_min("_reads.slot"))
    )


def _refine(
    cells: DataFrame, by: list[str], reads: list[Column], buckets: int, ordered: int
) -> tuple[DataFrame, DataFrame]:
    """(rows with their bucket, hit buckets) of the first level whose hit buckets are small.

    A level at least halves the range of a bucket with two values, so levels end."""
    rows = cells.withColumns({"_p": F.lit(0), "_b": _by_magnitude(cells, buckets)})
    above, size = None, None
    while True:
        hit = materialize(hit_buckets(rows, by, reads, above), "quantile-buckets")
        largest = hit.agg(F.max("_k")).first()[0] or 0
        if largest <= ordered or largest == size:
            return rows, hit
        kept = hit.select(*by, "_p", "_b", "_next", "_lo", "_hi")
        number = [F.col(c).cast("double") for c in ("_v", "_lo", "_hi")]
        rows = (
            rows.select(*by, "_p", "_b", "_v", "_m")
            .join(kept, [*by, "_p", "_b"])
            .select(*by, F.col("_next").alias("_p"), "_v", "_m", cut(*number, buckets).alias("_b"))
        )
        above, size = hit, largest


def reads_of(wanted: dict[str, float], rule: str) -> tuple[list[Column], dict[str, list[int]]]:
    """The positions to read, numbered, and the numbers each wanted quantile needs."""
    reads, slots = [], {}
    for name, q in wanted.items():
        slots[name] = []
        for pos in _ranks(rule, q, F.col("_total")):
            slots[name].append(len(reads))
            reads.append(F.struct(F.lit(len(reads)).alias("slot"), pos.alias("pos")))
    return reads, slots


def pick(
    rows: DataFrame,
    hit: DataFrame,
    by: list[str],
    wanted: dict[str, float],
    rule: str,
    slots: dict[str, list[int]],
) -> DataFrame:
    """Order the values of the hit buckets and read the wanted positions."""
    upto = (
        Window.partitionBy(*by, "_p", "_b")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        rows.select(*by, "_p", "_b", "_v", "_m")
        .join(hit.select(*by, "_p", "_b", "_start", "_total", "_reads"), [*by, "_p", "_b"])
        .withColumn("_end", F.col("_start") + F.sum("_m").over(upto))
        .withColumn(
            "_got",
            F.filter(
                "_reads",
                lambda r: (r["pos"] < F.col("_end"))
                & (r["pos"] >= F.col("_end") - F.col("_m")),
            ),
        )
        .where(F.size("_got") > 0)
        .select(*by, "_v", "_total", F.explode("_got.slot").alias("_slot"))
    )
    picks = [
        F.max(F.when(F.col("_slot") == i, F.col("_v"))).alias(f"_r{i}") for i in range(sum(map(len, slots.values())))
    ]
    picked = found.groupBy(*by).agg(*picks, F.max("_total").alias("_total"))
    out = []
    for name, q in wanted.items():
        ids = slots[name]
        if rule != "linear":
            out.append(F.col(f"_r{ids[0]}").alias(name))
            continue
        low, high = (F.col(f"_r{i}").cast("double") for i in ids)
        exact = (F.col("_total") - 1) * F.lit(float(q))
        out.append((low + (high - low) * (exact - F.floor(exact))).alias(name))
    return picked.select(*by, *out)


def quantiles(
    df: DataFrame,
    col: str,
    wanted: dict[str, float],
    by: Sequence[str] = (),
    rule: str = "nearest",
    weight: str | None = None,
    buckets: int = 4_096,
    bounds: tuple[float, float] | None = None,
    ordered: int = 65_536,
) -> DataFrame:
    """One row per group with a column per entry of ``wanted`` (name -> q).

    ``rule`` is the index rule: ``nearest`` reads ``round((n-1)q)``, ``floor`` reads
    ``floor(nq)``, ``linear`` interpolates between the neighbours of ``(n-1)q``.
    ``weight`` is a column of row multiplicities. Null values and rows with a null
    group key are left out. ``ordered`` bounds the different values that are put in
    order together. ``bounds`` may give the overall minimum and maximum of values that
    are known to be spread; then one level of equal width is planned without running a
    job (values outside stay correct).
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    by = list(by)
    present = F.col(col).isNotNull()
    for key in by:
        present = present & F.col(key).isNotNull()
    mass = F.col(weight) if weight else F.lit(1)
    base = df.where(present).select(*by, F.col(col).alias("_v"), mass.cast("long").alias("_m"))
    cells = base.groupBy(*by, "_v").agg(F.sum("_m").alias("_m"))

    reads, slots = reads_of(wanted, rule)
    if bounds is None:
        rows, hit = _refine(materialize(cells, "quantile-values"), by, reads, buckets, ordered)
    else:
        ends = [F.lit(float(b)) for b in bounds]
        place = cut(F.col("_v").cast("double"), *ends, buckets)
        rows = cells.withColumns({"_p": F.lit(0), "_b": place})
        hit = hit_buckets(rows, by, reads, None)

    return pick(rows, hit, by, wanted, rule, slots)


def quantile_nearest(
    df: DataFrame, col: str, q: float, by: Sequence[str] = (), name: str = "quantile", **kw
) -> DataFrame:
    return quantiles(df, col, {name: q}, by, "nearest", **kw)


def quantile_floor(
    df: DataFrame, col: str, wanted: dict[str, float], by: Sequence[str] = (), **kw
) -> DataFrame:
    return quantiles(df, col, wanted, by, "floor", **kw)
