"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Targets: sources share the words of the whole input in proportion to their weights, but no
source gets more than `cap` times its own words; what a source cannot take is shared again by
weight among the others. The solution is min(cap * size, weight * level) with one level for all;
it falls out of running totals over the sources in order of cap * size / weight.

Copies: with c = target / words of its source, document i of the source (ordered by size, then
id) is emitted floor(i*c + u) - floor((i-1)*c + u) times: once per integer that the running sum
of expected copies crosses, starting from one offset u per source. The order by size makes each
stretch of the sample carry its share of words. No document is taken more than ceil(cap) times.

The running number i needs no window over a source: rows are range-partitioned by (source, size,
id), written, and the start of each (partition, source) is a running total over one row per
partition and source. A source that holds a third of all rows spans a third of the partitions.

Cases: a null text has size 0 and a null source is a source of its own, last in order; rows of
size 0 take part (their copies weigh nothing); repeated rows are rows of their own; an empty
table gives an empty result; columns named like the ones added here are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.files import partitions_of
from clickloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
ROW = (1 << 33) - 1  # monotonically_increasing_id: partition number above these bits


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0
) -> DataFrame:
    """(source, source_size) -> the same with weight and target; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(cap))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level).withColumn(
        "full", F.col("limit") <= F.col("weight") * F.col("level")
    )
    first_open = F.min_by(
        F.when(~F.col("full"), F.col("level")),
        F.when(~F.col("full"), F.col("limit") / F.col("weight")),
    ).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * first_open)
    return rows.select("source", "source_size", "weight", target.alias("target"))


def offset(source: Column, seed: str) -> Column:
    """The source's random offset in [0, 1), in steps of 2**-20 so that sums stay exact."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("")))), 1, 5)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 20))


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3.0,
    seed: str = "mix:",
) -> DataFrame:
    """All rows and columns of `docs` with size, source_size, target, copies and taken."""
    size = word_count(F.col("text")) if size is None else size
    added = ["size", "source_size", "target", "copies", "taken"]
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(
        *(F.col(f"`{c}`") for c in kept), F.coalesce(size, F.lit(0)).cast("long").alias("size")
    )
    order = [F.col(source_col).asc_nulls_last(), F.col("size"), F.col(id_col)]
    placed = rows.repartitionByRange(partitions_of(docs), *order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_row", F.monotonically_increasing_id()), "mix")

    part = F.shiftright("_row", 33)
    starts = placed.groupBy(F.col(source_col).alias("source"), part.alias("_part")).agg(
        F.min("_row").alias("_first"),
        F.count("*").alias("_rows"),
        F.sum("size").alias("_words"),
    )
    totals = starts.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(totals, weights, cap).withColumnRenamed("source", "_source")
    before = Window.partitionBy("source").orderBy("_part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        "*", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    ).join(targets, F.col("source").eqNullSafe(F.col("_source")))
    share = F.when(
        F.col("source_size") > 0,
        F.least(F.col("target") / F.col("source_size"), F.lit(float(cap))),
    ).otherwise(0.0)
    starts = starts.select(
        F.col("_source").alias("_of"),
        F.col("_part").alias("_at"),
        F.col("_first"),
        F.col("_before"),
        "source_size",
        "target",
        share.alias("_share"),
        offset(F.col("_source"), seed).alias("_offset"),
    )
    number = F.col("_before") + (F.col("_row") - F.col("_first"))  # documents before this one
    reached = F.floor((number + 1) * F.col("_share") + F.col("_offset"))
    copies = reached - F.floor(number * F.col("_share") + F.col("_offset"))
    joined = placed.join(
        starts, F.col(source_col).eqNullSafe(F.col("_of")) & (part == F.col("_at"))
    )
    return joined.select(
        *(F.col(f"`{c}`") for c in kept),
        "size",
        "source_size",
        F.coalesce(F.col("target"), F.lit(0.0)).alias("target"),
        copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def emit_copies(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3.0,
    seed: str = "mix:",
) -> DataFrame:
    """The mix itself: the rows and columns of `docs`, each row as often as it is taken."""
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("words"),
    )
    mixed = mix_sources(
        rows, id_col="id", size=F.col("words"), weights=weights, cap=cap, seed=seed
    )
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.where(F.col("copies") > 0).select("row", times.alias("copy")).select("row.*")
