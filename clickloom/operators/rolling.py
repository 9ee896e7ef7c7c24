"""Rolling-window features over daily pair counters, for any grouping of entities.

Shape of the plan, per feature group:

1. partial sums per (keys, day): map-side combine leaves at most one row per key and
   day, however hot the key;
2. one shuffle of those partials on the keys;
3. in that partitioning, a window changes on the days a partial enters it and on the
   days one leaves it. Counters are running sums of what enters less what leaves, price
   statistics come from a frame over the last days; between two changes the result
   stands still and is repeated per snapshot day at the very end. Rows that are shuffled
   and sorted do not grow with the length of the window; the price frames read each of
   their rows anew on every day of change.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import feature_name
from clickloom.operators.cleaning import compact_dtypes
from clickloom.operators.quantiles import cut, hit_buckets, pick, reads_of
from clickloom.session import cut_lineage, materialize
from clickloom.vocab import FEATURE_GROUPS, ITEM_KEYS, USER_KEYS


def check_group(keys: Sequence[str | None]) -> list[str]:
    """Drop the unused side; at least one known key must remain."""
    kept = [k for k in keys if k is not None]
    unknown = [k for k in kept if k not in USER_KEYS + ITEM_KEYS]
    if not kept or unknown:
        raise ValueError(f"feature group needs user or item keys, got {list(keys)}")
    return kept


def enrich_aggs(
    aggs: DataFrame,
    users: DataFrame | None,
    items: DataFrame,
    groups: Sequence[Sequence[str | None]] = tuple(FEATURE_GROUPS),
) -> DataFrame:
    """Daily counters with the price and the attributes the groups are keyed by."""
    wanted = {k for g in groups for k in check_group(g)}
    item_side = ["price", *(k for k in ITEM_KEYS if k in wanted and k != "item_id")]
    out = aggs.join(items.select("item_id", *item_side), "item_id", "left")
    user_side = [k for k in USER_KEYS if k in wanted and k != "user_id"]
    if user_side:
        out = out.join(users.select("user_id", *user_side), "user_id", "left")
    return out


def counters_of(aggs: DataFrame) -> list[str]:
    """The counter columns of a layer, whatever actions and subdomains it was made with."""
    return [c for c in aggs.columns if c.startswith("num_")]


@dataclass(frozen=True)
class WindowFacts:
    """What every group of one run shares: stored days, price range, counters in use."""

    first: int
    last: int
    price: tuple[float, float] | None
    present: DataFrame


def window_facts(enriched: DataFrame, counters: Sequence[str]) -> WindowFacts:
    """One pass over the counters: what is seen per day; the bounds come from these few rows."""
    days = cut_lineage(
        enriched.groupBy("day").agg(
            *(F.expr(f"coalesce(max(`{c}` > 0), false) AS `_has_{c}`") for c in counters),
            F.min("price").alias("_low"),
            F.max("price").alias("_high"),
        )
    )
    first, last, low, high = days.agg(
        F.min("day"), F.max("day"), F.min("_low"), F.max("_high")
    ).first()
    if first is None:
        raise FileNotFoundError("no stored days")
    price = None if low is None else (low, high)
    return WindowFacts(first, last, price, days.drop("_low", "_high"))


def _fan_out(df: DataFrame, num_days: int, first: int, last: int, clip: bool) -> DataFrame:
    """Repeat each day's row for every snapshot day whose window contains it."""
    start = F.greatest(F.col("day"), F.lit(first))
    end = F.least(F.col("day") + F.lit(num_days - 1), F.lit(last))
    seen = start <= end
    if clip:
        seen = seen & (F.col("day") >= first)
    return df.where(seen).withColumn("_snap", F.explode(F.sequence(start, end)))


def _changes(df: DataFrame, num_days: int, first: int, last: int, clip: bool) -> DataFrame:
    """Each row on the day ``_at`` it enters the window (``_sign`` 1) and on the one it leaves (-1)."""
    from_day = first if clip else first - num_days + 1
    leaves = F.when(
        F.col("day") + F.lit(num_days) <= F.lit(last),
        F.struct((F.col("day") + F.lit(num_days)).alias("at"), F.lit(-1).alias("sign")),
    )
    enters = F.struct(F.col("day").alias("at"), F.lit(1).alias("sign"))
    return (
        df.where((F.col("day") >= from_day) & (F.col("day") <= last))
        .withColumn("_change", F.explode(F.array_compact(F.array(enters, leaves))))
        .withColumns({"_at": F.col("_change.at"), "_sign": F.col("_change.sign")})
        .drop("_change")
    )


def _standing(
    df: DataFrame, keys: list[str], num_days: int, first: int, last: int, stats: dict[str, Column]
) -> DataFrame:
    """Window statistics per keys and range of snapshot days, from rows made by :func:`_changes`.

    ``stats`` are columns over the windows of :func:`_frames`. Rows of one day see the same
    frame, so the last of them stands for the day and the days up to the next change: the
    snapshot days ``_from`` to ``_to``.
    """
    ordered = Window.partitionBy(*keys).orderBy("_at")
    running, _ = _frames(keys, num_days)
    inside = F.sum("_sign").over(running)
    seen = df.select(
        *keys, "_at", F.lead("_at").over(ordered).alias("_next"), inside.alias("_inside"),
        *(c.alias(n) for n, c in stats.items()),
    )
    start = F.greatest(F.col("_at"), F.lit(first))
    end = F.least(F.coalesce(F.col("_next") - 1, F.lit(last)), F.lit(last))
    ranges = seen.where((F.col("_inside") > 0) & (start <= end))
    return ranges.withColumns({"_from": start.cast("int"), "_to": end.cast("int")}).drop(
        "_at", "_next", "_inside"
    )


def each_day(ranges: DataFrame, name: str = "day") -> DataFrame:
    """A row per snapshot day from rows that stand for the days ``_from`` to ``_to``."""
    return ranges.withColumn(name, F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")


def _frames(keys: list[str], num_days: int) -> tuple[Window, Window]:
    """(everything up to the day, the last ``num_days`` days), rows of the same day included."""
    ordered = Window.partitionBy(*keys).orderBy("_at")
    return (
        ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow),
        ordered.rangeBetween(1 - num_days, Window.currentRow),
    )


def _spread_medians(
    freq: DataFrame,
    keys: list[str],
    name: str,
    window: tuple[int, int, int, bool],
    bounds: tuple[float, float],
) -> DataFrame:
    """Medians of groups too large for one task, from price frequencies per (keys, day).

    Only counts per price bucket are repeated for the days of the window; of the prices, those in
    the bucket that holds a middle rank.
    """
    num_days, first, last, clip = window
    by = [*keys, "_snap"]
    reads, slots = reads_of({name: 0.5}, "linear")
    place = cut(F.col("price").cast("double"), *(F.lit(float(b)) for b in bounds), 256)
    placed = freq.withColumns({"_p": F.lit(0), "_b": place})
    counts = placed.groupBy(*keys, "day", "_p", "_b").agg(F.sum("_m").alias("_m"))
    days = _fan_out(counts, num_days, first, last, clip).withColumn("_v", F.lit(0))
    hit = hit_buckets(days, by, reads, None)
    ranked = placed.join(hit.select(*by, "_p", "_b"), [*keys, "_p", "_b"]).where(
        F.col("day").between(F.col("_snap") - (num_days - 1), F.col("_snap"))
    )
    if clip:
        ranked = ranked.where(F.col("day") >= first)
    rows = ranked.groupBy(*by, "_p", "_b", F.col("price").alias("_v")).agg(F.sum("_m").alias("_m"))
    return pick(rows, hit, by, {name: 0.5}, "linear", slots)


def rolling_features(
    enriched: DataFrame,
    keys: Sequence[str | None],
    num_days: int = 30,
    day_from: int | None = None,
    day_to: int | None = None,
    absent_day: str = "null",
    clip_to_range: bool = False,
    counters: Sequence[str] | None = None,
    facts: WindowFacts | None = None,
    ranges: bool = False,
) -> DataFrame:
    """Mean and sum of every counter and price statistics per (keys, snapshot day).

    The snapshot of day D covers ``[D - num_days + 1, D]``; groups with a null key
    vanish. ``absent_day="null"`` leaves a counter out of the mean on days on which
    nobody has it; ``"zero"`` counts such days as zeros. ``clip_to_range`` ignores
    days before ``day_from`` instead of looking back over everything stored. With ``ranges``, a
    row of a group with a user stands for the days ``_from`` to ``_to`` on which it does not
    change, instead of one ``day``; :func:`each_day` makes the same rows of it.
    """
    keys = check_group(keys)
    ranges = ranges and "user_id" in keys
    counters = counters_of(enriched) if counters is None else list(counters)
    facts = facts or window_facts(enriched, counters)
    first = facts.first if day_from is None else day_from
    last = facts.last if day_to is None else day_to

    rows = enriched
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    priced = F.col("price").isNotNull().cast("long")
    if set(keys) == {"user_id", "item_id"}:
        # The counter layer already has one row per (day, user, item).
        partials = rows.select(
            *keys,
            "day",
            *(f"`{c}`" for c in counters),
            F.lit(1).cast("long").alias("_n"),
            F.col("price").alias("_ps"),
            priced.alias("_pn"),
            F.col("price").alias("_lo"),
            F.col("price").alias("_hi"),
        )
    else:
        partials = rows.groupBy(*keys, "day").agg(
            *(F.expr(f"sum(`{c}`) AS `{c}`") for c in counters),
            F.count("*").alias("_n"),
            F.sum("price").alias("_ps"),
            F.sum(priced).alias("_pn"),
            F.min("price").alias("_lo"),
            F.max("price").alias("_hi"),
        )

    window = (num_days, first, last, clip_to_range)
    partials = partials.repartition(*keys)
    counted = {c: "_n" for c in counters}
    if absent_day == "null":
        # One row per stored day bounds this broadcast.
        partials = partials.join(F.broadcast(facts.present), "day")
        counted = {c: f"if(`_has_{c}`, _n, 0)" for c in counters}

    def name(stat: str) -> str:
        return feature_name(stat, keys, num_days)

    running, frame = _frames(keys, num_days)

    def total(value: str) -> Column:
        return F.sum(F.expr(f"_sign * {value}")).over(running)

    def framed(aggregate, col: str) -> Column:
        return aggregate(F.when(F.col("_sign") > 0, F.col(col))).over(frame)

    sums = {c: total(f"`{c}`") for c in counters}
    stats = {name(f"sum_{c}"): sums[c] for c in counters}
    stats |= {name(f"mean_{c}"): F.try_divide(sums[c], total(counted[c])) for c in counters}
    stats |= {
        name("mean_price"): F.try_divide(framed(F.sum, "_ps"), framed(F.sum, "_pn")),
        name("min_price"): framed(F.min, "_lo"),
        name("max_price"): framed(F.max, "_hi"),
    }
    stats = _standing(_changes(partials, *window), keys, num_days, first, last, stats)

    median = name("median_price")
    if "item_id" in keys:
        # An item has one price, so all rows of the group carry it.
        stats = stats.withColumn(median, F.col(name("max_price")))
        if not ranges:
            stats = each_day(stats, "_snap")
    else:
        freq = (
            rows.where(F.col("price").isNotNull())
            .groupBy(*keys, "day", "price")
            .agg(F.count("*").alias("_m"))
        )
        if not ranges:
            stats = each_day(stats, "_snap")
        if "user_id" in keys:
            # Many small groups: frequencies move once, by key; window and exact median follow
            # in the same partitioning.
            moves = _changes(freq.repartition(*keys), *window)
            weight = F.when(F.col("_sign") > 0, F.col("_m")).otherwise(F.lit(0))
            middle = {median: F.percentile("price", 0.5, weight).over(frame)}
            middle = _standing(moves, keys, num_days, first, last, middle)
            if not ranges:
                middle = each_day(middle, "_snap")
        else:
            middle = _spread_medians(freq, keys, median, window, facts.price or (0.0, 0.0))
        if ranges:
            # A priced row is also a counted one, so the median stands still while the counters do.
            middle = middle.withColumnsRenamed({c: f"_m_{c}" for c in (*keys, "_from", "_to")})
            same = [F.col(k) == F.col(f"_m_{k}") for k in keys]
            inside = (F.col("_m__from") <= F.col("_from")) & (F.col("_to") <= F.col("_m__to"))
            stats = stats.join(middle, [*same, inside], "left")
        else:
            stats = stats.join(middle, [*keys, "_snap"], "left")
    ordered = [
        *(name(f"mean_{c}") for c in counters),
        *(name(f"{s}_price") for s in ("mean", "median", "min", "max")),
        *(name(f"sum_{c}") for c in counters),
    ]
    days = ["_from", "_to"] if ranges else [F.col("_snap").alias("day")]
    return compact_dtypes(stats.select(*keys, *days, *(f"`{c}`" for c in ordered)))


def rolling_price_stats(
    enriched: DataFrame, keys: Sequence[str | None], num_days: int = 30, **kw
) -> DataFrame:
    """Only the four price statistics of :func:`rolling_features`."""
    kept = check_group(keys)
    return rolling_features(enriched, keys, num_days, counters=[], **kw).select(
        *kept,
        "day",
        *(feature_name(f"{s}_price", kept, num_days) for s in ("mean", "median", "min", "max")),
    )


def build_feature_layer(
    aggs: DataFrame,
    users: DataFrame | None,
    items: DataFrame,
    num_days: int = 30,
    groups: Sequence[Sequence[str | None]] = tuple(FEATURE_GROUPS),
    **kw,
) -> dict[tuple[str, ...], DataFrame]:
    """Features of every group over the same counters.

    The attribute-enriched counters are written once to the shared folder; each group
    then reads just the columns it needs.
    """
    enriched = materialize(enrich_aggs(aggs, users, items, groups), "enriched")
    counters = kw.get("counters")
    facts = window_facts(enriched, counters_of(enriched) if counters is None else counters)
    return {
        tuple(check_group(g)): rolling_features(enriched, g, num_days, facts=facts, **kw)
        for g in groups
    }
