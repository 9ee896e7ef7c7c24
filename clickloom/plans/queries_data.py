"""Queries over sources, cleaning, targets, splits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.columns import micros
from clickloom.operators import cleaning, counters, histories, ranking, setops, splits, targets
from clickloom.plans.registry import query, sql, tidy
from clickloom.session import scratch_path
from clickloom.sources import adapters, events, factors, layers
from clickloom.vocab import BINARY_LABELS, SEQUENCE_WEIGHTS

EVENT = "event_id, user_id, item_id, day"
ROW = ["event_id", "user_id", "item_id", "day"]


def _stored(spark, root):
    """Interactions as a day-partitioned table in the shared folder."""
    path = scratch_path(spark, "events")
    return layers.write_layer(adapters.interactions(spark, root), path)


@query(
    "read_events",
    sql(
        f"SELECT {EVENT} FROM interactions WHERE day BETWEEN 19727 AND 19741",
        "interactions",
    ),
)
def _(spark, root):
    return events.read_events(spark, _stored(spark, root), 19727, 19741).select(*ROW)


@query(
    "day_from_file",
    sql("SELECT day, count(*) AS n FROM interactions GROUP BY day", "interactions"),
)
def _(spark, root):
    # Flat files named by their day, without a column that says so.
    folder = scratch_path(spark, "daily")
    seen = adapters.interactions(spark, root).select("event_id", "user_id", "day")
    events.write_day_files(seen, folder)
    return events.read_events(spark, folder).groupBy("day").agg(F.count("*").alias("n"))


@query(
    "day_from_ts",
    "SELECT event_id, CAST(epoch_us(ts) // 86400000000 AS INTEGER) AS day FROM events",
)
def _(spark, root):
    stamped = adapters.table(spark, root, "events").select("event_id", micros("ts").alias("us"))
    return events.with_day_from_ts(stamped, "us").select("event_id", "day")


@query(
    "resolve_day_range",
    sql(
        "SELECT 'both' AS missing, min(day) AS day_from, max(day) AS day_to FROM interactions UNION ALL "
        "SELECT 'first', min(day), 19750 FROM interactions UNION ALL SELECT 'last', 19740, max(day) "
        "FROM interactions UNION ALL SELECT 'none', 1, 2",
        "interactions",
    ),
)
def _(spark, root):
    seen = adapters.interactions(spark, root)
    asked = {"both": (None, None), "first": (None, 19750), "last": (19740, None), "none": (1, 2)}
    rows = [(name, *events.resolve_day_range(seen, *given)) for name, given in asked.items()]
    return spark.createDataFrame(rows, "missing string, day_from int, day_to int")


@query(
    "last_n_days",
    sql(
        f"SELECT {EVENT} FROM interactions_wide WHERE day IN "
        "(SELECT DISTINCT day FROM interactions_wide ORDER BY day DESC LIMIT 30)",
        "interactions_wide",
    ),
)
def _(spark, root):
    return events.last_n_days(adapters.interactions_wide(spark, root), 30).select(*ROW)


@query(
    "last_fraction_of_days",
    sql(
        f"SELECT {EVENT} FROM interactions_wide WHERE day >= (SELECT max(day) + 1 - "
        "greatest(CAST(floor((max(day) - min(day) + 1) * 0.05) AS BIGINT), 1) "
        "FROM interactions_wide)",
        "interactions_wide",
    ),
)
def _(spark, root):
    wide = adapters.interactions_wide(spark, root)
    return events.last_fraction_of_days(wide, 0.05).select(*ROW)


def _most_active(key: str, n: int) -> str:
    return (
        f"SELECT {key} FROM interactions WHERE day > (SELECT max(day) - 10 FROM interactions) "
        f"GROUP BY 1 ORDER BY count(*) DESC, {key} LIMIT {n}"
    )


TOP = {"top_users": _most_active("user_id", 60), "top_items": _most_active("item_id", 40)}


def _selected(spark, root):
    return counters.select_top_entities(adapters.interactions(spark, root), 10, 60, 40)


@query(
    "write_raw_layer",
    sql(
        f"SELECT {EVENT}, action_type FROM interactions WHERE action_type IS NOT NULL "
        "AND user_id IN (FROM top_users) AND item_id IN (FROM top_items)",
        "interactions",
        extra=TOP,
    ),
)
def _(spark, root):
    users, items = _selected(spark, root)
    path = scratch_path(spark, "raw")
    layers.write_raw_layer(adapters.interactions(spark, root), path, users, items)
    return layers.read_layer(spark, path).select(*ROW, "action_type")


@query(
    "write_layer",
    sql(f"SELECT {EVENT} FROM interactions", "interactions"),
)
def _(spark, root):
    # Written twice: a re-run replaces the days it produces and doubles nothing.
    path = _stored(spark, root)
    again = adapters.interactions(spark, root)
    layers.write_layer(events.last_n_days(again, 3), path)
    return layers.read_layer(spark, path).select(*ROW)


@query(
    "id_lists",
    sql(
        f"SELECT {EVENT} FROM interactions WHERE user_id IN (FROM top_users)",
        "interactions",
        extra=TOP,
    ),
)
def _(spark, root):
    users, _items = _selected(spark, root)
    path = layers.write_id_list(users, scratch_path(spark, "ids"), "user_id")
    ids = layers.read_id_list(spark, path, "user_id")
    return cleaning.filter_selected(adapters.interactions(spark, root), ids).select(*ROW)


def action_factors(spark, root):
    """Whole-number vectors: how often a user (an item) had each action."""
    seen = adapters.interactions(spark, root)
    actions = ["view", "click", "clickout", "like"]
    counts = F.array(*[F.count_if(F.col("action_type") == a).cast("double") for a in actions])
    return (
        seen.groupBy("user_id").agg(counts.alias("features")),
        seen.groupBy("item_id").agg(counts.alias("features")),
    )


COUNTS = ", ".join(
    f"CAST(count(*) FILTER (action_type = '{a}') AS DOUBLE)"
    for a in ("view", "click", "clickout", "like")
)


@query(
    "saved_factors",
    sql(
        "SELECT 'user' AS side, user_id AS id, array_to_string(list_transform("
        f"[{COUNTS}], lambda x: CAST(x * 1000 AS BIGINT)), ',') AS features FROM interactions GROUP BY 2 "
        "UNION ALL SELECT 'item', item_id, array_to_string(list_transform("
        f"[{COUNTS}], lambda x: CAST(x * 1000 AS BIGINT)), ',') FROM interactions GROUP BY 2",
        "interactions",
    ),
)
def _(spark, root):
    path = factors.save_factors(*action_factors(spark, root), scratch_path(spark, "factors"))
    users, items = factors.load_factors(spark, path)
    both = users.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), "features")
    return tidy(
        both.union(items.select(F.lit("item"), F.col("item_id"), "features"))
    )


@query(
    "fill_codes",
    sql(
        "SELECT user_id, CAST(coalesce(socdem_cluster, -1) AS INTEGER) AS socdem_cluster, "
        "CAST(coalesce(region, -1) AS INTEGER) AS region FROM users",
        "users",
    ),
)
def _(spark, root):
    return cleaning.fill_codes(adapters.users(spark, root), ["socdem_cluster", "region"])


@query(
    "fill_unknown",
    sql(
        "SELECT item_id, coalesce(category, 'unknown') AS category, "
        "coalesce(subcategory, 'unknown') AS subcategory, coalesce(brand_id, -1) AS brand_id "
        "FROM items",
        "items",
    ),
)
def _(spark, root):
    filled = cleaning.fill_unknown(
        adapters.items(spark, root), ["category", "subcategory"], "brand_id"
    )
    return filled.select("item_id", "category", "subcategory", "brand_id")


@query(
    "impute_median",
    sql(
        "SELECT item_id, round(coalesce(price, (SELECT median(price) FROM items)), 6) AS price "
        "FROM items",
        "items",
    ),
)
def _(spark, root):
    return tidy(cleaning.impute_median(adapters.items(spark, root), "price").select("item_id", "price"))


@query(
    "drop_null",
    sql(
        "SELECT item_id, round(price, 6) AS price, category FROM items "
        "WHERE price IS NOT NULL AND category IS NOT NULL",
        "items",
    ),
)
def _(spark, root):
    kept = cleaning.drop_null(adapters.items(spark, root), ["price", "category"])
    return tidy(kept.select("item_id", "price", "category"))


@query(
    "filter_actions",
    sql(
        f"SELECT {EVENT}, action_type FROM interactions WHERE action_type IN ('click', 'like')",
        "interactions",
    ),
)
def _(spark, root):
    kept = cleaning.filter_actions(adapters.interactions(spark, root), ["click", "like"])
    return kept.select(*ROW, "action_type")


@query(
    "filter_selected",
    sql(
        f"SELECT {EVENT} FROM interactions WHERE user_id IN (FROM top_users) "
        "AND item_id IN (FROM top_items)",
        "interactions",
        extra=TOP,
    ),
)
def _(spark, root):
    users, items = _selected(spark, root)
    kept = cleaning.filter_selected(adapters.interactions(spark, root), users, items)
    return kept.select(*ROW)


@query(
    "compact_dtypes",
    sql("SELECT item_id, CAST(price AS FLOAT) AS price FROM items", "items"),
)
def _(spark, root):
    return cleaning.compact_dtypes(adapters.items(spark, root).select("item_id", "price"))


@query(
    "rename_attributes",
    sql(
        "SELECT item_id, CAST(brand_id AS VARCHAR) AS f_cat__brand_id, category AS f_cat__category, "
        "subcategory AS f_cat__subcategory, round(price, 6) AS f_num__price FROM items",
        "items",
    ),
)
def _(spark, root):
    renamed = cleaning.rename_attributes(adapters.items(spark, root), "item_id")
    return tidy(cleaning.to_category(renamed, ["f_cat__brand_id"]))


@query(
    "to_category",
    sql(
        "SELECT user_id, CAST(socdem_cluster AS VARCHAR) AS socdem_cluster, "
        "CAST(region AS VARCHAR) AS region FROM users",
        "users",
    ),
)
def _(spark, root):
    return cleaning.to_category(adapters.users(spark, root), ["socdem_cluster", "region"])


@query(
    "shift_epoch",
    "SELECT event_id, epoch_us(ts) - (SELECT min(epoch_us(ts)) // 86400000000 * 86400000000 "
    "FROM events) + epoch_us(TIMESTAMP '2025-01-01 00:00:00') AS shifted FROM events",
)
def _(spark, root):
    stamped = adapters.table(spark, root, "events").select("event_id", micros("ts").alias("ts_us"))
    return tidy(cleaning.shift_epoch(stamped, "2025-01-01").select("event_id", "shifted"))


@query(
    "binary_label",
    sql(
        "SELECT event_id, CASE WHEN action_type = 'view' THEN 0 WHEN action_type IS NOT NULL "
        "THEN 1 END AS label FROM interactions",
        "interactions",
    ),
)
def _(spark, root):
    labelled = cleaning.binary_label(adapters.interactions(spark, root), BINARY_LABELS)
    return labelled.select("event_id", "label")


@query(
    "map_action_weight",
    sql(
        "SELECT event_id, CASE action_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.0 "
        "WHEN 'like' THEN 3.0 WHEN 'clickout' THEN 4.0 END::DOUBLE AS weight FROM interactions",
        "interactions",
    ),
)
def _(spark, root):
    weighted = cleaning.map_action_weight(adapters.interactions(spark, root), SEQUENCE_WEIGHTS)
    return weighted.select("event_id", "weight")


@query(
    "sample_users",
    sql(
        f"SELECT {EVENT} FROM interactions WHERE CAST('0x' || substr(md5('42|' || "
        "CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 4000",
        "interactions",
    ),
)
def _(spark, root):
    return cleaning.sample_users(adapters.interactions(spark, root), 0.4, 42).select(*ROW)


@query(
    "filter_top_items",
    sql(
        f"SELECT {EVENT} FROM interactions_wide WHERE item_id IN (SELECT item_id "
        "FROM interactions_wide GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 500)",
        "interactions_wide",
    ),
)
def _(spark, root):
    return cleaning.filter_top_items(adapters.interactions_wide(spark, root), 500).select(*ROW)


for _kind, _source in (
    ("log_target", "log_target"),
    ("sqrt_target", "sqrt_target"),
    ("unproccessed", "target"),
):

    @query(
        f"create_target_{_kind}",
        sql(
            f"SELECT event_id, CAST(len AS BIGINT) AS len, round({_source}, 6) AS target FROM targeted",
            "targeted",
        ),
    )
    def _(spark, root, kind=_kind):
        made = targets.create_target(adapters.interactions(spark, root), kind)
        return tidy(made.select("event_id", "len", "target"))


@query(
    "create_target_multiclass",
    sql(
        "SELECT event_id, CAST(len AS BIGINT) AS len, "
        + ", ".join(
            f"CAST(action_type = '{a}' AS TINYINT) AS target_{a}"
            for a in ("view", "clickout", "like", "click")
        )
        + " FROM targeted",
        "targeted",
    ),
)
def _(spark, root):
    made = targets.create_target(adapters.interactions(spark, root), "multiclass")
    return made.select("event_id", "len", *targets.MULTICLASS_COLUMNS)


@query(
    "all_targets",
    sql(
        "SELECT event_id, round(target, 6) AS target, round(log_target, 6) AS log_target, "
        "round(sqrt_target, 6) AS sqrt_target FROM targeted",
        "targeted",
    ),
)
def _(spark, root):
    made = targets.all_targets(adapters.interactions(spark, root))
    return tidy(made.select("event_id", "target", "log_target", "sqrt_target"))


@query(
    "log_weight_target",
    sql("SELECT event_id, round(log_weight, 6) AS target FROM targeted", "targeted"),
)
def _(spark, root):
    made = targets.log_weight_target(adapters.interactions(spark, root))
    return tidy(made.select("event_id", "target"))


@query(
    "action_target_mapping",
    sql("SELECT DISTINCT action_type, round(log_target, 6) AS target FROM targeted", "targeted"),
)
def _(spark, root):
    return tidy(targets.action_target_mapping(adapters.interactions(spark, root)))


def _parts(pair, *cols):
    """Both sides of a split in one frame."""
    return concat_named({"train": pair[0], "test": pair[1]}, *cols)


def concat_named(frames, *cols):
    return setops.concat_vertical(
        *(df.select(F.lit(name).alias("part"), *cols) for name, df in frames.items())
    )


@query(
    "global_temporal_split",
    sql(
        "SELECT CASE WHEN day < cut THEN 'train' ELSE 'test' END AS part, event_id FROM interactions, "
        "(SELECT max(day) - CAST(floor((max(day) - min(day) + 1) * 0.2) AS BIGINT) AS cut "
        "FROM interactions) WHERE day <> cut",
        "interactions",
    ),
)
def _(spark, root):
    return _parts(splits.global_temporal_split(adapters.interactions(spark, root), 0.2), "event_id")


@query(
    "timestamp_fraction_split",
    sql(
        "SELECT CASE WHEN epoch_us(ts) < cut THEN 'train' ELSE 'test' END AS part, event_id "
        "FROM interactions, (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) "
        "* CAST(0.8 AS DOUBLE) AS cut FROM interactions)",
        "interactions",
    ),
)
def _(spark, root):
    return _parts(
        splits.timestamp_fraction_split(adapters.interactions(spark, root), 0.2), "event_id"
    )


@query(
    "timestamp_quantile_split",
    sql(
        "SELECT CASE WHEN us < cut THEN 'train' ELSE 'test' END AS part, event_id FROM "
        "(SELECT event_id, epoch_us(ts) AS us FROM interactions), "
        "(SELECT max(CASE WHEN rn - 1 = CAST(round((n - 1) * CAST(0.8 AS DOUBLE)) AS BIGINT) "
        "THEN us END) AS cut FROM (SELECT epoch_us(ts) AS us, row_number() OVER (ORDER BY ts) AS rn, "
        "count(*) OVER () AS n FROM interactions))",
        "interactions",
    ),
)
def _(spark, root):
    return _parts(
        splits.timestamp_quantile_split(adapters.interactions(spark, root), 0.8), "event_id"
    )


@query(
    "validation_split",
    sql(
        "SELECT CASE WHEN last_day < start THEN 'train' ELSE 'test' END AS part, user_id, item_id "
        "FROM (SELECT user_id, item_id, max(day) AS last_day FROM interactions GROUP BY 1, 2), "
        "(SELECT max(d) - greatest(CAST(floor((max(d) - min(d) + 1) * 0.1) AS BIGINT), 1) + 1 AS start "
        "FROM (SELECT max(day) AS d FROM interactions GROUP BY user_id, item_id))",
        "interactions",
    ),
)
def _(spark, root):
    pairs = (
        adapters.interactions(spark, root)
        .groupBy("user_id", "item_id")
        .agg(F.max("day").alias("last_day"))
    )
    return _parts(splits.validation_split(pairs), "user_id", "item_id")


@query(
    "split_cold_start",
    sql(
        "SELECT CASE WHEN t.user_id IN (SELECT user_id FROM interactions_wide WHERE day < cut) "
        "OR t.user_id IS NULL THEN 'warm' ELSE 'cold' END AS part, event_id "
        "FROM interactions_wide t, (SELECT max(day) - 2200 AS cut FROM interactions_wide) "
        "WHERE day > cut",
        "interactions_wide",
    ),
)
def _(spark, root):
    train, test = splits.global_temporal_split(adapters.interactions_wide(spark, root), 2200)
    cold, warm = splits.split_cold_start(train, test)
    return concat_named({"cold": cold, "warm": warm}, "event_id")


@query(
    "concat_vertical",
    sql(
        "SELECT event_id, user_id, item_id FROM interactions UNION ALL "
        "SELECT event_id, user_id, item_id FROM interactions_wide",
        "interactions",
        "interactions_wide",
    ),
)
def _(spark, root):
    frames = (adapters.interactions(spark, root), adapters.interactions_wide(spark, root))
    return setops.concat_vertical(*(f.select("event_id", "user_id", "item_id") for f in frames))


@query(
    "concat_diagonal",
    sql(
        "SELECT user_id AS id, CAST(socdem_cluster AS VARCHAR) AS socdem_cluster, NULL AS category "
        "FROM users UNION ALL SELECT item_id, NULL, category FROM items",
        "users",
        "items",
    ),
)
def _(spark, root):
    people = adapters.users(spark, root).select(
        F.col("user_id").alias("id"), F.col("socdem_cluster").cast("string").alias("socdem_cluster")
    )
    goods = adapters.items(spark, root).select(F.col("item_id").alias("id"), "category")
    return setops.concat_diagonal(people, goods)


@query(
    "acted_without_view",
    sql(
        "SELECT DISTINCT visit AS user_id FROM visits WHERE action_type IN "
        "('click', 'clickout', 'like') EXCEPT SELECT visit FROM visits WHERE action_type = 'view'",
        "interactions",
        extra={"visits": "SELECT user_id * 100000 + day AS visit, action_type FROM interactions"},
    ),
)
def _(spark, root):
    # Every user on every day counts as a user of its own.
    seen = adapters.interactions(spark, root)
    visit = (F.col("user_id") * 100_000 + F.col("day")).cast("bigint")
    return setops.acted_without_view(seen.withColumn("user_id", visit))


@query(
    "unique_by",
    sql(
        "SELECT user_id, item_id, event_id, day FROM (SELECT *, row_number() OVER "
        "(PARTITION BY user_id, item_id ORDER BY ts, event_id) AS rn FROM interactions) WHERE rn = 1",
        "interactions",
    ),
)
def _(spark, root):
    slim = adapters.interactions(spark, root).select("user_id", "item_id", "event_id", "day", "ts")
    first = setops.unique_by(slim, ["user_id", "item_id"], [F.col("ts"), F.col("event_id")])
    return first.select("user_id", "item_id", "event_id", "day")


@query(
    "list_intersection",
    sql(
        "SELECT a.user_id, count(*) AS common FROM "
        "(SELECT DISTINCT user_id, item_id FROM train) a JOIN "
        "(SELECT DISTINCT user_id, item_id FROM test) b USING (user_id, item_id) GROUP BY 1",
        "train",
        "test",
    ),
)
def _(spark, root):
    made = targets.create_target(adapters.interactions(spark, root))
    train, test = splits.global_temporal_split(made, 5)
    a, b = (
        df.groupBy("user_id").agg(F.collect_set("item_id").alias(name))
        for df, name in ((train, "a"), (test, "b"))
    )
    common = a.join(b, "user_id").select(
        "user_id", F.size(F.array_intersect("a", "b")).cast("bigint").alias("common")
    )
    return common.where(F.col("common") > 0)


@query(
    "dense_index",
    sql(
        "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_id_idx FROM "
        "(SELECT DISTINCT user_id FROM interactions_wide)",
        "interactions_wide",
    ),
)
def _(spark, root):
    return ranking.dense_index(adapters.interactions_wide(spark, root), "user_id")


@query(
    "min_interactions_events",
    sql(
        f"SELECT {EVENT} FROM interactions_wide WHERE user_id IN (SELECT user_id FROM "
        "interactions_wide GROUP BY 1 HAVING count(*) >= 32) AND item_id IN (SELECT item_id FROM "
        "interactions_wide GROUP BY 1 HAVING count(*) >= 32)",
        "interactions_wide",
    ),
)
def _(spark, root):
    kept = histories.min_interactions_events(adapters.interactions_wide(spark, root), 32)
    return kept.select(*ROW)
