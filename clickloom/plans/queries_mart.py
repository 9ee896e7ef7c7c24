"""Queries over counters, rolling features, basis, training set and histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.columns import feature_name
from clickloom.operators import assemble, basis, counters, histories, profiling, ranking, splits, targets
from clickloom.operators.quantiles import quantile_nearest
from clickloom.operators.rolling import (
    build_feature_layer,
    enrich_aggs,
    rolling_features,
    rolling_price_stats,
)
from clickloom.plans.mart import run_mart
from clickloom.plans.registry import query, sql, tidy
from clickloom.session import materialize, scratch_path
from clickloom.sources import adapters
from clickloom.vocab import ACTIONS, FEATURE_GROUPS, SUBDOMAINS

WINDOW = 30
GROUPS = list(FEATURE_GROUPS)


def _counters_of(spark, root):
    return counters.daily_pair_counters(adapters.interactions(spark, root))


def _targeted(spark, root, kind="log_target"):
    return targets.create_target(adapters.interactions(spark, root), kind)


def _split(spark, root, days=5):
    return splits.global_temporal_split(_targeted(spark, root), days)


@query(
    "action_counts",
    sql("SELECT action_type, count(*) AS len FROM interactions GROUP BY 1", "interactions"),
)
def _(spark, root):
    return counters.action_counts(adapters.interactions(spark, root))


@query(
    "select_top_entities",
    sql(
        "(SELECT 'user' AS side, user_id AS id FROM interactions_wide WHERE day > (SELECT max(day) - "
        "300 FROM interactions_wide) GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 200) UNION ALL "
        "(SELECT 'item', item_id FROM interactions_wide WHERE day > (SELECT max(day) - 300 "
        "FROM interactions_wide) GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 200)",
        "interactions_wide",
    ),
)
def _(spark, root):
    wide = adapters.interactions_wide(spark, root)
    users, items = counters.select_top_entities(wide, 300, 200, 200)
    return users.select(F.lit("user").alias("side"), F.col("user_id").alias("id")).union(
        items.select(F.lit("item"), "item_id")
    )


@query("daily_pair_counters", sql("SELECT * FROM aggs", "aggs"))
def _(spark, root):
    return _counters_of(spark, root)


LONG_NAMES = [f"num_{a}_{s}" for a in ACTIONS for s in [*SUBDOMAINS, "all_subdomains"]]


@query(
    "long_counters",
    sql(
        "SELECT user_id, item_id, 'num_' || action_type || '_' || subdomain AS feature, "
        "count(*) AS count FROM interactions WHERE action_type IS NOT NULL AND subdomain IS NOT NULL "
        "GROUP BY 1, 2, 3 UNION ALL SELECT user_id, item_id, 'num_' || action_type || "
        "'_all_subdomains', count(*) FROM interactions WHERE action_type IS NOT NULL GROUP BY 1, 2, 3",
        "interactions",
    ),
)
def _(spark, root):
    return counters.long_counters(adapters.interactions(spark, root))


@query(
    "pivot_counts",
    sql(
        "SELECT user_id, item_id, "
        + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in LONG_NAMES)
        + " FROM aggs GROUP BY 1, 2",
        "aggs",
    ),
)
def _(spark, root):
    long = counters.long_counters(adapters.interactions(spark, root))
    return counters.pivot_counts(long, LONG_NAMES)


DIMENSIONS = ("os", "subdomain", "action_type", "category")


@query(
    "nunique_by",
    sql(
        " UNION ALL ".join(
            f"SELECT '{d}' AS dim, {d} AS value, count(DISTINCT user_id) AS users, "
            f"count(DISTINCT w.item_id) AS items FROM interactions_wide w LEFT JOIN items USING (item_id) "
            "GROUP BY 2"
            for d in DIMENSIONS
        ),
        "interactions_wide",
        "items",
    ),
)
def _(spark, root):
    goods = adapters.items(spark, root).select("item_id", "category")
    wide = adapters.interactions_wide(spark, root).select(
        "user_id", "item_id", *(d for d in DIMENSIONS if d != "category")
    )
    # Joined once for all counts; a user's rows lie together, so most of a user's pairs with a
    # value are dropped before they are shuffled.
    wide = materialize(wide.join(goods, "item_id", "left").repartition("user_id"), "wide")
    out = None
    for dim in DIMENSIONS:
        users = counters.nunique_by(wide, dim, "user_id", name="users")
        items = counters.nunique_by(wide, dim, "item_id", name="items")
        part = users.join(items, users[dim].eqNullSafe(items[dim])).select(
            F.lit(dim).alias("dim"), users[dim].alias("value"), "users", "items"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "conversion_rates",
    sql(
        "SELECT day, "
        + ", ".join(
            f"round(count(*) FILTER (action_type = '{s}') / nullif(count(*) FILTER "
            f"(action_type = '{w}'), 0), 6) AS rate_{s}_given_{w}"
            for w, s in (
                ("view", "click"),
                ("view", "clickout"),
                ("view", "like"),
                ("click", "clickout"),
                ("click", "like"),
                ("clickout", "like"),
            )
        )
        + " FROM interactions GROUP BY day",
        "interactions",
    ),
)
def _(spark, root):
    return tidy(counters.conversion_rates(adapters.interactions(spark, root), ["day"]))


# --- rolling features ---------------------------------------------------------

ENRICHED = (
    "SELECT a.*, i.price, i.brand_id, i.category, i.subcategory, u.socdem_cluster, u.region, "
    + ", ".join(f"p.has_{c}" for c in LONG_NAMES)
    + " FROM aggs a LEFT JOIN items i USING (item_id) LEFT JOIN users u USING (user_id) "
    "JOIN (SELECT day, "
    + ", ".join(f"max({c}) > 0 AS has_{c}" for c in LONG_NAMES)
    + " FROM aggs GROUP BY day) p ON p.day = a.day"
)
SNAPS = "SELECT CAST(unnest(range(min(day), max(day) + 1)) AS INTEGER) AS snap FROM aggs"


def group_sql(keys: tuple[str, ...], days: int, counted: list[str] | None = None) -> str:
    """Every statistic of one feature group straight from a day-range join."""
    name = "f_num__" + "_".join(keys) + "__"
    cols = counted if counted is not None else LONG_NAMES
    stats = [
        f"CAST(sum({c}) / nullif(sum(CASE WHEN has_{c} THEN 1 END), 0) AS FLOAT) "
        f"AS {name}mean_{c}_{days}d"
        for c in cols
    ]
    stats += [
        f"CAST({fn}(price) AS FLOAT) AS {name}{stat}_price_{days}d"
        for fn, stat in (("avg", "mean"), ("median", "median"), ("min", "min"), ("max", "max"))
    ]
    stats += [f"CAST(sum({c}) AS BIGINT) AS {name}sum_{c}_{days}d" for c in cols]
    present = " AND ".join(f"e.{k} IS NOT NULL" for k in keys)
    listed = ", ".join(f"e.{k}" for k in keys)
    return (
        f"SELECT {listed}, s.snap AS day, {', '.join(stats)} FROM snaps s JOIN enriched e "
        f"ON e.day BETWEEN s.snap - {days - 1} AND s.snap WHERE {present} "
        f"GROUP BY {listed}, s.snap"
    )


def feature_columns(keys: tuple[str, ...], days: int) -> list[str]:
    name = "f_num__" + "_".join(keys) + "__"
    return [
        *(f"{name}mean_{c}_{days}d" for c in LONG_NAMES),
        *(f"{name}{s}_price_{days}d" for s in ("mean", "median", "min", "max")),
        *(f"{name}sum_{c}_{days}d" for c in LONG_NAMES),
    ]


def _feature_text(keys: tuple[str, ...], days: int) -> str:
    shown = ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in feature_columns(keys, days))
    return f"{', '.join(keys)}, day, {shown}"


def mart_sql(body: str, groups: list[tuple[str, ...]], days: int, **extra: str) -> str:
    steps = {"enriched": ENRICHED, "snaps": SNAPS}
    steps |= {"f_" + "_".join(g): group_sql(g, days) for g in groups}
    return sql(body, "aggs", "items", "users", extra={**steps, **extra})


def _flat(df):
    """Feature columns as rounded doubles, the rest as is."""
    return df.selectExpr(
        *(f"{_rounded(c)} AS `{c}`" if c.startswith("f_num__") else f"`{c}`" for c in df.columns)
    )


def _rounded(c: str) -> str:
    """Four digits; whole numbers, as most counters are, need no decimal arithmetic for it."""
    x = f"CAST(`{c}` AS DOUBLE)"
    return f"if({x} = rint({x}), {x} + 0.0D, round({x}, 4))"


def _enriched(spark, root, groups):
    aggs, users, items = (
        _counters_of(spark, root),
        adapters.users(spark, root),
        adapters.items(spark, root),
    )
    return materialize(enrich_aggs(aggs, users, items, groups), "enriched")


for _group in (("user_id",), ("brand_id",), ("socdem_cluster", "item_id")):

    @query(
        "rolling_features_" + "_".join(_group),
        mart_sql(
            f"SELECT {_feature_text(_group, WINDOW)} FROM f_{'_'.join(_group)}", [_group], WINDOW
        ),
    )
    def _(spark, root, group=_group):
        return _flat(rolling_features(_enriched(spark, root, [group]), group, WINDOW))


RETAIL_ACTIONS = ["view", "added-to-cart"]
RETAIL_PLACES = ["main", "item", "catalog", "search", "cart"]


@query(
    "retail_features",
    sql(
        "SELECT r.item_id, CAST(d AS INTEGER) AS day, count(*) FILTER (action = 'added-to-cart') AS carts, "
        "count(*) FILTER (action = 'view' AND place = 'cart') AS views_in_cart, count(*) FILTER "
        "(action = 'added-to-cart' AND place = 'main') AS carts_on_main FROM r JOIN (SELECT unnest(range("
        "min(day), max(day) + 1)) AS d FROM r) ON r.day BETWEEN d - 29 AND d GROUP BY 1, 2",
        "interactions_wide",
        extra={
            "r": "SELECT day, item_id, CASE action_type WHEN 'view' THEN 'view' ELSE 'added-to-cart' END "
            "AS action, CASE subdomain WHEN 'u2i' THEN 'main' WHEN 'i2i' THEN 'item' WHEN 'other' "
            "THEN 'cart' ELSE subdomain END AS place FROM interactions_wide"
        },
    ),
)
def _(spark, root):
    """Counters and window features of a domain with other actions and places."""
    place = F.col("subdomain")
    for old, new in (("u2i", "main"), ("i2i", "item"), ("other", "cart")):
        place = F.when(F.col("subdomain") == old, new).otherwise(place)
    action = F.when(F.col("action_type") == "view", "view").otherwise("added-to-cart")
    seen = adapters.interactions_wide(spark, root).withColumns(
        {"action_type": action, "subdomain": place}
    )
    # The layer stores the counters with their attributes, once.
    aggs = counters.daily_pair_counters(seen, RETAIL_ACTIONS, RETAIL_PLACES)
    group = ("item_id",)
    layer = build_feature_layer(aggs, None, adapters.items(spark, root), WINDOW, [group])[group]
    named = {
        "carts": "added-to-cart_all_subdomains",
        "views_in_cart": "view_cart",
        "carts_on_main": "added-to-cart_main",
    }
    return layer.select(
        "item_id",
        F.col("day").cast("int").alias("day"),
        *(
            F.col(f"`{feature_name(f'sum_num_{c}', group, WINDOW)}`").cast("bigint").alias(out)
            for out, c in named.items()
        ),
    )


_PRICE = ("region", "subcategory")


@query(
    "rolling_price_stats",
    mart_sql(
        "SELECT region, subcategory, day, "
        + ", ".join(
            f"round(CAST({c} AS DOUBLE), 4) AS {c}"
            for c in feature_columns(_PRICE, WINDOW)
            if c.endswith(f"_price_{WINDOW}d")
        )
        + " FROM f_region_subcategory",
        [_PRICE],
        WINDOW,
    ),
)
def _(spark, root):
    return _flat(rolling_price_stats(_enriched(spark, root, [_PRICE]), _PRICE, WINDOW))


def _layer_rows(spark, root):
    layer = build_feature_layer(
        _counters_of(spark, root),
        adapters.users(spark, root),
        adapters.items(spark, root),
        WINDOW,
    )
    rows = None
    for keys, frame in layer.items():
        prefix = "f_num__" + "_".join(keys) + "__"
        like = f"{prefix}sum_num_like_all_subdomains_{WINDOW}d"
        view = f"{prefix}mean_num_view_all_subdomains_{WINDOW}d"
        median = f"{prefix}median_price_{WINDOW}d"
        part = frame.groupBy("day").agg(
            F.count("*").alias("n"),
            F.sum(like).alias("likes"),
            F.round(F.sum(F.round(F.col(view).cast("double"), 4)), 4).alias("views"),
            F.round(F.sum(F.round(F.col(median).cast("double"), 4)), 4).alias("median"),
        ).select(F.lit("-".join(keys)).alias("grouping"), "*")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _layer_sql() -> str:
    parts = []
    for keys in FEATURE_GROUPS:
        p, d = "f_num__" + "_".join(keys) + "__", WINDOW
        parts.append(
            f"SELECT '{'-'.join(keys)}' AS grouping, day, count(*) AS n, "
            f"CAST(sum({p}sum_num_like_all_subdomains_{d}d) AS BIGINT) AS likes, "
            f"round(sum(round(CAST({p}mean_num_view_all_subdomains_{d}d AS DOUBLE), 4)), 4) AS views, "
            f"round(sum(round(CAST({p}median_price_{d}d AS DOUBLE), 4)), 4) AS median "
            f"FROM f_{'_'.join(keys)} GROUP BY day"
        )
    return mart_sql(" UNION ALL ".join(parts), FEATURE_GROUPS, WINDOW)


# All ten groups over all days, summed per day.
query("build_feature_layer", _layer_sql())(_layer_rows)


# --- basis and training set -----------------------------------------------------

PAIRS = (
    "SELECT day, user_id, item_id, max(log_target) AS label, count(*) AS events, "
    "bool_or(action_type <> 'view') AS acted FROM targeted_known GROUP BY 1, 2, 3"
)
BASIS = {
    # Labels come from the known actions only: the raw layer holds nothing else.
    "known": "SELECT * FROM interactions WHERE action_type IS NOT NULL",
    "targeted_known": "SELECT k.*, ln(1 + t.total / c.len) AS log_target FROM known k JOIN "
    "(SELECT action_type, CAST(count(*) AS DOUBLE) AS len FROM known GROUP BY 1) c USING (action_type) "
    "CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS total FROM known) t",
    "pairs": PAIRS,
    "sessions": "SELECT day, user_id, CAST(sum(events) AS BIGINT) AS len, bool_or(acted) AS acted "
    "FROM pairs GROUP BY 1, 2",
    "kept": "SELECT s.day, s.user_id, s.len FROM (SELECT * FROM sessions WHERE acted) s JOIN "
    "(SELECT day, max(CASE WHEN rn - 1 = CAST(round((n - 1) * 0.99::DOUBLE) AS BIGINT) THEN len END) "
    "AS lim FROM (SELECT day, len, row_number() OVER (PARTITION BY day ORDER BY len) AS rn, "
    "count(*) OVER (PARTITION BY day) AS n FROM sessions WHERE acted) GROUP BY day) q USING (day) "
    "WHERE s.len <= q.lim",
    "basis": "SELECT p.day || '__' || p.user_id AS session_id, p.day, p.user_id, p.item_id, "
    "CAST(p.label AS FLOAT) AS label FROM pairs p JOIN kept USING (day, user_id)",
}


@query(
    "build_basis",
    sql(
        "SELECT session_id, day, user_id, item_id, round(CAST(label AS DOUBLE), 6) AS label FROM basis",
        "interactions",
        extra=BASIS,
    ),
)
def _(spark, root):
    return tidy(basis.build_basis(adapters.interactions(spark, root)))


@query(
    "build_basis_multiclass",
    sql(
        "SELECT session_id, p.day, p.user_id, p.item_id, "
        + ", ".join(
            f"CAST(max(CAST(k.action_type = '{a}' AS TINYINT)) AS TINYINT) AS target_{a}"
            for a in ("view", "clickout", "like", "click")
        )
        + " FROM basis p JOIN known k USING (day, user_id, item_id) GROUP BY 1, 2, 3, 4",
        "interactions",
        extra=BASIS,
    ),
)
def _(spark, root):
    return basis.build_basis(adapters.interactions(spark, root), "multiclass")


@query(
    "drop_view_only_sessions",
    sql(
        "SELECT event_id FROM known JOIN (SELECT day, user_id FROM known GROUP BY 1, 2 "
        "HAVING bool_or(action_type <> 'view')) USING (day, user_id)",
        "interactions",
        extra={"known": BASIS["known"]},
    ),
)
def _(spark, root):
    known = adapters.interactions(spark, root).where(F.col("action_type").isNotNull())
    return basis.drop_view_only_sessions(known).select("event_id")


@query(
    "filter_p99_sessions",
    sql("SELECT day, user_id, len FROM kept", "interactions", extra=BASIS),
)
def _(spark, root):
    known = adapters.interactions(spark, root).where(F.col("action_type").isNotNull())
    sessions = known.groupBy("day", "user_id").agg(
        F.count("*").alias("len"), F.bool_or(F.col("action_type") != "view").alias("acted")
    )
    return basis.filter_long_sessions(sessions.where("acted")).select("day", "user_id", "len")


def _dataset_sql(groups) -> str:
    joins, shown = "", ""
    for g in groups:
        table = "f_" + "_".join(g)
        on = " AND ".join(
            f"{table}.{k} = {'b' if k in ('user_id', 'item_id') else 'u' if k in ('socdem_cluster', 'region') else 'i'}.{k}"
            for k in g
        )
        joins += f" LEFT JOIN {table} ON {on} AND {table}.day = b.day - 1"
        shown += "".join(
            f", round(CAST({c} AS DOUBLE), 4) AS {c}" for c in feature_columns(g, WINDOW)
        )
    return mart_sql(
        "SELECT session_id, b.day, b.user_id, b.item_id, round(CAST(label AS DOUBLE), 6) AS label, "
        "CAST(u.socdem_cluster AS VARCHAR) AS f_cat__socdem_cluster, "
        "CAST(u.region AS VARCHAR) AS f_cat__region, CAST(i.brand_id AS VARCHAR) AS f_cat__brand_id, "
        "i.category AS f_cat__category, i.subcategory AS f_cat__subcategory, "
        f"round(CAST(CAST(i.price AS FLOAT) AS DOUBLE), 4) AS f_num__price{shown} FROM basis b "
        "LEFT JOIN users u ON u.user_id = b.user_id LEFT JOIN items i ON i.item_id = b.item_id"
        f"{joins} WHERE b.day > (SELECT min(day) FROM basis)",
        list(groups),
        WINDOW,
        **BASIS,
    )


@query("build_dataset", _dataset_sql(GROUPS))
def _(spark, root):
    people, goods = adapters.users(spark, root), adapters.items(spark, root)
    features = {
        g: materialize(f, "features")
        for g, f in build_feature_layer(
            _counters_of(spark, root), people, goods, WINDOW, GROUPS, ranges=True
        ).items()
    }
    ranked = materialize(basis.build_basis(adapters.interactions(spark, root)), "basis")
    made = assemble.build_dataset(ranked, features, people, goods)
    return _flat(made.withColumn("label", F.round(F.col("label").cast("double"), 6)))


MART_GROUPS = GROUPS


@query("feature_mart", _dataset_sql(MART_GROUPS))
def _(spark, root):
    made = run_mart(
        adapters.interactions(spark, root),
        adapters.users(spark, root),
        adapters.items(spark, root),
        scratch_path(spark, "mart"),
        num_days=WINDOW,
        n_last_days=10_000,
        groups=MART_GROUPS,
    )
    return _flat(made.withColumn("label", F.round(F.col("label").cast("double"), 6)))


# --- aggregates and candidates ----------------------------------------------------

PRICED = {
    "priced": "SELECT t.*, i.category, coalesce(i.subcategory, 'unknown') AS subcategory, i.brand_id, "
    "i.price FROM targeted t JOIN (SELECT item_id, coalesce(category, 'unknown') AS category, "
    "subcategory, coalesce(brand_id, -1) AS brand_id, price FROM items WHERE price IS NOT NULL) i "
    "USING (item_id) WHERE subdomain IS NOT NULL",
    "ui": "SELECT user_id, item_id, max(log_target) AS target, max(day) AS last_day, "
    "avg(price) AS price_mean, "
    + ", ".join(
        f"arg_min({c}, (ts, event_id)) AS {'last_action_type' if c == 'action_type' else c}"
        for c in assemble.ATTRIBUTES
    )
    + " FROM priced GROUP BY 1, 2",
}


def priced_pairs(spark, root):
    """Events with item attributes, reduced to one row per pair."""
    from clickloom.operators.cleaning import drop_null, fill_unknown

    goods = drop_null(adapters.items(spark, root), ["price"])
    goods = fill_unknown(goods, ["category", "subcategory"], "brand_id")
    priced = drop_null(_targeted(spark, root).join(goods, "item_id"), ["subdomain"])
    return assemble.user_item_aggregate(priced)


@query(
    "user_item_aggregate",
    sql(
        "SELECT user_id, item_id, round(target, 6) AS target, last_day, "
        "round(price_mean, 6) AS price_mean, category, subcategory, brand_id, os, subdomain, "
        "last_action_type FROM ui",
        "targeted",
        "items",
        extra=PRICED,
    ),
)
def _(spark, root):
    return tidy(priced_pairs(spark, root))


@query(
    "entity_aggregates",
    sql(
        "SELECT 'user' AS side, user_id AS id, count(*) AS n, round(avg(target), 6) AS mean FROM ui "
        "GROUP BY 2 UNION ALL SELECT 'item', item_id, count(*), round(avg(price_mean), 6) FROM ui "
        "GROUP BY 2",
        "targeted",
        "items",
        extra=PRICED,
    ),
)
def _(spark, root):
    pairs = priced_pairs(spark, root)
    people = assemble.user_aggregates(pairs).select(F.lit("user"), "*")
    goods = assemble.item_aggregates(pairs).select(F.lit("item"), "*")
    return tidy(people.union(goods).toDF("side", "id", "n", "mean"))


@query(
    "candidates",
    sql(
        "SELECT u.user_id, u.os, u.subdomain, u.last_day, CAST(ua.n AS INTEGER) AS user_hist_len, "
        "round(ua.m, 6) AS user_mean_target, i.item_id, round(i.price_mean, 6) AS price_mean, "
        "i.category, i.subcategory, CAST(i.brand_id AS VARCHAR) AS brand_id, "
        "CAST(ia.n AS INTEGER) AS item_popularity, round(ia.m, 6) AS price_mean_item FROM "
        "(SELECT user_id, arg_min(os, item_id) AS os, arg_min(subdomain, item_id) AS subdomain, "
        "arg_min(last_day, item_id) AS last_day FROM ui GROUP BY 1) u JOIN (SELECT user_id, count(*) "
        "AS n, avg(target) AS m FROM ui GROUP BY 1) ua USING (user_id) CROSS JOIN (SELECT item_id, "
        "arg_min(price_mean, user_id) AS price_mean, arg_min(category, user_id) AS category, "
        "arg_min(subcategory, user_id) AS subcategory, arg_min(brand_id, user_id) AS brand_id "
        "FROM ui GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 20) i JOIN (SELECT item_id, count(*) "
        "AS n, avg(price_mean) AS m FROM ui GROUP BY 1) ia USING (item_id)",
        "targeted",
        "items",
        extra=PRICED,
    ),
)
def _(spark, root):
    pairs = materialize(priced_pairs(spark, root), "pairs")
    made = assemble.candidates(
        pairs, pairs, assemble.user_aggregates(pairs), assemble.item_aggregates(pairs), 20
    )
    return tidy(made)


# --- pairs, histories, sequences ----------------------------------------------------


@query(
    "pair_confidence",
    sql(
        "SELECT user_id, item_id, round(sum(log_target), 6) AS target FROM targeted GROUP BY 1, 2",
        "targeted",
    ),
)
def _(spark, root):
    return tidy(histories.pair_confidence(_targeted(spark, root), "target"))


@query(
    "min_interactions",
    sql(
        "SELECT user_id, item_id FROM p WHERE user_id IN (SELECT user_id FROM p GROUP BY 1 "
        "HAVING count(*) >= 30) AND item_id IN (SELECT item_id FROM p GROUP BY 1 HAVING "
        "count(*) >= 30)",
        "interactions_wide",
        extra={"p": "SELECT DISTINCT user_id, item_id FROM interactions_wide"},
    ),
)
def _(spark, root):
    pairs = adapters.interactions_wide(spark, root).select("user_id", "item_id").distinct()
    return histories.min_interactions(pairs, 30)


@query(
    "truth_lists",
    sql(
        "SELECT user_id, string_agg(item_id, ',' ORDER BY item_id, log_target) AS true_items, "
        "string_agg(CAST(round(log_target * 1000) AS BIGINT), ',' ORDER BY item_id, log_target) "
        "AS relevancy FROM test GROUP BY 1",
        "test",
    ),
)
def _(spark, root):
    _train, test = _split(spark, root)
    return tidy(histories.truth_lists(test, "target"))


def _history_sql(pairs: str, extra: dict[str, str]) -> str:
    return sql(
        "SELECT CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_idx, user_id, "
        "string_agg(item_idx, ',' ORDER BY item_idx) AS item_idx, "
        "string_agg(CAST(round(CAST(weight AS DOUBLE) * 1000) AS BIGINT), ',' ORDER BY item_idx) "
        "AS weight FROM (SELECT user_id, weight, item_idx FROM wp JOIN (SELECT item_id, "
        f"row_number() OVER (ORDER BY item_id) - 1 AS item_idx FROM ({pairs})) USING (item_id)) "
        "GROUP BY user_id",
        "targeted",
        "aggs",
        extra=extra,
    )


@query(
    "history_from_features",
    _history_sql(
        "SELECT DISTINCT item_id FROM snapshot",
        {
            "snapshot": "SELECT user_id, item_id, "
            + ", ".join(
                f"sum(num_{a}_all_subdomains) AS {a}" for a in ("view", "click", "clickout", "like")
            )
            + f" FROM aggs WHERE day BETWEEN {19750 - WINDOW + 1} AND 19750 GROUP BY 1, 2",
            "wp": "SELECT user_id, item_id, CAST(ln(1 + view + 2 * click + 4 * clickout + 8 * \"like\") "
            "AS FLOAT) AS weight FROM snapshot",
        },
    ),
)
def _(spark, root):
    group = ("user_id", "item_id")
    layer = rolling_features(_enriched(spark, root, [group]), group, WINDOW)
    snapshot = materialize(layer.where(F.col("day") == 19750), "snapshot")
    return tidy(histories.history_from_features(snapshot, False, 1, WINDOW))


@query(
    "history_from_events",
    _history_sql(
        "SELECT DISTINCT item_id FROM wp",
        {
            "p": "SELECT user_id, item_id, sum(log_target) AS weight FROM targeted "
            "WHERE day >= 19735 GROUP BY 1, 2",
            "wp": "SELECT * FROM p WHERE user_id IN (SELECT user_id FROM p GROUP BY 1 HAVING "
            "count(*) >= 20) AND item_id IN (SELECT item_id FROM p GROUP BY 1 HAVING count(*) >= 20)",
        },
    ),
)
def _(spark, root):
    made = histories.history_from_events(_targeted(spark, root), "target", False, 20, 19735)
    return tidy(made)


LAST = {
    "recent": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) "
    "AS back FROM targeted",
}


@query(
    "last_k_interactions",
    sql(
        "SELECT user_id, string_agg(item_id, ',' ORDER BY back DESC) AS item_id, "
        "string_agg(action_type, ',' ORDER BY back DESC) AS action_type FROM recent "
        "WHERE back <= 30 GROUP BY 1",
        "targeted",
        extra=LAST,
    ),
)
def _(spark, root):
    seen = adapters.interactions(spark, root)
    return tidy(ranking.last_k_interactions(seen, 30).select("user_id", "item_id", "action_type"))


@query(
    "all_interactions",
    sql(
        "SELECT user_id, string_agg(item_id, ',' ORDER BY ts, event_id) AS item_id "
        "FROM targeted GROUP BY 1",
        "targeted",
    ),
)
def _(spark, root):
    seen = adapters.interactions(spark, root)
    return tidy(ranking.last_k_interactions(seen, None).select("user_id", "item_id"))


SEQUENCES = {
    **LAST,
    "tail": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY back DESC) AS pos "
    "FROM recent WHERE back <= 30",
}


@query(
    "build_sequences",
    sql(
        "SELECT e.user_id, e.pos AS seq_len, string_agg(p.item_id, ',' ORDER BY p.pos) "
        "AS item_sequence, round(max(e.log_weight), 6) AS target FROM tail e JOIN tail p "
        "ON p.user_id = e.user_id AND p.pos <= e.pos WHERE e.pos >= 3 GROUP BY 1, 2",
        "targeted",
        extra=SEQUENCES,
    ),
)
def _(spark, root):
    weighted = targets.log_weight_target(adapters.interactions(spark, root))
    return tidy(
        histories.build_sequences(weighted).withColumn("seq_len", F.col("seq_len").cast("bigint"))
    )


@query(
    "pad_sequences",
    sql(
        "SELECT user_id, seq_len, input_ids || repeat(',0', CAST(30 - seq_len AS INTEGER)) "
        "AS input_ids, substr(repeat(',1', CAST(seq_len AS INTEGER)), 2) || "
        "repeat(',0', CAST(30 - seq_len AS INTEGER)) AS attention_mask FROM (SELECT e.user_id, "
        "e.pos AS seq_len, string_agg(coalesce(v.item_idx, 0), ',' ORDER BY p.pos) AS input_ids "
        "FROM tail e JOIN tail p ON p.user_id = e.user_id AND p.pos <= e.pos LEFT JOIN vocab v "
        "ON v.item_id = p.item_id WHERE e.pos >= 3 GROUP BY 1, 2)",
        "targeted",
        extra={
            **SEQUENCES,
            "vocab": "SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS item_idx "
            "FROM targeted GROUP BY 1 ORDER BY 2 LIMIT 80",
        },
    ),
)
def _(spark, root):
    weighted = targets.log_weight_target(adapters.interactions(spark, root))
    vocabulary = histories.top_items_vocabulary(weighted, 80)
    indexed = histories.index_items(weighted, vocabulary)
    made = histories.pad_sequences(histories.build_sequences(indexed, item="item_idx"))
    return tidy(
        made.select(
            "user_id", F.col("seq_len").cast("bigint").alias("seq_len"), "input_ids", "attention_mask"
        )
    )


# --- ranking helpers -------------------------------------------------------------


@query(
    "quantile_nearest",
    sql(
        "SELECT day, max(CASE WHEN rn - 1 = CAST(round((n - 1) * 0.9::DOUBLE) AS BIGINT) THEN v END) "
        "AS quantile FROM (SELECT day, user_id AS v, row_number() OVER (PARTITION BY day ORDER BY "
        "user_id) AS rn, count(*) OVER (PARTITION BY day) AS n FROM interactions) GROUP BY day",
        "interactions",
    ),
)
def _(spark, root):
    return quantile_nearest(adapters.interactions(spark, root), "user_id", 0.9, ["day"])


@query(
    "ordinal_rank",
    sql(
        "SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, "
        "item_id) AS rank FROM interactions GROUP BY 1, 2",
        "interactions",
    ),
)
def _(spark, root):
    counts = adapters.interactions(spark, root).groupBy("user_id", "item_id").count()
    ranked = ranking.ordinal_rank(counts, ["user_id"], "count", "item_id")
    return ranked.select("user_id", "item_id", F.col("rank").cast("bigint").alias("rank"))


@query(
    "top_n",
    sql(
        "SELECT item_id, count(*) AS count FROM interactions_wide GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 100",
        "interactions_wide",
    ),
)
def _(spark, root):
    counts = adapters.interactions_wide(spark, root).groupBy("item_id").count()
    return ranking.top_n(counts, "count", 100, "item_id")


@query(
    "sort_by",
    sql("SELECT event_id, user_id, day FROM interactions ORDER BY user_id, ts", "interactions"),
)
def _(spark, root):
    listed = ranking.sort_by(adapters.interactions(spark, root), "user_id", "ts")
    return listed.select("event_id", "user_id", "day")


# --- profiling -----------------------------------------------------------------------


@query(
    "null_profile",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column, count(*) FILTER ({c} IS NULL) AS nulls, "
            f"round(count(*) FILTER ({c} IS NULL) / count(*), 6) AS rate FROM items"
            for c in ("item_id", "brand_id", "category", "subcategory", "price")
        ).replace("AS column", 'AS "column"'),
        "items",
    ),
)
def _(spark, root):
    return tidy(profiling.null_profile(adapters.items(spark, root)))


@query(
    "duplicate_rows",
    sql(
        "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM "
        "interactions GROUP BY user_id, item_id, action_type, subdomain, os, day)",
        "interactions",
    ),
)
def _(spark, root):
    # Every column but the event's id and second of its time, which no two events share.
    return profiling.duplicate_rows(adapters.interactions(spark, root).drop("event_id", "ts"))


@query(
    "joint_nulls",
    sql(
        "SELECT count(*) FILTER (socdem_cluster IS NULL AND region IS NULL) AS both_null, "
        "round(count(*) FILTER (socdem_cluster IS NULL AND region IS NULL) / count(*), 6) AS share "
        "FROM users",
        "users",
    ),
)
def _(spark, root):
    return tidy(profiling.joint_nulls(adapters.users(spark, root), "socdem_cluster", "region"))


@query(
    "value_counts",
    sql("SELECT subdomain, count(*) AS count FROM interactions GROUP BY 1", "interactions"),
)
def _(spark, root):
    return profiling.value_counts(adapters.interactions(spark, root), "subdomain")


DESCRIBED = (
    "count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    "round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, "
    "round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, "
    "round(max({c}), 4) AS max"
).format(c="price")


@query("describe", sql(f"SELECT {DESCRIBED} FROM items", "items"))
def _(spark, root):
    return tidy(profiling.describe_by(adapters.items(spark, root), "price"), 4)


@query(
    "describe_by",
    sql(
        f"SELECT socdem_cluster, {DESCRIBED} FROM interactions_wide LEFT JOIN users USING (user_id) "
        "LEFT JOIN items USING (item_id) WHERE socdem_cluster IS NOT NULL GROUP BY 1",
        "interactions_wide",
        "users",
        "items",
    ),
)
def _(spark, root):
    merged = (
        adapters.interactions_wide(spark, root)
        .join(adapters.users(spark, root), "user_id", "left")
        .join(adapters.items(spark, root), "item_id", "left")
    )
    return tidy(profiling.describe_by(merged, "price", ["socdem_cluster"]), 4)


@query(
    "zscore_outliers",
    "SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / s, 4) AS z FROM lineitem, "
    "(SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem) "
    "WHERE abs((l_extendedprice - m) / s) > 1.5",
)
def _(spark, root):
    lines = adapters.table(spark, root, "lineitem")
    found = profiling.zscore_outliers(lines, "l_extendedprice", 1.5)
    return tidy(found.select("l_orderkey", "l_linenumber", "z"), 4)


@query(
    "time_span",
    sql(
        "SELECT epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, "
        "epoch_us(max(ts)) - epoch_us(min(ts)) AS span_us FROM interactions",
        "interactions",
    ),
)
def _(spark, root):
    return profiling.time_span(adapters.interactions(spark, root))


@query(
    "top_items",
    sql(
        "SELECT item_id, count(*) AS count FROM interactions_wide WHERE action_type = 'click' "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        "interactions_wide",
    ),
)
def _(spark, root):
    return profiling.top_items(adapters.interactions_wide(spark, root), "click")


@query(
    "top_items_by_users",
    sql(
        "SELECT item_id, count(DISTINCT user_id) AS users FROM interactions_wide WHERE action_type "
        "IN ('click', 'clickout', 'like') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        "interactions_wide",
    ),
)
def _(spark, root):
    return profiling.top_items_by_users(adapters.interactions_wide(spark, root))


@query(
    "cardinalities",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM interactions_wide"
            for c in ("user_id", "item_id", "subdomain", "os")
        ),
        "interactions_wide",
    ),
)
def _(spark, root):
    wide = adapters.interactions_wide(spark, root)
    return profiling.cardinalities(wide, ["user_id", "item_id", "subdomain", "os"])
