"""Queries over recommenders, scoring, metrics and the request log."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators import assemble, histories, metrics, ranking, requestlog, scoring, splits, targets
from clickloom.operators.models import als, ease, gbt, multvae, popularity, svd
from clickloom.plans import experiments
from clickloom.plans.queries_data import COUNTS, action_factors
from clickloom.plans.queries_mart import PRICED, priced_pairs
from clickloom.plans.registry import VIEWS, query, sql, tidy
from clickloom.session import materialize, scratch_path
from clickloom.sources import adapters, factors

K = 15


def split(spark, root, days=5, wide=False):
    source = adapters.interactions_wide if wide else adapters.interactions
    return splits.global_temporal_split(targets.create_target(source(spark, root)), days)


def evaluation(spark, root):
    """(truth pairs, popularity predictions) of the last days."""
    train, test = split(spark, root)
    return metrics.truth_pairs(test, "target"), popularity.popular_items(train, K, users=test)


def evaluation_lists(spark, root):
    """The evaluation frame with list columns."""
    train, test = split(spark, root)
    recs = ranking.top_k_per_user(popularity.popular_items(train, K, users=test), K)
    return histories.truth_lists(test, "target").join(recs, "user_id")


# --- recommenders -------------------------------------------------------------


@query(
    "popular_items",
    sql("SELECT user_id, item_id, score, pos FROM preds", "preds"),
)
def _(spark, root):
    train, test = split(spark, root)
    recs = popularity.popular_items(train, K, users=test)
    return recs.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "popular_items_by_users",
    sql(
        "SELECT item_id, count(DISTINCT user_id) AS popularity FROM interactions_wide "
        "WHERE action_type IN ('click', 'clickout', 'like') GROUP BY 1",
        "interactions_wide",
    ),
)
def _(spark, root):
    return popularity.item_popularity(adapters.interactions_wide(spark, root), "users")


def list_facts(recs, seen=None):
    """What must hold of every user's list: its length, no repeats, nothing seen, finite scores."""
    if seen is not None:
        pairs = seen.select("user_id", "item_id").distinct().withColumn("_seen", F.lit(1))
        recs = recs.join(pairs, ["user_id", "item_id"], "left")
    else:
        recs = recs.withColumn("_seen", F.lit(None).cast("int"))
    finite = F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double"))
    return recs.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.count_distinct("item_id").alias("items"),
        F.count("_seen").alias("seen"),
        F.min(finite & (F.abs("score") < float("inf"))).alias("finite"),
    )


def facts_sql(asked: str, known: str, seen: str | None, *views: str, extra=None) -> str:
    """Lists of `asked` users hold K items of `known`, or all they have not seen if fewer."""
    left = f"(SELECT count(*) FROM ({known}))"
    if seen:
        left += f" - (SELECT count(*) FROM ({seen}) s WHERE s.user_id = a.user_id)"
    return sql(
        f"SELECT user_id, n, n AS items, CAST(0 AS BIGINT) AS seen, true AS finite FROM (SELECT "
        f"user_id, least({K}, {left}) AS n FROM ({asked}) a) WHERE n > 0",
        *views,
        extra=extra,
    )


# The wide events split 400 days before the end, and pairs whose user and item occur in 3 pairs.
WIDE = {
    "wide_train": "SELECT * FROM interactions_wide WHERE day < (SELECT max(day) - 400 FROM "
    "interactions_wide)",
    "wide_test": "SELECT * FROM interactions_wide WHERE day > (SELECT max(day) - 400 FROM "
    "interactions_wide)",
}


def _frequent(source: str, n: int) -> str:
    return (
        f"SELECT * FROM (SELECT DISTINCT user_id, item_id FROM {source}) p WHERE user_id IN (SELECT "
        f"user_id FROM (SELECT DISTINCT user_id, item_id FROM {source}) GROUP BY 1 HAVING count(*) >= {n}) "
        f"AND item_id IN (SELECT item_id FROM (SELECT DISTINCT user_id, item_id FROM {source}) GROUP BY 1 "
        f"HAVING count(*) >= {n})"
    )


@query(
    "implicit_als",
    facts_sql(
        "SELECT DISTINCT user_id FROM often WHERE user_id IN (SELECT user_id FROM wide_test)",
        "SELECT DISTINCT item_id FROM often",
        "FROM often",
        "interactions_wide",
        extra={**WIDE, "often": _frequent("wide_train", 3)},
    ),
)
def _(spark, root):
    train, test = split(spark, root, 400, wide=True)
    model = als.fit_als(train, "target", factors=64, iterations=15, min_n=3)
    asked = model.users.join(test.select("user_id").distinct(), "user_id", "left_semi")
    recs = scoring.recommend_top_k(asked, model.items, K, seen=model.pairs)
    return list_facts(recs, model.pairs)


@query(
    "truncated_svd",
    sql(
        "SELECT i AS component, energy, true AS unit, true AS orthogonal, true AS matches, true AS bounded, "
        "true AS solves FROM range(1, 21) t(i), (SELECT round(sum(v * v), 3) AS energy FROM (SELECT sum(ln(1 + w.total / c.len)) "
        "AS v FROM wide_train e JOIN (SELECT action_type, CAST(count(*) AS DOUBLE) AS len FROM "
        "interactions_wide GROUP BY 1) c USING (action_type) CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) "
        "AS total FROM interactions_wide) w GROUP BY user_id, item_id))",
        "interactions_wide",
        extra=WIDE,
    ),
)
def _(spark, root):
    """Per component: V_i has length 1 and is orthogonal to the others, |U_i S_i| is its singular
    value (in falling order), the captured energy stays below that of the matrix, and R'R V_i is
    sigma_i^2 V_i up to 2e-5 of the largest sigma^2, multiplied out on the table."""
    train, _test = split(spark, root, 400, wide=True)
    pairs = train.select("user_id", "item_id", F.col("target").alias("value"))
    entries = materialize(pairs.groupBy("user_id", "item_id").agg(F.sum("value").alias("v")), "entries")
    users, items, sigma = svd.truncated_svd(
        entries.withColumnRenamed("v", "value"), 20, tolerance=1e-5
    )
    energy = entries.agg(F.round(F.sum(F.col("v") * F.col("v")), 3)).first()[0]
    part = lambda i: F.element_at("features", i + 1)
    n = len(sigma)
    cells = [(i, j) for i in range(n) for j in range(i + 1)]
    dots = dict(zip(cells, items.agg(*(F.sum(part(i) * part(j)) for i, j in cells)).first()))
    lengths = users.agg(*(F.sqrt(F.sum(part(i) * part(i))) for i in range(n))).first()
    image = (
        entries.join(users, "user_id")
        .groupBy("item_id")
        .agg(F.array(*(F.sum(F.col("v") * part(i)) for i in range(n))).alias("image"))
    )
    gap = lambda i: F.element_at("image", i + 1) - part(i) * sigma[i] ** 2
    gaps = image.join(items, "item_id").agg(*(F.sqrt(F.sum(gap(i) * gap(i))) for i in range(n))).first()
    rows = [
        (
            i + 1,
            energy,
            abs(dots[i, i] - 1) < 1e-6,
            all(abs(dots[i, j]) < 1e-6 for j in range(i)),
            abs(lengths[i] - sigma[i]) < 1e-6 * sigma[i],
            sigma[i] <= sigma[max(i - 1, 0)] and sum(v * v for v in sigma) <= energy,
            gaps[i] < 2e-5 * sigma[0] ** 2,
        )
        for i in range(n)
    ]
    schema = "component long, energy double, unit boolean, orthogonal boolean, matches boolean, "
    schema += "bounded boolean, solves boolean"
    return spark.createDataFrame(rows, schema)


@query(
    "ease",
    facts_sql(
        "SELECT DISTINCT user_id FROM train WHERE user_id IN (SELECT user_id FROM test)",
        "SELECT DISTINCT item_id FROM train",
        "SELECT DISTINCT user_id, item_id FROM train",
        "train",
        "test",
    ),
)
def _(spark, root):
    train, test = split(spark, root)
    recs = ease.recommend_ease(ease.fit_ease(train, 300.0), K, users=test)
    return list_facts(recs, train)


@query(
    "ease_weights",
    sql(
        "SELECT item_id, 0.0::DOUBLE AS diagonal, true AS solves FROM train GROUP BY 1",
        "train",
    ),
)
def _(spark, root):
    """Column j of (X'X + reg I)(I - B) is 0 but at j: B solves its normal equations."""
    train, _test = split(spark, root)
    model = ease.fit_ease(train, 300.0)
    weights = model.weights.join(model.items, "item_idx")
    own = F.element_at("weights", (F.col("item_idx") + 1).cast("int"))
    # X (I - B) for every user and item, then X' of that, both as plain joins.
    listed = model.histories.select("user_id", F.explode(F.arrays_zip("item_idx", "weight")).alias("h"))
    entries = listed.select("user_id", F.col("h.item_idx").alias("i"), F.col("h.weight").alias("x"))
    columns = weights.select(
        F.col("item_idx").alias("j"), F.posexplode("weights").alias("i", "b")
    ).withColumn("b", (F.col("i") == F.col("j")).cast("double") - F.col("b"))
    left = (
        entries.join(columns, "i").groupBy("user_id", "j").agg(F.sum(F.col("x") * F.col("b")).alias("y"))
    )
    normal = (
        entries.join(left, "user_id").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("g"))
    )
    rest = normal.join(columns, ["i", "j"]).where("i <> j").groupBy("j").agg(
        F.max(F.abs(F.col("g") + 300.0 * F.col("b"))).alias("rest")
    )
    return weights.join(rest, weights["item_idx"] == rest["j"]).select(
        "item_id", own.alias("diagonal"), (F.col("rest") < 1e-6).alias("solves")
    )


@query(
    "multvae",
    facts_sql(
        "SELECT DISTINCT user_id FROM often",
        "SELECT DISTINCT item_id FROM often",
        None,
        "train",
        extra={"often": _frequent("train", 5)},
    ),
)
def _(spark, root):
    train, _test = split(spark, root)
    made = materialize(histories.history_from_events(train, "target", min_n=5), "histories")
    items = ranking.dense_index(
        histories.min_interactions(histories.pair_confidence(train, "target"), 5),
        "item_id",
        "item_idx",
    )
    model = multvae.fit_multvae(
        made, items.count(), (64, 16), epochs=4, batch_size=64, total_anneal_steps=200
    )
    return list_facts(multvae.recommend_multvae(model, made, items, K, filter_seen=False))


@query(
    "saved_models",
    sql(
        "SELECT 'ease' AS model, (SELECT count(DISTINCT user_id) FROM test WHERE user_id IN (SELECT "
        "user_id FROM train)) * 15 AS n, true AS same UNION ALL SELECT 'multvae', (SELECT "
        "count(DISTINCT user_id) FROM often) * 15, true",
        "train",
        "test",
        extra={"often": _frequent("train", 5)},
    ),
)
def _(spark, root):
    """Lists of fitted models next to those of the models read back."""
    train, test = split(spark, root)
    linear = ease.fit_ease(train, 300.0)
    path = factors.save_ease(linear, scratch_path(spark, "ease"))
    lists = {
        "ease": [ease.recommend_ease(m, K, users=test) for m in (linear, factors.load_ease(spark, path))]
    }
    made = materialize(histories.history_from_events(train, "target", min_n=5), "histories")
    known = histories.min_interactions(histories.pair_confidence(train, "target"), 5)
    items = ranking.dense_index(known, "item_id", "item_idx")
    vae = multvae.fit_multvae(made, items.count(), (16, 4), epochs=1, batch_size=64)
    path = factors.save_multvae(spark, vae, items, scratch_path(spark, "vae"))
    lists["multvae"] = [
        multvae.recommend_multvae(model, made, ids, K, filter_seen=False)
        for model, ids in ((vae, items), factors.load_multvae(spark, path))
    ]
    rows = None
    for name, (before, after) in lists.items():
        both = before.withColumnRenamed("score", "a").join(
            after.withColumnRenamed("score", "b"), ["user_id", "item_id"], "full"
        )
        part = both.agg(
            F.count("*").alias("n"), F.coalesce(F.min(F.abs(F.col("a") - F.col("b")) < 1e-5), F.lit(False)).alias("same")
        ).select(F.lit(name).alias("model"), "n", "same")
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query(
    "boosted_tree_ranker",
    facts_sql(
        "SELECT DISTINCT user_id FROM ui WHERE last_day >= (SELECT max(last_day) - greatest(floor("
        "(max(last_day) - min(last_day) + 1) * 0.1::DOUBLE), 1) + 1 FROM ui)",
        "SELECT item_id FROM ui GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 50",
        None,
        "targeted",
        "items",
        extra=PRICED,
    ),
)
def _(spark, root):
    pairs = materialize(priced_pairs(spark, root), "pairs")
    fit_part, valid_part = splits.validation_split(pairs)
    people, goods = assemble.user_aggregates(fit_part), assemble.item_aggregates(fit_part)
    model = gbt.fit_gbt(
        assemble.with_aggregates(fit_part, people, goods),
        assemble.with_aggregates(valid_part, people, goods),
        iterations=5,
        depth=5,
        rate=0.1,
    )
    made = assemble.candidates(valid_part, pairs, people, goods, 50)
    return list_facts(gbt.rank_candidates(model, made, K))


@query(
    "run_trials",
    "SELECT CAST(i AS BIGINT) AS place, 'ease' AS model, true AS ranked, true AS in_range "
    "FROM range(1, 4) t(i)",
)
def _(spark, root):
    train, test = split(spark, root)
    train, test = materialize(train, "train"), materialize(test, "test")
    best, table = experiments.run_trials(
        {"reg": (10.0, 1000.0)},
        3,
        lambda p: experiments.run_experiment("ease", train, test, "target", K, **p),
    )
    rows = table.collect()  # one row per trial
    scores = [r["ndcg"] for r in rows]
    ranked = scores == sorted(scores, reverse=True) and rows[0]["params"] == f"reg={best['reg']}"
    place = F.row_number().over(Window.orderBy(F.desc("ndcg"), "trial")).cast("bigint")
    return table.select(
        place.alias("place"),
        "model",
        F.lit(ranked).alias("ranked"),
        F.col("ndcg").between(0, 1).alias("in_range"),
    )


EXPERIMENT = (
    "SELECT '{0}' AS model, 'target' AS target, 15 AS top_k, true AS in_range, {1} AS judged, "
    "true AS beats_nothing"
)


def experiment_facts(row, errors=True):
    """Metrics within their ranges; with errors, the root mean square is no less than the mean."""
    shares = F.greatest("ndcg", "precision", "recall") <= 1
    some = F.least("ndcg", "precision", "recall") >= 0
    judged = F.col("rmse") >= F.col("mae") if errors else F.col("rmse").isNull() & F.col("mae").isNull()
    return row.select(
        "model",
        "target",
        "top_k",
        (shares & some).alias("in_range"),
        judged.alias("judged"),
        (F.col("ndcg") > 0).alias("beats_nothing"),
    )


@query("run_experiment_als", EXPERIMENT.format("als", "true"))
def _(spark, root):
    train, test = split(spark, root)
    return experiment_facts(
        experiments.run_experiment("als", train, test, factors=16, iterations=8, min_n=5)
    )


@query("run_experiment_svd", EXPERIMENT.format("svd", "true"))
def _(spark, root):
    train, test = split(spark, root)
    return experiment_facts(experiments.run_experiment("svd", train, test, steps=16))


@query("run_experiment_multvae", EXPERIMENT.format("multvae", "true"))
def _(spark, root):
    train, test = split(spark, root)
    made = experiments.run_experiment(
        "multvae", train, test, dims=(32, 8), epochs=2, batch_size=64, min_n=5
    )
    return experiment_facts(made)


@query("run_experiment_ease", EXPERIMENT.format("ease", "true"))
def _(spark, root):
    train, test = split(spark, root)
    return experiment_facts(experiments.run_experiment("ease", train, test), errors=False)


@query(
    "run_experiment_popularity",
    sql(
        "SELECT 'popularity' AS model, 'target' AS target, 15 AS top_k, round(avg(ndcg), 6) AS ndcg, "
        "round(avg(hits / 15), 6) AS precision, round(avg(hits / n), 6) AS recall FROM (SELECT user_id, "
        "coalesce(dcg / nullif(idcg, 0), 0) AS ndcg FROM dcg LEFT JOIN idcg USING (user_id)) JOIN "
        "(SELECT user_id, count(t.item_id) AS hits FROM preds p LEFT JOIN truth t USING (user_id, item_id) "
        "GROUP BY 1) USING (user_id) JOIN (SELECT user_id, sum(n) AS n FROM truth GROUP BY 1) USING (user_id)",
        "preds",
        "truth",
        extra={
            "dcg": "SELECT p.user_id, sum(coalesce(t.rel, 0) / log2(p.pos + 2)) AS dcg FROM preds p "
            "LEFT JOIN truth t USING (user_id, item_id) GROUP BY 1",
            "idcg": "SELECT user_id, sum(rel / log2(rn + 1)) AS idcg FROM (SELECT user_id, rel, "
            "row_number() OVER (PARTITION BY user_id ORDER BY rel DESC) AS rn FROM truth) "
            "WHERE rn <= 15 GROUP BY 1",
        },
    ),
)
def _(spark, root):
    train, test = split(spark, root)
    made = experiments.run_experiment("popularity", train, test, k=K)
    return tidy(made.select("model", "target", "top_k", "ndcg", "precision", "recall"))


# --- scoring -------------------------------------------------------------------

FACTORS = {
    "uf": f"SELECT user_id, [{COUNTS}] AS f FROM interactions GROUP BY 1",
    "vf": f"SELECT item_id, [{COUNTS}] AS f FROM interactions GROUP BY 1",
}


@query(
    "score_pairs",
    sql(
        "SELECT w.user_id, w.item_id, coalesce(list_dot_product(u.f, v.f), 0) AS score FROM "
        "(SELECT DISTINCT user_id, item_id FROM interactions_wide) w LEFT JOIN uf u USING (user_id) "
        "LEFT JOIN vf v USING (item_id)",
        "interactions",
        "interactions_wide",
        extra=FACTORS,
    ),
)
def _(spark, root):
    users, items = action_factors(spark, root)
    pairs = adapters.interactions_wide(spark, root).select("user_id", "item_id").distinct()
    return scoring.score_pairs(pairs, users, items)


_TOP = sql(
    "SELECT user_id, item_id, score FROM (SELECT user_id, item_id, list_dot_product(u.f, v.f) AS "
    "score, row_number() OVER (PARTITION BY user_id ORDER BY list_dot_product(u.f, v.f) DESC, "
    "item_id) AS rn FROM uf u CROSS JOIN vf v WHERE (user_id, item_id) NOT IN "
    "(SELECT (user_id, item_id) FROM interactions)) WHERE rn <= 15",
    "interactions",
    extra=FACTORS,
)


@query("recommend_top_k", _TOP)
def _(spark, root):
    users, items = action_factors(spark, root)
    seen = adapters.interactions(spark, root)
    return scoring.recommend_top_k(users, items, K, seen=seen)


@query("recommend_top_k_blocks", _TOP)
def _(spark, root):
    # The path for catalogues that are too big to broadcast.
    users, items = action_factors(spark, root)
    seen = adapters.interactions(spark, root)
    return scoring.recommend_top_k(users, items, K, seen=seen, block=32)


@query(
    "autoencoder_scores",
    sql(
        "SELECT DISTINCT user_id, item_id, user_id IN (SELECT user_id FROM often) AND item_id IN "
        "(SELECT item_id FROM often) AS scored, true AS finite FROM test",
        "train",
        "test",
        extra={"often": _frequent("train", 5)},
    ),
)
def _(spark, root):
    train, test = split(spark, root)
    made = materialize(histories.history_from_events(train, "target", min_n=5), "histories")
    items = ranking.dense_index(
        histories.min_interactions(histories.pair_confidence(train, "target"), 5),
        "item_id",
        "item_idx",
    )
    model = multvae.fit_multvae(made, items.count(), (32, 8), epochs=2, batch_size=64)
    pairs = test.select("user_id", "item_id").distinct()
    scored = multvae.score_pairs_multvae(model, made, pairs, items)
    return scored.select(
        "user_id",
        "item_id",
        (F.col("score") != 0).alias("scored"),
        (~F.isnan(F.col("score").cast("double"))).alias("finite"),
    )


@query(
    "top_k_per_user",
    sql(
        "SELECT user_id, string_agg(item_id, ',' ORDER BY rank) AS predicted_items, "
        "string_agg(n * 1000, ',' ORDER BY rank) AS predicted_scores FROM (SELECT user_id, item_id, "
        "count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, item_id) "
        "AS rank FROM interactions_wide GROUP BY 1, 2) WHERE rank <= 15 GROUP BY 1",
        "interactions_wide",
    ),
)
def _(spark, root):
    counts = (
        adapters.interactions_wide(spark, root)
        .groupBy("user_id", "item_id")
        .agg(F.count("*").cast("double").alias("score"))
    )
    return tidy(ranking.top_k_per_user(counts, K))


@query(
    "rank_list",
    sql("SELECT user_id, pos + 1 AS rank, item_id, score FROM preds", "preds"),
)
def _(spark, root):
    lists = evaluation_lists(spark, root).select("user_id", "predicted_items", "predicted_scores")
    return ranking.rank_list(lists).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "unknown_users",
    sql(
        "SELECT c_custkey AS user_id, 'unknown user ' || c_custkey AS error FROM customer "
        "WHERE c_custkey NOT IN (SELECT user_id FROM interactions WHERE user_id IS NOT NULL)",
        "interactions",
    ),
)
def _(spark, root):
    asked = adapters.users(spark, root).select("user_id")
    return scoring.unknown_users(asked, adapters.interactions(spark, root))


# --- metrics -------------------------------------------------------------------

DCG = {
    "dcg": "SELECT p.user_id, sum(coalesce(t.rel, 0) / log2(p.pos + 2)) AS dcg FROM preds p "
    "LEFT JOIN truth t USING (user_id, item_id) GROUP BY 1",
    "idcg": "SELECT user_id, sum(rel / log2(rn + 1)) AS idcg FROM (SELECT user_id, rel, row_number() "
    "OVER (PARTITION BY user_id ORDER BY rel DESC) AS rn FROM truth) WHERE rn <= 15 GROUP BY 1",
}
NDCG = sql(
    "SELECT user_id, round(coalesce(dcg / nullif(idcg, 0), 0), 6) AS ndcg FROM dcg LEFT JOIN idcg "
    "USING (user_id)",
    "preds",
    "truth",
    extra=DCG,
)


@query("ndcg_pairs", NDCG)
def _(spark, root):
    truth, preds = evaluation(spark, root)
    return tidy(metrics.ndcg_pairs(preds, truth, K))


@query("ndcg_at_k", NDCG)
def _(spark, root):
    return tidy(metrics.ndcg_at_k(evaluation_lists(spark, root), k=K))


# One user holds a third of all events.
HOT_USER = {
    "plain": VIEWS["interactions"],
    "interactions": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) "
    "FROM plain",
    **{name: VIEWS[name] for name in ("targeted", "train", "test", "truth", "pop", "preds")},
}


@query(
    "ndcg_hot_user",
    sql(
        "SELECT user_id, round(coalesce(dcg / nullif(idcg, 0), 0), 6) AS ndcg, hits, n AS truth FROM dcg "
        "LEFT JOIN idcg USING (user_id) JOIN (SELECT user_id, count(t.item_id) AS hits FROM preds p "
        "LEFT JOIN truth t USING (user_id, item_id) GROUP BY 1) USING (user_id) "
        "JOIN (SELECT user_id, CAST(sum(n) AS BIGINT) AS n FROM truth GROUP BY 1) USING (user_id)",
        extra={**HOT_USER, **DCG},
    ),
)
def _(spark, root):
    seen = adapters.interactions(spark, root)
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    train, test = splits.global_temporal_split(
        targets.create_target(seen.withColumn("user_id", hot)), 5
    )
    train, test = materialize(train, "train"), materialize(test, "test")
    recs = ranking.top_k_per_user(popularity.popular_items(train, K, users=test), K)
    lists = histories.truth_lists(test, "target").join(recs, "user_id")
    judged = metrics.ndcg_at_k(lists, k=K).join(lists, "user_id")
    hits = F.size(F.array_intersect("predicted_items", "true_items")).cast("bigint")
    return tidy(
        judged.select(
            "user_id", "ndcg", hits.alias("hits"), F.size("true_items").cast("bigint").alias("truth")
        )
    )


@query(
    "ndcg_predicted_ideal",
    sql(
        "SELECT user_id, round(coalesce(dcg / nullif(idcg, 0), 0), 6) AS ndcg FROM dcg LEFT JOIN "
        "(SELECT user_id, sum(rel / log2(rn + 1)) AS idcg FROM (SELECT p.user_id, t.rel, row_number() "
        "OVER (PARTITION BY p.user_id ORDER BY t.rel DESC) AS rn FROM preds p JOIN truth t "
        "USING (user_id, item_id)) WHERE rn <= 15 GROUP BY 1) USING (user_id)",
        "preds",
        "truth",
        extra={"dcg": DCG["dcg"]},
    ),
)
def _(spark, root):
    return tidy(metrics.ndcg_at_k_predicted_ideal(evaluation_lists(spark, root), k=K))


@query(
    "ndcg_list_order",
    sql(
        "SELECT user_id, round(coalesce(dcg / nullif(idcg, 0), 0), 6) AS ndcg FROM dcg LEFT JOIN "
        "(SELECT user_id, sum(log_target / log2(rn + 1)) AS idcg FROM (SELECT user_id, log_target, "
        "row_number() OVER (PARTITION BY user_id ORDER BY log_target DESC) AS rn FROM test) "
        "WHERE rn <= 15 GROUP BY 1) USING (user_id)",
        "preds",
        "truth",
        extra={"dcg": DCG["dcg"]},
    ),
)
def _(spark, root):
    return tidy(metrics.ndcg_at_k_list_order(evaluation_lists(spark, root), k=K))


HITS = {
    "hits": "SELECT user_id, count(t.item_id) AS hits FROM preds p LEFT JOIN truth t "
    "USING (user_id, item_id) GROUP BY 1",
}


def _pr_sql(size: str) -> str:
    return sql(
        "SELECT round(avg(hits / 15), 6) AS precision, round(avg(hits / size), 6) AS recall FROM hits "
        f"JOIN (SELECT user_id, {size} AS size FROM truth GROUP BY 1) USING (user_id)",
        "preds",
        "truth",
        extra=HITS,
    )


@query("precision_recall", _pr_sql("sum(n)"))
def _(spark, root):
    return tidy(metrics.precision_recall_at_k(evaluation_lists(spark, root), k=K))


@query("precision_recall_pairs", _pr_sql("sum(n)"))
def _(spark, root):
    truth, preds = evaluation(spark, root)
    return tidy(metrics.precision_recall_pairs(preds, truth, K))


@query("precision_recall_set", _pr_sql("count(*)"))
def _(spark, root):
    return tidy(metrics.precision_recall_set(evaluation_lists(spark, root), k=K))


@query(
    "rmse_mae",
    sql(
        "SELECT round(sqrt(avg(d * d)), 4) AS rmse, round(avg(abs(d)), 4) AS mae, count(*) AS n FROM "
        "(SELECT log_target - list_dot_product(u.f, v.f) AS d FROM test JOIN uf u USING (user_id) "
        "JOIN vf v USING (item_id))",
        "test",
        extra=FACTORS,
    ),
)
def _(spark, root):
    _train, test = split(spark, root)
    return tidy(metrics.event_errors(test, "target", *action_factors(spark, root)), 4)


@query(
    "robustness",
    sql(
        "SELECT round(avg(c / 15), 6) AS stability_mean, round(stddev_pop(c / 15), 6) AS stability_std, "
        "round(avg(c / (30 - c)), 6) AS jaccard_mean, round(stddev_pop(c / (30 - c)), 6) AS jaccard_std, "
        "round(avg(15 - s), 6) AS changed_mean, count(*) AS users FROM (SELECT a.user_id, "
        "count(b.item_id) AS c, count(*) FILTER (a.pos = b.pos) AS s FROM recs a "
        "LEFT JOIN recs2 b ON a.user_id = b.user_id AND a.item_id = b.item_id GROUP BY 1)",
        "pop",
        extra={
            "pairs": "SELECT DISTINCT user_id, item_id FROM train",
            "kept": "SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
            "ORDER BY md5('42|' || user_id || '|' || item_id), item_id) AS rn FROM pairs) WHERE rn > 1",
            "recs": "SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id "
            "ORDER BY rank) AS pos FROM (SELECT DISTINCT user_id FROM kept) CROSS JOIN pop WHERE "
            "(user_id, item_id) NOT IN (SELECT (user_id, item_id) FROM pairs)) WHERE pos <= 15",
            "recs2": "SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id "
            "ORDER BY rank) AS pos FROM (SELECT DISTINCT user_id FROM kept) CROSS JOIN pop WHERE "
            "(user_id, item_id) NOT IN (SELECT (user_id, item_id) FROM kept)) WHERE pos <= 15",
        },
    ),
)
def _(spark, root):
    train, _test = split(spark, root)
    pairs = materialize(train.select("user_id", "item_id").distinct(), "pairs")
    fewer = metrics.remove_random_items(pairs, 1, 42)
    lists = []
    for name, seen in (("before", pairs), ("after", fewer)):
        recs = popularity.popular_items(train, K, users=fewer, seen=seen)
        listed = ranking.top_k_per_user(recs.withColumn("score", -F.col("pos").cast("double")), K)
        lists.append(listed.select("user_id", F.col("predicted_items").alias(name)))
    return tidy(metrics.robustness(lists[0].join(lists[1], "user_id")))


@query(
    "compare",
    sql(
        "SELECT model, round(ndcg, 6) AS ndcg, round(ndcg - base, 6) AS delta, "
        "round((ndcg - base) / base * 100, 4) AS delta_pct FROM m, (SELECT ndcg AS base FROM m "
        "WHERE model = 'click')",
        "targeted",
        extra={"m": "SELECT action_type AS model, avg(log_target) AS ndcg FROM targeted GROUP BY 1"},
    ),
)
def _(spark, root):
    means = targets.create_target(adapters.interactions(spark, root))
    rows = means.groupBy(F.col("action_type").alias("model")).agg(F.avg("target").alias("ndcg"))
    made = metrics.compare(rows, "click")
    return tidy(made.drop("delta_pct")).join(
        tidy(made.select("model", "delta_pct"), 4), "model"
    )


# --- request log ----------------------------------------------------------------


@query(
    "log_summary",
    sql(
        "SELECT count(*) AS total_requests, round(avg(duration_ms), 6) AS avg_duration, "
        "min(duration_ms) AS min_duration, max(duration_ms) AS max_duration, "
        "count(*) FILTER (status = 'ok') AS success_count, count(*) FILTER (status = 'error') "
        "AS error_count, round(count(*) FILTER (status = 'ok') / count(*), 6) AS success_rate "
        "FROM request_log",
        "request_log",
    ),
)
def _(spark, root):
    return tidy(requestlog.log_summary(adapters.request_log(spark, root)))


@query(
    "duration_quantiles",
    sql(
        "SELECT max(CASE WHEN rn - 1 = floor(n * 0.5::DOUBLE) THEN d END) AS p50, "
        "max(CASE WHEN rn - 1 = floor(n * 0.95::DOUBLE) THEN d END) AS p95, "
        "max(CASE WHEN rn - 1 = floor(n * 0.99::DOUBLE) THEN d END) AS p99 FROM (SELECT duration_ms "
        "AS d, row_number() OVER (ORDER BY duration_ms) AS rn, count(*) OVER () AS n FROM request_log "
        "WHERE duration_ms IS NOT NULL)",
        "request_log",
    ),
)
def _(spark, root):
    return requestlog.duration_quantiles(adapters.request_log(spark, root))


SIZE = (
    "strlen('{\"user_id\":' || user_id || ',\"item_id\":\"' || item_id || "
    "'\",\"model_params\":{\"source\":\"' || source || '\"},\"model_key\":\"' || model_key || '\"}')"
)


@query(
    "request_size",
    sql(f"SELECT id, CAST({SIZE} AS BIGINT) AS request_size FROM request_log", "request_log"),
)
def _(spark, root):
    sized = requestlog.request_size(adapters.request_log(spark, root))
    return sized.select("id", F.col("request_size").cast("bigint").alias("request_size"))


@query(
    "token_estimate",
    "SELECT conv_id, turn, CAST(floor(w * 0.75) + floor(w * 0.25) + floor(r * 0.25) AS BIGINT) "
    "AS token_count FROM (SELECT conv_id, turn, len(list_filter(regexp_split_to_array(text, "
    "'[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS w, len(list_filter(regexp_split_to_array(role, "
    "'[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS r FROM conversations)",
)
def _(spark, root):
    # Whole conversation texts stand in for item names of many words.
    talk = adapters.table(spark, root, "conversations")
    made = requestlog.token_estimate(talk, "text", ("text", "role"))
    return made.select("conv_id", "turn", "token_count")


# Item names of one to seven words, as the log's own are single words.
NAMED = {
    "named": "SELECT * REPLACE (item_id || repeat(' x', CAST(id % 7 AS INTEGER)) AS item_id) "
    "FROM request_log",
}
TOKENS = "floor((1 + id % 7) * 0.75::DOUBLE) + floor((1 + id % 7) * 0.25::DOUBLE)"


def named_log(spark, root):
    words = F.expr("repeat(' x', cast(id % 7 as int))")
    return adapters.request_log(spark, root).withColumn("item_id", F.concat("item_id", words))


@query(
    "by_model",
    sql(
        "SELECT model_key, count(*) AS request_count, round(avg(duration_ms), 6) AS avg_duration, "
        f"round(avg({SIZE}), 6) AS avg_request_size, round(avg({TOKENS}), 6) AS avg_token_count FROM named "
        "GROUP BY 1",
        "request_log",
        extra=NAMED,
    ),
)
def _(spark, root):
    return tidy(requestlog.by_model(requestlog.with_request_metrics(named_log(spark, root))))


@query(
    "size_summary",
    sql(
        f"SELECT round(avg({SIZE}), 6) AS avg_request_size, round(avg({TOKENS}), 6) AS avg_token_count, "
        "count(DISTINCT model_key) AS models FROM named",
        "request_log",
        extra=NAMED,
    ),
)
def _(spark, root):
    return tidy(requestlog.size_summary(named_log(spark, root)))


@query(
    "log_histograms",
    sql(
        "SELECT 'status' AS kind, status AS bucket, count(*) AS count FROM request_log GROUP BY 2 "
        "UNION ALL SELECT 'model', model_key, count(*) FROM request_log GROUP BY 2 UNION ALL "
        "SELECT 'latency', CAST(CAST(least(floor((duration_ms - lo) / CAST(hi - lo AS DOUBLE) * 20), 19) "
        "AS BIGINT) AS VARCHAR), count(*) FROM request_log, (SELECT min(duration_ms) AS lo, "
        "max(duration_ms) AS hi FROM request_log) WHERE duration_ms IS NOT NULL GROUP BY 2",
        "request_log",
    ),
)
def _(spark, root):
    return requestlog.log_histograms(adapters.request_log(spark, root))


@query(
    "latest",
    sql(
        "SELECT id, user_id, model_key, status FROM request_log ORDER BY created_at DESC, id DESC",
        "request_log",
    ),
)
def _(spark, root):
    listed = requestlog.latest(adapters.request_log(spark, root))
    return listed.select("id", "user_id", "model_key", "status")
