import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.functions.numerics import top_columns
from clickloom.operators import scoring
from clickloom.operators.models import als, blocks as matrix, ease, multvae, popularity, svd
from clickloom.plans.experiments import draw, run_trials


@pytest.fixture(scope="module")
def blocks(spark):
    """Two groups of users, each active on its own half of the items."""
    rng = np.random.default_rng(1)
    rows = [
        (u, i, 1.0)
        for u in range(40)
        for i in range(20)
        if rng.random() < (0.5 if (u % 2) == (i // 10) else 0.02)
    ]
    return spark.createDataFrame(rows, "user_id long, item_id long, target double").cache()


def share_in_block(recs):
    own = (F.col("user_id") % 2) == F.floor(F.col("item_id") / 10)
    return recs.agg(F.avg(own.cast("double"))).first()[0]


def test_top_columns_breaks_ties_by_column():
    scores = np.array([[1.0, 3.0, 3.0, 3.0, 0.0], [5.0, 4.0, 3.0, 2.0, 1.0]])
    assert top_columns(scores, 2).tolist() == [[1, 2], [0, 1]]


def test_als_recovers_blocks(blocks):
    model = als.fit_als(blocks, "target", factors=4, iterations=5, alpha=10.0, reg=0.05, min_n=1)
    recs = scoring.recommend_top_k(model.users, model.items, 2, seen=model.pairs)
    assert share_in_block(recs) > 0.8
    seen = recs.join(model.pairs, ["user_id", "item_id"], "left_semi")
    assert seen.count() == 0


def test_als_solves_its_normal_equations(spark, monkeypatch):
    """Each side, given the other; rows shorter and longer than the factors, long ones added up."""
    monkeypatch.setattr(matrix, "LEAST", 8)
    monkeypatch.setattr(matrix, "CHUNK", 40)
    monkeypatch.setattr(als, "LONG", 25)
    monkeypatch.setattr(als, "SOLVED", 30)
    rng = np.random.default_rng(9)
    r = np.where(rng.random((60, 45)) < rng.random((60, 1)), rng.integers(-1, 4, (60, 45)), 0)
    r[:, 0], r[0, :], r[3, 1:] = 1, 1, 0
    cells = [(u, i, float(r[u, i])) for u, i in zip(*np.nonzero(r))] + [(5, int(np.flatnonzero(r[5] == 0)[0]), 0.0)]
    events = spark.createDataFrame([(int(u), int(i), v) for u, i, v in cells], "user_id long, item_id long, target double")
    model = als.fit_als(events, "target", factors=6, iterations=2, alpha=3.0, reg=0.1, min_n=1)
    x = np.array([row["features"] for row in model.users.orderBy("user_id").collect()])
    y = np.array([row["features"] for row in model.items.orderBy("item_id").collect()])
    assert x.shape == (60, 6) and y.shape == (45, 6)
    for u in range(60):
        c = 3.0 * np.abs(r[u])
        left = y.T @ y + (y * c[:, None]).T @ y + 0.1 * (r[u] > 0).sum() * np.eye(6)
        want = np.linalg.solve(left, y.T @ ((1 + c) * (r[u] > 0)))
        assert np.allclose(x[u], want, atol=1e-4), u


def test_als_ends_as_low_as_sparks(spark, blocks):
    from pyspark.ml.recommendation import ALS

    rows = blocks.toPandas()
    p = np.zeros((40, 20))
    p[rows["user_id"], rows["item_id"]] = 1.0

    def loss(users, items):
        x = np.array([row[1] for row in sorted(users.collect())])
        y = np.array([row[1] for row in sorted(items.collect())])
        n = p.sum(axis=1) @ (x**2).sum(axis=1) + p.sum(axis=0) @ (y**2).sum(axis=1)
        return ((1 + 10 * p) * (p - x @ y.T) ** 2).sum() + 0.05 * n

    model = als.fit_als(blocks, "target", factors=4, iterations=12, alpha=10.0, reg=0.05, min_n=1)
    spark_als = ALS(
        rank=4, maxIter=12, regParam=0.05, alpha=10.0, implicitPrefs=True, userCol="user_id",
        itemCol="item_id", ratingCol="target", seed=1,
    )
    other = spark_als.fit(blocks.selectExpr("int(user_id) user_id", "int(item_id) item_id", "target"))
    assert loss(model.users, model.items) < 1.1 * loss(other.userFactors, other.itemFactors)


def test_svd_matches_numpy(spark):
    rng = np.random.default_rng(3)
    dense = np.where(rng.random((50, 30)) < 0.4, rng.random((50, 30)) * 5, 0.0)
    rows = [(int(u), int(i), float(dense[u, i])) for u, i in zip(*np.nonzero(dense))]
    pairs = spark.createDataFrame(rows, "user_id long, item_id long, value double")
    users, items, sigma = svd.truncated_svd(pairs, 4, steps=5, oversample=4)
    left, true, right = np.linalg.svd(dense)
    assert np.allclose(sigma, true[:4], atol=1e-5)
    u = {r["user_id"]: r["features"] for r in users.collect()}
    v = {r["item_id"]: r["features"] for r in items.collect()}
    best = left[:, :4] * true[:4] @ right[:4]
    got = np.array([[np.dot(u[a], v[b]) for b in range(30)] for a in range(50)])
    assert np.allclose(got, best, atol=1e-3)


def test_ease_closed_form(blocks):
    model = ease.fit_ease(blocks, reg=5.0, tasks=3)
    rows = blocks.toPandas()
    x = np.zeros((40, 20))
    np.add.at(x, (rows["user_id"], rows["item_id"]), 1.0)
    inverse = np.linalg.inv(x.T @ x + 5.0 * np.eye(20))
    want = -inverse / np.diag(inverse)
    np.fill_diagonal(want, 0.0)
    got = np.stack([r["weights"] for r in model.weights.orderBy("item_idx").collect()]).T
    assert np.allclose(got, want, atol=1e-10)
    assert share_in_block(ease.recommend_ease(model, 2)) > 0.8


def test_ease_in_tiles(blocks, monkeypatch):
    """Several tiles, shards and column blocks; nothing but small facts reaches the driver."""
    from pyspark.sql.classic.dataframe import DataFrame

    from clickloom.operators import scoring

    monkeypatch.setattr(ease, "TILE", 8)
    monkeypatch.setattr(ease, "ENTRIES", 20)
    monkeypatch.setattr(ease, "FAN", 2)
    monkeypatch.setattr(scoring, "COLUMN_MB", 0)
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("table sent to the driver"))
    model = ease.fit_ease(blocks, reg=5.0, tasks=3)
    recs = ease.recommend_ease(model, 4).collect()
    monkeypatch.undo()
    rows = blocks.toPandas()
    x = np.zeros((40, 20))
    np.add.at(x, (rows["user_id"], rows["item_id"]), 1.0)
    inverse = np.linalg.inv(x.T @ x + 5.0 * np.eye(20))
    want = -inverse / np.diag(inverse)
    np.fill_diagonal(want, 0.0)
    got = np.stack([r["weights"] for r in model.weights.orderBy("item_idx").collect()]).T
    assert np.allclose(got, want, atol=1e-10)
    scores = np.where(x > 0, -np.inf, x @ want)
    best = {u: np.sort(s[np.isfinite(s)])[::-1][:4] for u, s in enumerate(scores)}
    for user in {r["user_id"] for r in recs}:
        mine = [r for r in recs if r["user_id"] == user]
        assert np.allclose(sorted((r["score"] for r in mine), reverse=True), best[user])
        assert all(np.isclose(scores[user, r["item_id"]], r["score"]) for r in mine)
    assert {r["user_id"] for r in recs} == {int(u) for u in np.flatnonzero(x.any(axis=1))}


def test_blocked_and_broadcast_scoring_agree(spark):
    rng = np.random.default_rng(5)
    users = spark.createDataFrame(
        [(n, rng.normal(size=3).tolist()) for n in range(30)], "user_id long, features array<double>"
    )
    items = spark.createDataFrame(
        [(n, rng.normal(size=3).tolist()) for n in range(50)], "item_id long, features array<double>"
    )
    seen = spark.createDataFrame(
        [(u, int(i)) for u in range(30) for i in rng.choice(50, 20, replace=False)],
        "user_id long, item_id long",
    )

    def key(df):
        return sorted((r["user_id"], r["item_id"], round(r["score"], 9)) for r in df.collect())

    one = scoring.recommend_top_k(users, items, 5, seen)
    two = scoring.recommend_top_k(users, items, 5, seen, block=7)
    assert key(one) == key(two) and one.count() == 150


def test_scoring_repeats_neither_users_nor_items(spark, monkeypatch):
    monkeypatch.setattr(scoring, "USER_CHUNK", 4)
    monkeypatch.setattr(scoring, "SLICE", 5)
    rng = np.random.default_rng(6)
    people = rng.integers(-2, 3, (30, 3)).astype(float)
    goods = rng.integers(-2, 3, (40, 3)).astype(float)  # many equal scores
    users = spark.createDataFrame(list(enumerate(people.tolist())), "user_id long, features array<double>")
    items = spark.createDataFrame(list(enumerate(goods.tolist())), "item_id long, features array<float>")
    recs = scoring.recommend_top_k(users, items, 6, block=7)
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "CoGroup" not in plan
    got = sorted((r["user_id"], -r["score"], r["item_id"]) for r in recs.collect())
    want = []
    for user, scores in enumerate(people @ goods.T):
        want += [(user, -scores[i], int(i)) for i in np.argsort(-scores, kind="stable")[:6]]
    assert got == want


def test_scores_that_single_precision_cannot_tell_apart(spark, monkeypatch):
    """Differences far under a float's, lengths from 1e-150 to 1e150, ties, zeros and seen items."""
    monkeypatch.setattr(scoring, "SLICE", 16)
    rng = np.random.default_rng(12)
    base = rng.normal(size=4)
    goods = base + rng.integers(0, 6, (150, 4)) * 1e-11
    goods[40], goods[90] = 0.0, base * 1e-3
    people = np.stack([base * 10.0 ** (e * 15) for e in range(-10, 11)] + [np.zeros(4), -base])
    users = spark.createDataFrame(list(enumerate(people.tolist())), "user_id long, features array<double>")
    items = spark.createDataFrame(list(enumerate(goods.tolist())), "item_id long, features array<double>")
    seen = spark.createDataFrame([(u, i) for u in range(23) for i in range(u, 150, 7)], "user_id long, item_id long")
    recs = scoring.recommend_top_k(users, items, 5, seen, block=33)
    exact = np.einsum("uf,if->ui", people, goods)
    for user in range(23):
        mine = sorted((r for r in recs.collect() if r["user_id"] == user), key=lambda r: (-r["score"], r["item_id"]))
        left = [i for i in range(150) if (i - user) % 7 or i < user]
        want = sorted(left, key=lambda i: (-exact[user, i], i))[:5]
        got = [exact[user, r["item_id"]] for r in mine]
        assert len(mine) == 5 and np.allclose(got, exact[user, want], rtol=2e-15, atol=0), user


def test_long_catalogues_are_ruled_out_in_single_precision(monkeypatch):
    """Scores in double precision only where one of the k best may change."""
    rng = np.random.default_rng(13)
    people, goods = rng.normal(size=(20, 8)), rng.normal(size=(4_000, 8))
    done = []
    merge = scoring._Best._merge
    monkeypatch.setattr(scoring._Best, "_merge", lambda self, r, c, v: (done.append(len(r)), merge(self, r, c, v)))
    best = scoring._Best(people, pd.Series([None] * 20), 5)
    for start in range(0, 4_000, 1_000):
        best.add(scoring._Goods(goods[start : start + 1_000], start))
    scores = people @ goods.T
    assert (best.best == np.argsort(-scores, axis=1, kind="stable")[:, :5]).all()
    assert sum(done) < 20 * 60


def test_sweeping_ends_with_the_fit(spark, monkeypatch):
    monkeypatch.setattr(als, "SWEEP_S", 0.05)
    ran = []
    with als.swept(spark):
        ran += [t.name for t in threading.enumerate()]
    assert len(ran) > len(threading.enumerate())


def test_popularity_skips_seen_items(spark):
    events = spark.createDataFrame(
        [("u", i) for i in (1, 1, 1, 2, 2)] + [("v", 3), ("w", 4)], "user_id string, item_id int"
    )
    recs = popularity.popular_items(events, 2).orderBy("user_id", "pos").collect()
    got = {}
    for r in recs:
        got.setdefault(r["user_id"], []).append(r["item_id"])
    assert got == {"u": [3, 4], "v": [1, 2], "w": [1, 2]}
    everything = popularity.popular_items(events, 9, filter_seen=False).where("user_id = 'u'")
    assert everything.count() == 4


def test_vae_gradient_against_differences():
    rng = np.random.default_rng(0)
    dims, n = (5, 2), 7
    weights = {k: v.astype(np.float64) for k, v in multvae.init_weights(n, dims, 1).items()}
    x = (rng.random((4, n)) < 0.5).astype(float) + 0.1
    mask = (rng.random((4, n)) < 0.5) / 0.5
    noise = rng.normal(size=(4, 2))
    loss, grads = multvae.loss_and_gradients(x, weights, 2, 0.3, mask, noise)
    for name, g in grads.items():
        at = tuple(rng.integers(0, s) for s in g.shape)
        kept = weights[name][at]
        ends = []
        for step in (1e-5, -1e-5):
            weights[name][at] = kept + step
            ends.append(multvae.loss_and_gradients(x, weights, 2, 0.3, mask, noise)[0])
        weights[name][at] = kept
        assert g[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-6), name


def test_vae_learns_blocks(spark, blocks):
    histories = blocks.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "target"))).alias("h")
    ).select("user_id", F.col("h.item_id").alias("item_idx"), F.col("h.target").alias("weight"))
    model = multvae.fit_multvae(
        histories, 20, (16, 4), dropout=0.2, epochs=40, batch_size=1_000, lr=0.05,
        total_anneal_steps=0, beta=0.01, tasks=2,
    )
    assert model.losses[-1] < model.losses[0]
    items = spark.range(20).select(F.col("id").alias("item_id"), F.col("id").alias("item_idx"))
    recs = multvae.recommend_multvae(model, histories, items, 3)
    assert share_in_block(recs) > 0.7
    asked = spark.createDataFrame([(0, 1), (0, 99), (77, 1)], "user_id long, item_id long")
    scored = {
        (r["user_id"], r["item_id"]): r["score"]
        for r in multvae.score_pairs_multvae(model, histories, asked, items).collect()
    }
    assert scored[(0, 99)] == 0.0 and scored[(77, 1)] == 0.0 and scored[(0, 1)] != 0.0


def test_vae_does_not_depend_on_tasks(spark, blocks):
    histories = blocks.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "target"))).alias("h")
    ).select("user_id", F.col("h.item_id").alias("item_idx"), F.col("h.target").alias("weight"))
    made = [
        multvae.fit_multvae(histories, 20, (8, 3), epochs=2, batch_size=20, tasks=n) for n in (2, 8)
    ]
    for name, w in made[0].weights.items():
        assert (w == made[1].weights[name]).all()
    assert made[0].losses == made[1].losses


def test_anneal():
    assert multvae.anneal(5, 10, 0.2) == pytest.approx(0.1)
    assert multvae.anneal(5, 10, 0.2, "cosine") == pytest.approx(0.1)
    assert multvae.anneal(3, 0, 0.2) == 0.2
    with pytest.raises(ValueError):
        multvae.anneal(1, 2, 0.1, "steps")


def test_trials_pick_the_best(spark):
    def objective(params):
        value = -((params["x"] - 3) ** 2)
        return spark.createDataFrame([(float(params["x"]), float(value))], "x double, ndcg double")

    space = {"x": (0, 10)}
    best, table = run_trials(space, 4, objective, seed=1)
    trials = draw(space, 4, seed=1)
    assert best == max(trials, key=lambda t: -((t["x"] - 3) ** 2))
    assert table.count() == 4


def test_no_items_no_recommendations(spark):
    users = spark.createDataFrame([(1, [1.0])], "user_id long, features array<double>")
    none = spark.createDataFrame([], "item_id long, features array<double>")
    assert scoring.recommend_top_k(users, none, 3).columns == ["user_id", "item_id", "score"]


def test_popularity_experiment(spark, blocks):
    from clickloom.plans.experiments import run_experiment

    test = blocks.where("user_id < 5").withColumn("item_id", F.col("item_id") + 1)
    row = run_experiment("popularity", blocks, test, k=5).first()
    assert row["model"] == "popularity" and 0 <= row["ndcg"] <= 1 and row["rmse"] is None


@pytest.mark.parametrize(
    "dense",
    [
        np.outer(np.arange(1, 31), np.arange(1, 26) % 7 + 1.0),
        np.random.default_rng(3).normal(size=(30, 3)) @ np.random.default_rng(4).normal(size=(3, 40)),
        np.random.default_rng(5).normal(size=(3, 60)),
        np.zeros((4, 5)),
        np.array([[2.0]]),
        np.random.default_rng(6).normal(size=(12, 9)),
    ],
    ids=["rank 1", "rank 3", "3 users, 60 items", "zero", "1x1", "full rank"],
)
def test_svd_of_any_rank(spark, dense):
    cells = [(u, i, float(dense[u, i])) for u in range(dense.shape[0]) for i in range(dense.shape[1])]
    pairs = spark.createDataFrame(cells, "user_id long, item_id long, value double")
    users, items, sigma = svd.truncated_svd(pairs, 6, steps=5, oversample=3)
    true = np.linalg.svd(dense, compute_uv=False)
    got = np.zeros(max(len(sigma), len(true)))
    got[: len(sigma)] = sigma
    top = max(true[0], 1.0)
    assert np.allclose(got[: len(true)][:6], true[:6], atol=1e-6 * top)
    v = np.array([r["features"] for r in items.orderBy("item_id").collect()])
    residual = dense.T @ (dense @ v) - v * np.array(sigma) ** 2
    assert np.abs(residual).max() < 1e-6 * top**2
    assert np.allclose(v.T @ v, np.eye(len(sigma)), atol=1e-8)
    u = np.array([r["features"] for r in users.orderBy("user_id").collect()])
    assert np.allclose(u, dense @ v, atol=1e-8 * top)


def test_svd_in_blocks_until_it_settles(spark, monkeypatch):
    """Many small blocks; too few steps for a slowly falling spectrum, so the space is renewed."""
    monkeypatch.setattr(matrix, "LEAST", 1)
    monkeypatch.setattr(matrix, "MOST", 40)
    monkeypatch.setattr(matrix, "CHUNK", 50)
    rng = np.random.default_rng(8)
    dense = np.where(rng.random((90, 70)) < 0.3, rng.random((90, 70)), 0.0)
    rows = [(int(u) * 7, int(i), float(dense[u, i])) for u, i in zip(*np.nonzero(dense))]
    pairs = spark.createDataFrame([*rows, (None, 3, 1.0), (2, None, 1.0)], "user_id long, item_id long, value double")
    users, items, sigma = svd.truncated_svd(pairs, 3, steps=4, oversample=1, tolerance=1e-6)
    v = np.array([r["features"] for r in items.orderBy("item_id").collect()])
    u = np.array([r["features"] for r in users.orderBy("user_id").collect()])
    assert np.allclose(sigma, np.linalg.svd(dense, compute_uv=False)[:3], atol=1e-8)
    gap = np.linalg.norm(dense.T @ (dense @ v) - v * np.array(sigma) ** 2, axis=0)
    assert gap.max() < 2e-6 * sigma[0] ** 2
    assert np.allclose(u, dense @ v, atol=1e-10)


def test_vae_steps_share_jobs(spark, blocks, monkeypatch):
    histories = blocks.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "target"))).alias("h")
    ).select("user_id", F.col("h.item_id").alias("item_idx"), F.col("h.target").alias("weight"))
    sc, made, jobs = spark.sparkContext, [], []
    entries = histories.agg(F.sum(F.size("item_idx"))).first()[0]
    # All steps of an epoch in one task; in three groups; one by one over the shards.
    for group, work in ((entries, 1 << 28), (entries // 3 + 1, 1 << 28), (entries // 3 + 1, 0)):
        monkeypatch.setattr(multvae, "GROUP_ENTRIES", group)
        monkeypatch.setattr(multvae, "STEP_WORK", work)
        name = f"vae-{len(made)}"
        sc.setJobGroup(name, "")
        made.append(multvae.fit_multvae(histories, 20, (8, 3), epochs=1, batch_size=3))
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(name)))
        sc.setLocalProperty("spark.jobGroup.id", None)
    steps = -(-histories.count() // 3)
    assert steps > 10 and jobs[0] < steps < jobs[2]
    for other in made[1:]:
        assert other.losses == made[0].losses
        for name, w in made[0].weights.items():
            assert (w == other.weights[name]).all()
