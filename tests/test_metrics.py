import math
import random

import pytest

from clickloom.operators import metrics

SCHEMA = (
    "user_id string, true_items array<string>, relevancy array<double>, "
    "predicted_items array<string>, predicted_scores array<double>"
)
CASES = [
    ("perfect", "ABC", [3, 2, 1], "ABC", [0.9, 0.8, 0.7]),
    ("reversed", "ABC", [3, 2, 1], "CBA", [0.9, 0.8, 0.7]),
    ("miss", "XY", [5, 3], "ABC", [0.9, 0.8, 0.7]),
    ("repeat", "AAB", [3, 1, 2], "ABD", [0.9, 0.8, 0.7]),
    ("five", "ABCDE", [5, 4, 3, 2, 1], "EDCBA", [0.9, 0.8, 0.7, 0.6, 0.5]),
    ("partial", "AB", [3, 2], "B", [0.9]),
    ("tied", "AB", [3, 1], "BA", [0.5, 0.5]),
    ("empty", "A", [1], "", []),
]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [
        (u, list(t), [float(r) for r in rel], list(p), [float(s) for s in sc])
        for u, t, rel, p, sc in CASES
    ]
    return spark.createDataFrame(rows, SCHEMA)


def dcg(rels):
    return sum(r / math.log2(i + 2) for i, r in enumerate(rels))


def expected(true, rel, pred, scores, k, ideal="truth"):
    best = {}
    for item, r in zip(true, rel):
        best[item] = max(r, best.get(item, 0))
    order = sorted(range(len(pred)), key=lambda i: (-scores[i], i))
    gains = [best.get(pred[i], 0) for i in order]
    pool = best.values() if ideal == "truth" else gains
    top = dcg(sorted(pool, reverse=True)[:k])
    return dcg(gains[:k]) / top if top else 0.0


def as_dict(df):
    return {r["user_id"]: r["ndcg"] for r in df.collect()}


@pytest.mark.parametrize("k", [2, 3, 10])
def test_ndcg_against_definition(frame, k):
    full = as_dict(metrics.ndcg_at_k(frame, k=k))
    older = as_dict(metrics.ndcg_at_k_predicted_ideal(frame, k=k))
    for user, *case in CASES:
        assert full[user] == pytest.approx(expected(*case, k), abs=1e-10), user
        assert older[user] == pytest.approx(expected(*case, k, "predictions"), abs=1e-10), user


def test_ndcg_known_values(frame):
    got = as_dict(metrics.ndcg_at_k(frame, k=3))
    assert got["perfect"] == pytest.approx(1.0)
    assert 0 < got["reversed"] < 1
    assert got["miss"] == 0 and got["empty"] == 0
    assert got["partial"] == pytest.approx(2 / (3 + 2 / math.log2(3)))
    assert as_dict(metrics.ndcg_at_k_predicted_ideal(frame, k=3))["partial"] == pytest.approx(1.0)


def test_ndcg_random(spark):
    rng = random.Random(42)
    items = [f"i{n}" for n in range(50)]
    rows = []
    for n in range(200):
        true = rng.choices(items, k=rng.randint(3, 14))
        pred = rng.sample(items, rng.randint(5, 19))
        rows.append(
            (
                f"u{n}",
                true,
                [rng.expovariate(0.5) for _ in true],
                pred,
                sorted((rng.random() for _ in pred), reverse=True),
            )
        )
    df = spark.createDataFrame(rows, SCHEMA)
    full = as_dict(metrics.ndcg_at_k(df, k=10))
    older = as_dict(metrics.ndcg_at_k_predicted_ideal(df, k=10))
    for user, *case in rows:
        assert full[user] == pytest.approx(expected(*case, 10), abs=1e-10)
        assert older[user] == pytest.approx(expected(*case, 10, "predictions"), abs=1e-10)


def test_list_order_uses_last_repeat_and_raw_ideal(spark):
    df = spark.createDataFrame([("u", ["A", "A"], [3.0, 1.0], ["B", "A"], [0.1, 0.9])], SCHEMA)
    got = as_dict(metrics.ndcg_at_k_list_order(df, k=5))["u"]
    assert got == pytest.approx((1 / math.log2(3)) / (3 + 1 / math.log2(3)))


def test_precision_recall(spark):
    df = spark.createDataFrame(
        [
            ("u", ["A", "A", "B"], [1.0] * 3, ["A", "C"], [2.0, 1.0]),
            ("v", [], [], ["A"], [1.0]),
        ],
        SCHEMA,
    )
    repeated = metrics.precision_recall_at_k(df, k=2).first()
    assert repeated["precision"] == pytest.approx(0.25)
    assert repeated["recall"] == pytest.approx(1 / 3)  # the empty truth is skipped
    distinct = metrics.precision_recall_set(df, k=2).first()
    assert distinct["recall"] == pytest.approx(0.25)


def test_robustness_and_compare(spark):
    df = spark.createDataFrame(
        [(["A", "B"], ["A", "B"]), (["A", "B"], ["B", "C"])],
        "before array<string>, after array<string>",
    )
    row = metrics.robustness(df).first()
    assert row["stability_mean"] == pytest.approx(0.75)
    assert row["jaccard_mean"] == pytest.approx((1 + 1 / 3) / 2)
    assert row["changed_mean"] == pytest.approx(1.0)
    results = spark.createDataFrame([("a", 0.2), ("b", 0.3)], "model string, ndcg double")
    first = metrics.compare(results, "a").first()
    assert first["model"] == "b" and first["delta_pct"] == pytest.approx(50.0)


def test_remove_random_items(spark):
    pairs = spark.createDataFrame(
        [("u", i) for i in range(5)] + [("v", 1)], "user_id string, item_id int"
    )
    left = metrics.remove_random_items(pairs, 2, 7)
    assert left.count() == 3 and {r["user_id"] for r in left.collect()} == {"u"}
    assert left.collect() == metrics.remove_random_items(pairs, 2, 7).collect()
