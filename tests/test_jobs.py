import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.operators import (
    assemble,
    basis,
    cleaning,
    counters,
    histories,
    quantiles,
    ranking,
    requestlog,
    rolling,
    splits,
    targets,
)
from clickloom.plans import mart
from clickloom.session import scratch_path
from clickloom.sources import events, factors, layers


def test_targets_count_null_actions_in_the_total(spark):
    rows = [("view",)] * 6 + [("click",)] * 3 + [("like",)] + [(None,)] * 2
    df = spark.createDataFrame(rows, "action_type string")
    made = targets.create_target(df, "unproccessed")
    got = {(r["action_type"], r["len"], r["target"]) for r in made.distinct().collect()}
    assert got == {("view", 6, 2.0), ("click", 3, 4.0), ("like", 1, 12.0)}
    assert made.count() == 10
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_targets_of_many_actions(spark):
    df = spark.range(5_000).selectExpr("concat('a', id) AS action_type", "id")
    made = targets.create_target(df, "unproccessed")
    assert made.columns == ["action_type", "id", "len", "target"]
    assert made.where("len = 1 and target = 5000").count() == 5_000


@pytest.mark.parametrize(
    "size,train,test", [(1, 8, [10]), (0.2, 7, [9, 10]), (0.05, 8, [10])]
)
def test_temporal_split_has_a_gap_day(spark, size, train, test):
    days = spark.range(1, 11).select(F.col("id").cast("int").alias("day"))
    a, b = splits.global_temporal_split(days, size)
    assert [r[0] for r in a.orderBy("day").collect()] == list(range(1, train + 1))
    assert [r[0] for r in b.orderBy("day").collect()] == test


def test_temporal_split_rejects_large_test(spark):
    with pytest.raises(ValueError):
        splits.global_temporal_split(spark.range(1, 11).withColumnRenamed("id", "day"), 9)


def test_cold_start_keeps_null_users_warm(spark):
    train = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    test = spark.createDataFrame([("u2",), ("u3",), (None,)], "user_id string")
    cold, warm = splits.split_cold_start(train, test)
    assert [r[0] for r in cold.collect()] == ["u3"]
    assert sorted((r[0] for r in warm.collect()), key=str) == [None, "u2"]


def test_counters(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "view", "u2i"), (1, 1, 1, "view", "u2i"), (1, 1, 1, "view", None), (1, 2, 1, None, "u2i")],
        "day int, user_id int, item_id int, action_type string, subdomain string",
    )
    row = counters.daily_pair_counters(df).collect()
    assert len(row) == 1
    assert row[0]["num_view_u2i"] == 2 and row[0]["num_view_all_subdomains"] == 3
    assert row[0]["num_like_other"] == 0


def enriched(spark, rows):
    schema = "day int, user_id int, brand_id int, price double, num_view_u2i long"
    return spark.createDataFrame(rows, schema)


def test_rolling_window_and_null_groups(spark):
    df = enriched(spark, [(1, 7, 1, 1.0, 2), (3, 7, 1, 2.0, 4), (3, 8, None, 9.0, 1)])
    made = rolling.rolling_features(df, ("brand_id",), 3, day_to=5, counters=["num_view_u2i"])
    got = {r["day"]: r["f_num__brand_id__sum_num_view_u2i_3d"] for r in made.collect()}
    assert got == {1: 2, 2: 2, 3: 6, 4: 4, 5: 4}


def test_rolling_absent_day(spark):
    df = enriched(spark, [(1, 7, 1, 1.0, 4), (2, 7, 1, 1.0, 0)])
    col = "f_num__brand_id__mean_num_view_u2i_2d"
    for mode, value in (("null", 4.0), ("zero", 2.0)):
        made = rolling.rolling_features(
            df, ("brand_id",), 2, absent_day=mode, counters=["num_view_u2i"]
        )
        assert made.where("day = 2").first()[col] == value


def test_rolling_clip(spark):
    df = enriched(spark, [(1, 7, 1, 1.0, 4), (2, 7, 1, 1.0, 3)])
    col = "f_num__brand_id__sum_num_view_u2i_5d"
    for clip, value in ((False, 7), (True, 3)):
        made = rolling.rolling_features(
            df, ("brand_id",), 5, day_from=2, clip_to_range=clip, counters=["num_view_u2i"]
        )
        assert made.where("day = 2").first()[col] == value


def test_rolling_price_median_is_weighted(spark):
    df = enriched(spark, [(1, u, 1, p, 1) for u, p in ((1, 1.0), (2, 2.0), (3, 10.0), (4, 10.0))])
    row = rolling.rolling_features(df, ("brand_id",), 1, counters=["num_view_u2i"]).first()
    assert row["f_num__brand_id__median_price_1d"] == 6.0
    assert row["f_num__brand_id__mean_price_1d"] == 5.75


@pytest.mark.parametrize("days, clip", [(1, False), (4, True), (30, False), (30, True)])
def test_rolling_against_every_window(spark, days, clip):
    """Gaps, days before the range, repeated days and null prices, window by window in plain Python."""
    rows = [
        (d, n % 3, n % 2, None if n % 7 == 0 else float(n * n % 11), n % 5)
        for n, d in enumerate([1, 1, 2, 5, 5, 5, 6, 14, 15, 15, 40, 41, 41, 75, 75, 76])
    ]
    df = enriched(spark, rows).withColumnRenamed("brand_id", "brand")
    df = df.withColumns({"brand_id": F.col("brand"), "user_id": F.col("user_id")}).drop("brand")
    for key, at in (("user_id", 1), ("brand_id", 2)):
        made = rolling.rolling_features(
            df, (key,), days, 3, 78, "zero", clip, counters=["num_view_u2i"]
        )
        got = {(r[key], r["day"]): r for r in made.collect()}
        want = {}
        for day in range(3, 79):
            for value in {r[at] for r in rows}:
                held = [
                    r for r in rows
                    if r[at] == value and day - days < r[0] <= day and (r[0] >= 3 or not clip)
                ]
                if held:
                    want[value, day] = held
        assert set(got) == set(want)
        for place, held in want.items():
            row, prices = got[place], pd.Series([r[3] for r in held if r[3] is not None], dtype=float)
            named = {s: row[f"f_num__{key}__{s}_price_{days}d"] for s in ("mean", "median", "min", "max")}
            for stat, value in named.items():
                expected = getattr(prices, stat)()
                assert value is None if pd.isna(expected) else value == pytest.approx(expected, rel=1e-6)
            total = sum(r[4] for r in held)
            assert row[f"f_num__{key}__sum_num_view_u2i_{days}d"] == total
            mean = row[f"f_num__{key}__mean_num_view_u2i_{days}d"]
            assert mean == pytest.approx(total / len(held), rel=1e-6)


def test_rolling_plan_does_not_grow_with_the_window(spark):
    """No exchange lies above the rows that are repeated per snapshot day."""
    df = enriched(spark, [(1, 7, 1, 1.0, 4), (2, 7, 1, 1.0, 3)])
    for key in ("user_id", "item_id"):
        wide = df.withColumn("item_id", F.col("user_id"))
        made = rolling.rolling_features(wide, (key,), 30, counters=["num_view_u2i"])
        plan = made._jdf.queryExecution().sparkPlan().toString()
        before, _, after = plan.partition("sequence(")
        assert after and "Exchange" not in before.replace("BroadcastExchange", "")


def test_group_needs_a_key():
    with pytest.raises(ValueError):
        rolling.check_group((None, None))
    assert mart.groups_from_text("user_id-item_id\n\ncategory\n") == [
        ("user_id", "item_id"),
        ("category",),
    ]
    assert mart.groups_from_text('["brand_id"]', True) == [("brand_id",)]


@pytest.mark.parametrize("rule", ["nearest", "floor", "linear"])
def test_quantiles_against_sorting(spark, rule):
    values = [((n * 7919) % 101) ** 2 for n in range(60)] + [5] * 40
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 3)], "g string, v long")
    made = quantiles.quantiles(df, "v", {"x": 0.37, "y": 0.99}, ["g"], rule, buckets=8)
    got = {r["g"]: (r["x"], r["y"]) for r in made.collect()}
    ordered = sorted(values)
    for i, q in enumerate((0.37, 0.99)):
        n = len(ordered)
        if rule == "nearest":
            want = ordered[int((n - 1) * q + 0.5)]
        elif rule == "floor":
            want = ordered[int(n * q)]
        else:
            want = pd.Series(ordered).quantile(q)
        assert got["a"][i] == pytest.approx(want)
    assert got["b"] == (3, 3)
    overall = quantiles.quantiles(df, "v", {"x": 0.5}, (), "nearest", buckets=3).first()
    assert overall["x"] == sorted(values + [3])[50]


@pytest.mark.parametrize("rule", quantiles.RULES)
def test_quantiles_of_heavy_tails(spark, rule):
    """An outlier, tiny, negative and non-finite values: results stay those of the sorted list."""
    near = [1e15 + n for n in range(300)] + [-(3.0**n) for n in range(40)] + [2.0**-n for n in range(900)]
    values = [*near, 0.0, 0.0, 1e300, -1e300, float("inf"), float("-inf"), 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = {f"q{i}": q for i, q in enumerate((0.004, 0.02, 0.2, 0.5, 0.731, 0.9, 0.99))}
    made = quantiles.quantiles(df, "v", wanted, (), rule, buckets=16, ordered=4).first()
    values.sort()
    n = len(values)
    for name, q in wanted.items():
        at = {"nearest": int((n - 1) * q + 0.5), "floor": int(n * q)}.get(rule)
        want = values[at] if at is not None else float(pd.Series(values).quantile(q))
        assert made[name] == pytest.approx(want, rel=1e-12, abs=0)


def test_quantiles_order_small_buckets_only(spark):
    """A million different values beside one outlier: no bucket that is ordered has over the bound."""
    df = spark.range(1_000_000).selectExpr("CAST(id AS DOUBLE) AS _v", "1L AS _m")
    df = df.union(spark.createDataFrame([(1e15, 1)], "_v double, _m long"))
    pos = F.lit(500_000).cast("long")
    reads = [F.struct(F.lit(0).alias("slot"), pos.alias("pos"))]
    rows, hit = quantiles._refine(df, [], reads, 64, 1_000)
    held = rows.join(hit.select("_p", "_b"), ["_p", "_b"])
    assert 0 < held.count() <= 1_000
    made = quantiles.quantiles(df, "_v", {"x": 0.5}, (), "floor", ordered=1_000).first()
    assert made["x"] == 500_000


def test_session_quantile_is_nearest_rank(spark):
    sessions = spark.range(1, 61).select(
        F.lit(1).alias("day"), F.col("id").alias("user_id"), F.col("id").alias("len")
    )
    assert basis.filter_long_sessions(sessions).agg(F.max("len")).first()[0] == 59


def test_basis_drops_view_only_sessions(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "view"), (1, 1, 2, "like"), (1, 2, 1, "view")],
        "day int, user_id int, item_id int, action_type string",
    )
    made = basis.build_basis(df).collect()
    assert {r["session_id"] for r in made} == {"1__1"}
    kept = basis.build_basis(df, drop_view_only=False).collect()
    assert {r["session_id"] for r in kept} == {"1__1", "1__2"}


def test_dataset_uses_the_day_before(spark):
    ranked = spark.createDataFrame(
        [(f"{d}__1", d, 1, 1, 0.5) for d in (1, 2, 3)],
        "session_id string, day int, user_id int, item_id int, label float",
    )
    feature = spark.createDataFrame(
        [(1, d, float(d)) for d in (1, 2, 3)], "user_id int, day int, f_num__user_id__x double"
    )
    people = spark.createDataFrame([(1, 4)], "user_id int, region int")
    made = assemble.build_dataset(ranked, {("user_id",): feature}, people).collect()
    assert {(r["day"], r["f_num__user_id__x"], r["f_cat__region"]) for r in made} == {
        (2, 1.0, "4"),
        (3, 2.0, "4"),
    }


def test_last_k_and_all(spark):
    df = spark.createDataFrame(
        [(n, "u", n, 1, n, "view") for n in range(5)] + [(9, "u", 9, 1, 9, "other")],
        "event_id int, user_id string, item_id int, day int, ts int, action_type string",
    )
    assert ranking.last_k_interactions(df, 3).first()["item_id"] == [2, 3, 4]
    assert [r["item_id"] for r in ranking.last_k_interactions(df, None).collect()] == [[0, 1, 2, 3, 4]]


def test_sequences(spark):
    df = spark.createDataFrame(
        [(n, "u", n, "view", n, float(n)) for n in range(35)] + [(99, "v", 1, "view", 1, 0.0)],
        "event_id int, user_id string, item_id int, action_type string, ts int, target double",
    )
    made = histories.build_sequences(df).orderBy("seq_len").collect()
    assert [r["seq_len"] for r in made] == list(range(3, 31))
    assert made[0]["item_sequence"] == [5, 6, 7] and made[0]["target"] == 7.0
    padded = histories.pad_sequences(histories.build_sequences(df), 30).orderBy("seq_len").first()
    assert padded["input_ids"] == [5, 6, 7] + [0] * 27
    assert padded["attention_mask"] == [1] * 3 + [0] * 27


def test_truth_lists_of_hot_users(spark):
    df = spark.createDataFrame(
        [("u", n, 1.0) for n in range(50)] + [("v", 1, 1.0)], "user_id string, item_id int, t double"
    )
    made = {r["user_id"]: r["true_items"] for r in histories.truth_lists(df, "t").collect()}
    assert made == {"u": list(range(50)), "v": [1]}


def test_position_within_hot_group(spark):
    df = spark.range(1000).select((F.col("id") % 10 == 0).cast("int").alias("g"), F.col("id"))
    made = ranking.position_within(df, ["g"], [F.desc("id")]).where("g = 0")
    rows = made.orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(900))
    assert rows[0]["id"] == 999


def test_dense_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    assert {(r["k"], r["k_idx"]) for r in ranking.dense_index(df, "k").collect()} == {
        ("a", 0),
        ("b", 1),
    }


def test_sample_users_keeps_whole_users(spark):
    df = spark.range(4000).select((F.col("id") % 400).alias("user_id"))
    kept = cleaning.sample_users(df, 0.4).groupBy("user_id").count().collect()
    assert 110 < len(kept) < 210 and {r["count"] for r in kept} == {10}


def test_duration_quantiles(spark):
    log = spark.range(100).select(F.col("id").cast("int").alias("duration_ms"))
    assert tuple(requestlog.duration_quantiles(log).first()) == (50, 95, 99)
    assert tuple(requestlog.duration_quantiles(log.limit(0)).first()) == (0, 0, 0)
    one = log.where("duration_ms = 7")
    assert tuple(requestlog.duration_quantiles(one).first()) == (7, 7, 7)


def test_log_summary_of_empty_log(spark):
    log = spark.createDataFrame([], "duration_ms int, status string")
    row = requestlog.log_summary(log).first()
    assert row["total_requests"] == 0 and row["success_rate"] == 0.0


def test_read_flat_daily_files(spark, tmp_path):
    for day in (3, 4, 7):
        pd.DataFrame({"user_id": [day, day]}).to_parquet(tmp_path / f"{day:05d}.pq")
    pd.DataFrame({"user_id": [0]}).to_parquet(tmp_path / "readme.pq")
    got = events.read_events(spark, str(tmp_path), 4, 9)
    assert {(r["day"], r["user_id"]) for r in got.collect()} == {(4, 4), (7, 7)}
    with pytest.raises(FileNotFoundError):
        events.read_events(spark, str(tmp_path), 8, 9)


def test_hot_day_is_written_and_read_in_several_files(spark, tmp_path):
    rows = [(i, 5 if i % 10 else i) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, day int")
    events.write_day_files(df, str(tmp_path))
    assert len(list(tmp_path.glob("5.*.parquet"))) > 1
    got = events.read_events(spark, str(tmp_path))
    assert sorted((r["event_id"], r["day"]) for r in got.collect()) == rows


def test_layer_rerun_replaces_only_its_days(spark):
    path = scratch_path(spark, "layer")
    df = spark.createDataFrame([(1, 10), (2, 20)], "day int, v int")
    layers.write_layer(df, path)
    layers.write_layer(spark.createDataFrame([(2, 21)], "day int, v int"), path)
    got = {(r["day"], r["v"]) for r in layers.read_layer(spark, path).collect()}
    assert got == {(1, 10), (2, 21)}


def test_factors_round_trip(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0])], "user_id int, features array<double>")
    items = df.withColumnRenamed("user_id", "item_id")
    path = factors.save_factors(df, items, scratch_path(spark, "factors"))
    users, goods = factors.load_factors(spark, path)
    assert users.first()["features"] == [0.5, 1.0] and goods.count() == 1


def test_day_files_of_a_failed_task(spark, tmp_path, monkeypatch):
    """A task that dies after its first day leaves drafts, but no day file."""
    from pyspark.sql import functions as F

    from clickloom.sources import events as source

    rows = spark.range(200).select((F.col("id") % 4).alias("day"), "id")
    broken = rows.withColumn("id", F.when(F.col("day") < 3, F.col("id")).otherwise(
        F.raise_error(F.lit("lost")).cast("long")))
    folder = str(tmp_path / "days")
    with pytest.raises(Exception, match="lost"):
        source.write_day_files(broken, folder, parts=1)
    assert source._day_files(spark, folder) == {}
    source.write_day_files(rows, folder, parts=2)
    got = source.read_events(spark, folder).select("day", "id")
    assert sorted(map(tuple, got.collect())) == sorted((i % 4, i) for i in range(200))


def test_window_facts_read_the_counters_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    rows = [(1, 2.0, 0), (1, 5.0, 1), (3, None, 0), (4, 1.5, 2)]
    made = spark.createDataFrame(rows, "day int, price double, num_a long")
    facts = rolling.window_facts(made.mapInPandas(count, made.schema), ["num_a"])
    assert (facts.first, facts.last, facts.price) == (1, 4, (1.5, 5.0))
    assert sorted(map(tuple, facts.present.collect())) == [(1, True), (3, False), (4, True)]
    assert read.value == len(rows)


def test_retail_counters_are_stored_once(spark, monkeypatch):
    from clickloom.plans import queries_mart
    from clickloom.plans.registry import QUERIES

    stored = []
    for module in (queries_mart, rolling):
        keep = module.materialize
        monkeypatch.setattr(
            module, "materialize", lambda df, name, keep=keep: stored.append(name) or keep(df, name)
        )
    assert QUERIES["retail_features"](spark, "/root/testdata/sf0.001").count() > 0
    assert stored == ["enriched"]


def test_sessions_and_user_features_are_not_broadcast(spark):
    from clickloom.plans.catalog import QUERIES

    ranked = QUERIES["build_basis"](spark, "/root/testdata/sf0.001")
    feature = spark.createDataFrame([(1, 1, 2.0)], "user_id long, day int, f double")
    rows = spark.createDataFrame([(2, 1, 7)], "day int, user_id long, item_id long")
    made = assemble.build_dataset(rows, {("user_id",): feature}, day_from=1)
    assert [r["f"] for r in made.collect()] == [2.0]
    for df in (ranked, made):
        assert "strategy=merge" in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("keys", [("user_id",), ("user_id", "item_id"), ("user_id", "brand_id"), ("brand_id",)])
@pytest.mark.parametrize("absent", ["null", "zero"])
def test_ranges_are_the_days_of_the_layer(spark, tmp_path, keys, absent):
    """Rows per range of days hold those per day; they shuffle and store fewer, and join the same."""
    rng = np.random.default_rng(21)
    cells = {(int(d), int(u), int(i)) for d, u, i in zip(rng.integers(3, 60, 150), rng.integers(0, 5, 150), rng.integers(0, 6, 150))}
    rows = [(d, u, i, i % 3 or None, None if i == 4 else float(i), int(rng.integers(0, 3))) for d, u, i in sorted(cells)]
    df = spark.createDataFrame(
        rows, "day int, user_id long, item_id long, brand_id long, price double, num_view_u2i long"
    )
    kw = {"absent_day": absent, "day_from": 10, "counters": ["num_view_u2i"]}
    want = rolling.rolling_features(df, keys, 9, **kw)
    got = rolling.rolling_features(df, keys, 9, ranges=True, **kw)
    if "user_id" not in keys:
        assert got.columns == want.columns
        return
    listed = sorted(map(tuple, want.collect()), key=repr)
    daily = rolling.each_day(got).select(*want.columns)
    assert sorted(map(tuple, daily.collect()), key=repr) == listed and got.count() < len(listed)
    layers.write_ranges(got, str(tmp_path / "layer"), days=7)
    again = layers.read_layer(spark, str(tmp_path / "layer")).select(*want.columns)
    assert sorted(map(tuple, again.collect()), key=repr) == listed
    ranked = df.selectExpr(
        "concat(day, '__', user_id) session_id", "day", "user_id", "item_id", "brand_id", "float(1) label"
    )
    one = assemble.build_dataset(ranked, {keys: want}, by_day=True)
    two = assemble.build_dataset(ranked, {keys: got})
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_whole_numbers_are_rounded_as_others(spark):
    from clickloom.plans.queries_mart import _flat

    values = [0.0, -0.0, 3.0, -7.0, 1e300, 0.00005, 2.34565, -1.99995, 1 / 3, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, f_num__x double")
    plain = df.selectExpr("n", "round(f_num__x, 4) AS f_num__x")
    assert repr(sorted(map(tuple, _flat(df).collect()))) == repr(sorted(map(tuple, plain.collect())))
