import hashlib
import math
import random

from pyspark.sql import functions as F

from clickloom.llm import chat, mixing

SCHEMA = "doc_id long, text string, source string, copies long, row int"


def plain_targets(sizes, weights=(5, 2, 1), cap=3.0):
    """Share by weight, cut at the cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level >= cap * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: cap * sizes[s] for s in above}
        open_ -= above
    return target


def table(spark, seed=1, n=400):
    rng = random.Random(seed)
    names = ["hot"] * 12 + ["b", "a", "é", "Z", "tiny", None, ""]
    rows = []
    for i in range(n):
        source = rng.choice(names)
        words = rng.choice([0, 1, 5, 40, 400]) if source != "tiny" else 1
        rows.append((i, None if i % 57 == 0 else " ".join(["w"] * words), source, i, i))
    rows += [(7, "same row", "b", 0, 0)] * 3 + [(None, "no id", "a", 0, 0)]
    rows += [(9000, "\x85one word \t\x0b two", "a", 0, 0)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_mix_meets_targets(spark):
    rows, df = table(spark)
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        words = (r["text"] or "").translate(dict.fromkeys([9, 10, 11, 12, 13], " ")).split(" ")
        assert r["size"] == len([w for w in words if w])
    want = plain_targets(sizes)
    for source, words in sizes.items():
        mine = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == words for r in mine)
        assert all(math.isclose(r["target"], want[source], abs_tol=1e-6) for r in mine)
        assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in mine)
        share = want[source] / words if words else 0
        largest = max(r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[source]) <= 3 * largest
        assert abs(sum(r["copies"] for r in mine) - share * len(mine)) <= 1
    assert math.isclose(sum(want.values()), sum(sizes.values()))


def test_mix_is_repeatable_whatever_the_partitions(spark):
    rows, df = table(spark)
    pick = lambda d: sorted((repr(tuple(r)) for r in mixing.mix_sources(d).collect()))
    assert pick(df) == pick(df.repartition(7))


def test_mix_emits_copies_with_all_columns(spark):
    rows, df = table(spark)
    taken = {}
    for r in mixing.mix_sources(df.select("doc_id", "text", "source")).collect():
        key = (r["doc_id"], r["text"], r["source"])
        taken[key] = taken.get(key, 0) + r["copies"]
    out = mixing.emit_copies(df)
    assert out.columns == df.columns
    seen = {}
    for r in out.collect():
        key = (r["doc_id"], r["text"], r["source"])
        seen[key] = seen.get(key, 0) + 1
        assert r["doc_id"] is None or r["doc_id"] in (7, 9000) or r["copies"] == r["doc_id"]
    assert seen == {k: n for k, n in taken.items() if n}


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(empty).count() == 0 and mixing.emit_copies(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, 0, 0)], SCHEMA)
    row = mixing.mix_sources(blank).first()
    assert (row["size"], row["source_size"], row["target"], row["taken"]) == (0, 0, 0.0, 0)


def test_no_python_in_native_plans(spark):
    _, df = table(spark)
    turns = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    for out in (mixing.mix_sources(df), mixing.emit_copies(df), chat.format_chat(turns)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


TURNS = "conv_id long, turn long, role string, text string, formatted string, mask int"


def conversations():
    rng = random.Random(2)
    bits = ["\\", "<", ">", "\\l", "\\b", "<next>", "</turn>\n", "<turn user>", "é", "\n", "ok", "😀", ""]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
            role = rng.choice(["user", "assistant", "assistant", "system", "a<b>\\", None])
            rows.append((conv, turn, role, rng.choice([text, None]) if turn % 4 == 0 else text))
    rows += [(50, None, "user", "null turn"), (50, 1, "user", "tie"), (50, 1, "user", "tie")]
    rows += [(50, 1, "assistant", "tie"), (None, 0, "assistant", "no id"), (51, 0, None, None)]
    return rows


def test_chat_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    out = chat.format_chat(df)
    got = out.select(
        "conv_id",
        "formatted",
        "mask",
        chat.parse_chat(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss"),
    ).collect()
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text or "", role))
    assert len(got) == len(convs)
    for r in got:
        want = [(role, text) for *_, text, role in sorted(convs[r["conv_id"]], key=lambda t: t[:5])]
        assert [tuple(t) for t in r["turns"]] == want
        said = [text for role, text in want if role == "assistant"]
        assert r["loss"] == "".join(said) and len(r["mask"]) == len(said)
        for span, text in zip(r["mask"], said):
            safe = text.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g")
            assert r["formatted"][span["begin"] : span["end"]] == safe
        blocks = [i for i, t in enumerate(want) if i == 0 or t[0] != want[i - 1][0]]
        assert r["formatted"].count("<turn") == r["formatted"].count("</turn>\n") == len(blocks)
        assert r["formatted"].count("<next>") == len(want) - len(blocks)


def test_chat_template(spark):
    rows = [(1, 0, "user", "hello"), (1, 1, "user", "a < b?"), (1, 2, "assistant", "yes\\")]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], TURNS)
    row = chat.format_chat(df).first()
    assert row["formatted"] == "<turn user>hello<next>a \\l b?</turn>\n<turn assistant>yes\\b</turn>\n"
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_long_conversation(spark):
    df = spark.range(3000).selectExpr(
        "1L conv_id", "id turn", "if(id % 3 = 0, 'assistant', 'user') role", "concat('t', id) text"
    )
    row = chat.format_chat(df).select(
        F.sha2(chat.masked_text(F.col("formatted"), F.col("mask")), 256).alias("h")
    ).first()
    want = "".join(f"t{i}" for i in range(0, 3000, 3))
    assert row["h"] == hashlib.sha256(want.encode()).hexdigest()
