import hashlib
import random

from pyspark.sql import functions as F

from clickloom.llm import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(*values):
    out = ""
    for v in values:
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def climb(nodes):
    """Levels of a tree, bottom first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def siblings_of(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 8])))
        i //= 8
    return out


def plain_manifest(rows):
    """(id, lang, leaf) -> sorted (id, leaf, subroot, root, proof) of every row."""
    groups = {}
    for key, lang, leaf in rows:
        groups.setdefault(lang, []).append((key is not None, key or 0, leaf, key))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([leaf for _, _, leaf, _ in sorted(groups[g], key=lambda m: m[:3])]) for g in order}
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for i, (_, _, leaf, key) in enumerate(sorted(groups[g], key=lambda m: m[:3])):
            proof = siblings_of(trees[g], i) + siblings_of(top, at)
            out.append((key, leaf, trees[g][-1][0], top[-1][0], "".join(a + b for a, b in proof)))
    return sorted(out, key=repr)


def check(spark, rows):
    df = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows],
        "doc_id long, lang string, leaf string, node string, pos int, grp int",
    )
    found = merkle.proofs(merkle.build(df))
    got = found.select(
        "row.doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("proof")).alias("proof"),
        merkle.folded(F.col("leaf"), F.col("proof")).alias("folded"),
        merkle.folded(F.lit("0" * 64), F.col("proof")).alias("forged"), "row.node",
    ).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == plain_manifest(rows)
    assert all(r["folded"] == r["root"] != r["forged"] and r["node"] == "x" for r in got)


def test_groups_of_any_size(spark):
    sizes = [1, 2, 8, 9, 64, 65, 511, 512, 513, 520, 1100, 4100]
    check(spark, [(i * 7 % 5003, f"g{n}", sha(f"{n} {i}")) for n in sizes for i in range(n)])


def test_groups_nulls_and_ties(spark):
    rng = random.Random(4)
    rows = []
    for lang, count in [(None, 3), ("", 1), ("é", 70), ("zz", 9), ("en", 600), ("=", 8)]:
        rows += [(rng.choice([None, *range(40)]), lang, sha(f"{lang}{i}")) for i in range(count)]
    rows += rows[:5] + [rows[5]] * 3
    check(spark, rows)


def test_many_groups(spark):
    check(spark, [(i, f"g{i % 530:03d}", sha(str(i))) for i in range(700)])


def test_leaf_tells_null_from_empty(spark):
    df = spark.createDataFrame(
        [(1, "é\n", None), (None, "", 5), (-3, None, 0)], "a long, b string, c long"
    )
    got = df.select("a", "b", "c", merkle.leaf(F.col("a"), F.col("b"), F.col("c")).alias("leaf"))
    for r in got.collect():
        assert r["leaf"] == plain_leaf(r["a"], r["b"], r["c"])


def test_very_long_text(spark):
    text = "Wörter " * 300_000
    df = spark.createDataFrame([(1, text)], "a long, b string")
    assert df.select(merkle.leaf(F.col("a"), F.col("b"))).first()[0] == plain_leaf(1, text)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, leaf string")
    assert merkle.proofs(merkle.build(df)).count() == 0
