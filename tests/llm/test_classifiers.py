import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import linear, quality, toxicity

ROOT, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def read(spark, name):
    return spark.read.parquet(f"{ROOT}/{name}.parquet")


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def test_ngrams_are_those_of_the_text(monkeypatch):
    grams = linear.Ngrams((2, 3), 18)
    text = "abcabcab é😀" * 3

    def plain(t):
        found = set()
        for n in (2, 3):
            for i in range(len(t) - n + 1):
                one = linear.Ngrams((n,), 18)
                found |= set(one.of(t[i : i + n]).tolist())
        return found

    want = plain("abcabcab é😀" * 2)
    assert set(grams.of(text).tolist()) == want and len(grams.of(text)) == len(want)
    monkeypatch.setattr(linear, "SLICE", 5)
    assert set(grams.of(text).tolist()) == want and len(grams.of(text)) == len(want)
    assert len(grams.of("")) == 0 and len(grams.of("a")) == 0


def test_logistic_fit_separates_soft_labels():
    rows, target = [], []
    for i in range(400):
        y = i % 2
        rows.append((np.array([y, 2 + i % 5]), np.ones(2)))
        target.append(0.9 if y else 0.1)
    model = linear.fit_logistic(rows, np.array(target), np.ones(400), 8, epochs=30)
    assert abs(model.score(np.array([1, 3])) - 0.9) < 0.05
    assert abs(model.score(np.array([0, 3])) - 0.1) < 0.05


def test_label_model_recovers_accuracies():
    """Votes drawn from known accuracies; EM finds them without any label."""
    rng = np.random.default_rng(4)
    n, names = 40_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.7
    right = np.linspace(0.65, 0.95, names)
    said = np.where(rng.random((n, names)) < right, good[:, None], ~good[:, None]).astype(int)
    said[rng.random((n, names)) < 0.3] = quality.SILENT
    patterns = said @ (3 ** np.arange(names - 1, -1, -1))
    found, counts = np.unique(patterns, return_counts=True)
    model = quality.label_model(found, counts.astype(float))
    assert abs(model["prior"] - 0.7) < 0.02
    assert np.abs(model["confusion"][1, :, quality.GOOD] - right).max() < 0.03
    assert np.abs(model["confusion"][0, :, quality.BAD] - right).max() < 0.03
    posterior = dict(zip(found.tolist(), model["posterior"]))
    guess = np.array([posterior[p] >= 0.5 for p in patterns.tolist()])
    assert (guess == good).mean() > 0.9


def test_votes():
    clean = "The cat sat on the mat. Then it left, and nobody saw it again."
    assert quality.votes(None) == quality.votes("") == quality.votes("few words") == 3**8 - 1
    assert set(quality._digits(np.array([quality.votes(clean)]))[0].tolist()) == {quality.GOOD}
    shout = dict(zip(quality.LABELLERS, quality._digits(np.array([quality.votes("GO!! NOW!! " * 9)]))[0]))
    assert shout["capitals"] == shout["shouting"] == quality.BAD


@tables
def test_quality_against_labels(spark):
    """The labels are not seen in training, so all labelled rows are held out."""
    docs = read(spark, "documents")
    scored = quality.score(docs, quality.train(docs))
    rows = scored.join(read(spark, "labels"), "doc_id").select("quality", "score").collect()
    good = [r["score"] >= quality.THRESHOLD for r in rows if r["quality"] == 1]
    bad = [r["score"] >= quality.THRESHOLD for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)
    assert scored.count() == docs.count()


@tables
def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    model = toxicity.train(docs, learn)
    rows = toxicity.score(docs, model).join(labels, "doc_id").collect()
    rows = [r for r in rows if fold(r["doc_id"])]
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    pairs = [(a > b) + 0.5 * (a == b) for a in toxic for b in clean]
    assert sum(pairs) / len(pairs) > 0.8  # a part of these labels shows in no word of the text
    assert np.mean([s < 0.5 for s in clean]) > 0.97


def test_naive_bayes_ratio():
    rows = [np.array([0, 1]), np.array([0]), np.array([2])]
    ratio = toxicity.log_count_ratio(rows, np.array([1, 1, 0]), np.ones(3), 4)
    p, q = np.array([3, 2, 1, 1]) / 7, np.array([1, 1, 2, 1]) / 5
    assert np.allclose(ratio, np.log(p / q))


DOCS = "doc_id long, text string, score string, label int, key int, weight int"


def test_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "you idiot " * 50), (3, "you idiot " * 50), (None, "lone")]
    rows += [(10 + i, "a kind sentence about cats. " * (i + 1)) for i in range(30)]
    df = spark.createDataFrame([(*r, "x", 0, 0, 0) for r in rows], DOCS)
    empty, no_labels = df.limit(0), spark.createDataFrame([], "doc_id long, toxic int")
    labels = spark.createDataFrame(
        [(3, 1), (3, 0), (2, None), (99, 1), (None, 1)] + [(10 + i, 0) for i in range(30)],
        "doc_id long, toxic int",
    )
    # No label: nothing is toxic. One class: a constant on its side.
    plain = toxicity.score(df, toxicity.train(df, no_labels)).select("score").collect()
    assert len(plain) == len(rows) and all(r[0] == 0 for r in plain)
    calm = toxicity.score(df, toxicity.train(df, labels.where("toxic = 0 and doc_id > 5")))
    assert all(r["score"] < 0.5 for r in calm.collect())
    got = toxicity.score(df, toxicity.train(df, labels))
    assert got.columns == df.columns
    by_id = {r["doc_id"]: r["score"] for r in got.collect()}
    assert by_id[3] > 0.5 and all(0 <= s <= 1 for s in by_id.values())
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0
    kept = quality.score(df, quality.train(df))
    assert kept.count() == len(rows)
    scores = {r["doc_id"]: r["score"] for r in kept.collect()}
    assert scores[1] == scores[2] == 0.0
    assert quality.score(empty, quality.train(empty)).count() == 0


def test_quality_reads_texts_without_spaces():
    """All characters of a text without white space reach the scorer, and the labellers judge it."""
    prose = "今天天气很好，我们一起去公园散步。孩子们在草地上放风筝，老人坐在长椅上聊天！" * 3
    prose = "".join(c + chr(0x4E00 + 7 * i) for i, c in enumerate(prose))
    junk = prose[:210] + "#$%{}=" * 300
    assert "".join(quality.words_of(junk)) == junk

    def said(text):
        return dict(zip(quality.LABELLERS, quality._digits(np.array([quality.votes(text)]))[0]))

    def found(text):
        index, value = quality.features(text, quality.Shapes())
        return dict(zip(index.tolist(), value.tolist()))

    assert quality.GOOD in said(prose).values() and quality.BAD not in said(prose).values()
    assert said(junk)["symbols"] == quality.BAD
    assert len(set(found(junk)) - set(found(prose[:210]))) > 1
    assert found("x" * 70 + "9" * 400) != found("x" * 70 + "9" * 100)
    shapes = quality.Shapes()
    assert shapes["x" * 300 + "9"] != shapes["x" * 300]
    plain = "No word of this text is over sixty characters. " * 9
    assert quality.words_of(plain) == plain.split()


def test_copies_of_a_labelled_row_push_no_other_out(spark):
    """One id with very many rows: the fit still reads every chosen id, each once."""
    docs = [(1, "you idiot " * 5)] * 60 + [(10 + i, f"kind words {i} ") for i in range(8)]
    docs += [(100 + i, f"vile insult {i} ") for i in range(8)]
    labels = [(1, 1)] + [(10 + i, 0) for i in range(8)] + [(100 + i, 1) for i in range(8)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    many = toxicity.train(docs, labels, per_class=9)
    once = toxicity.train(docs.distinct(), labels, per_class=9)
    assert many.bias == once.bias and np.array_equal(many.weight, once.weight)
