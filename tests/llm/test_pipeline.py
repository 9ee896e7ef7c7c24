"""The pipeline's stages against brute force on the smallest table."""

import os

import pytest

import corpus_pipeline
from clickloom.llm import quality
from clickloom.llm.encoding import encoder
from clickloom.llm.queries import byte_bpe
from tests.llm.test_decontam import plain_matches
from tests.llm.test_simhash import plain_fingerprint, plain_groups

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, ROOT)
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        found[name] = (docs.collect(), after.collect())
        docs = after
    return found


def test_names():
    names = ["quality", "near_copies", "benchmark", "mixture", "tokens"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names


def test_quality_keeps_what_scores_half(spark, stages):
    before, after = stages["quality"]
    docs = spark.createDataFrame(before)
    scored = quality.score(docs, quality.train(docs)).collect()
    want = {r["doc_id"] for r in scored if r["score"] >= 0.5}
    assert {r["doc_id"] for r in after} == want and 0.7 * len(before) < len(after) < len(before)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    good = [r["doc_id"] for r in before if labels.get(r["doc_id"]) == 1]
    assert len(set(good) & want) >= 0.98 * len(good)


def test_one_of_each_group_stays(stages):
    before, after = stages["near_copies"]
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in before]
    groups = plain_groups(prints, 4)
    want = sorted(d for i, (d, _) in enumerate(prints) if groups[i] == d)
    assert sorted(r["doc_id"] for r in after) == want and len(want) < len(before)


def test_no_benchmark_item_is_left(spark, stages):
    before, after = stages["benchmark"]
    items = [tuple(r) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    short = [(r["doc_id"], r["text"]) for r in before if len(r["text"] or "") < 700]
    dirty = {m[0] for m in plain_matches(items, short, 0.1)}
    kept = {r["doc_id"] for r in after}
    assert not dirty & kept and {d for d, _ in short} - dirty <= kept
    for r in after:
        assert not any(t.lower() in " ".join(r["text"].lower().split()) for _, t in items if t)


def test_mixture_repeats_whole_rows(stages):
    before, after = stages["mixture"]
    rows = {tuple(r) for r in before}
    assert all(tuple(r) in rows for r in after)
    copies = [sum(a == b for a in after) for b in before]
    assert max(copies) <= 3


def test_tokens_are_those_of_the_texts(stages):
    before, after = stages["tokens"]
    encode = encoder(byte_bpe()).ids
    assert sorted(r["n_tokens"] for r in after) == sorted(len(encode(r["text"])) + 1 for r in before)
    at = 0
    for r in sorted(after, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(after, key=lambda r: r["start"])]
    assert ids == sorted(ids)


def test_odd_documents(spark):
    """Nulls in any column, repeated rows, further columns, no rows."""
    rows = [(1, None, None, None, None, 0, 0.5), (None, "a b c d e f g", "en", "s", 3, 1, None)]
    rows += [(2, "Some words, and more of them. They go on.", "en", None, 9, 2, 1.0)] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, score double"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, ROOT)
            assert name == "tokens" or out.columns == docs.columns
            got = out.collect()
            assert len(got) <= 3 * docs.count()
