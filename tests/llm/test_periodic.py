import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import periodic


def plain_runs(words, least=12):
    """All (start, length, smallest period), from every period and every start."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            to = i
            while to + q < n and words[to] == words[to + q]:
                to += 1
            if to - i + q >= max(least, 2 * q):
                found.setdefault((i, to + q), q)
            i = max(to, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def of(words, least=12):
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return periodic.find_runs(np.array([names[w] for w in words], np.int64), least)


def test_random_sequences():
    rng = random.Random(0)
    for _ in range(1500):
        parts = []
        for _ in range(rng.randint(1, 6)):
            word = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 9))]
            whole = word * rng.randint(1, 9)
            parts += whole[: rng.randint(1, len(whole))]
        least = rng.choice([2, 3, 5, 12, 12])
        assert of(parts, least) == plain_runs(parts, least), parts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 6), st.integers(0, 40))
def test_repeated_stretches(base, times, cut):
    words = base * times + base[:cut]
    assert of(words) == plain_runs(words)
    nested = (words[:20] + [9]) * 4
    assert of(nested) == plain_runs(nested)


def test_equal_labels_of_other_words(monkeypatch):
    """A collision of labels is seen, and exact labels take over."""
    monkeypatch.setattr(periodic, "_grams", lambda ids, width: np.zeros(len(ids) - width + 1, np.uint64))
    words = list("abcabcabcabcabcxyzqrs")
    assert of(words) == plain_runs(words)


@pytest.mark.parametrize("period", [1, 2, 5, 6, 7, 50])
def test_long_repeats_take_linear_time(period):
    began = time.time()
    words = list(range(period)) * (300_000 // period)
    assert of(words) == [(0, len(words), period)]
    assert time.time() - began < 20


def plain_collapsed(words):
    gone = {i for s, length, q in plain_runs(words) for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_documents(spark):
    texts = [
        "", None, "   \n\t", "one two", "ha " * 30, "a b c\n" * 9 + "end", "É x \x0b\x0cé " * 12,
        "la la " * 3 + "mid " + "la la " * 8 + "x y z " * 7, "w " * 5000,
        " ".join(str(i) for i in range(30_000)),
    ]
    rows = [(i if i != 4 else None, t, "x", 1) for i, t in enumerate([*texts, *texts[4:6]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int")
    got = periodic.periodic_runs(df).collect()
    want = []
    for key, text, _, _ in rows:
        words = [w for w in (text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
        runs = plain_runs(words) if len(words) < 1000 else [(0, 5000, 1)] if words[0] == "w" else []
        rest = plain_collapsed(words) if len(words) < 1000 else "w" if runs else " ".join(words)
        want.append((key, len(words), runs, rest))
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert periodic.periodic_runs(df.limit(0)).count() == 0
