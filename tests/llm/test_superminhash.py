import itertools
import random

import numpy as np
import pytest

from clickloom.llm import superminhash as smh
from clickloom.llm.skew import hot_keys, join_spread


def plain_set(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain_groups(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(rows)), key=repr)


def check(spark, docs, **how):
    df = spark.createDataFrame(
        [(*r, "x", 1) for r in docs], "doc_id long, text string, n string, component_id int"
    )
    got = smh.near_copies(df, **how).collect()
    assert sorted(map(tuple, got), key=repr) == plain_groups(docs)


def texts_like(rng, base, count, edits):
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        yield " ".join(words)


def test_groups_match_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}é" for i in range(300)]
    rows, key = [], 100
    for length, edits in [(8, 1), (20, 1), (40, 2), (60, 4), (200, 9), (500, 14)]:
        base = [rng.choice(vocabulary) for _ in range(length)]
        for text in texts_like(rng, base, 25, edits):
            rows.append((key, rng.choice([text, text.upper().replace("É", "é"), text.replace(" ", "\t\n")])))
            key += 1
    rows += [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one")]
    rows += [(None, "one two"), (None, "no id here at all"), (None, None), rows[0], rows[0]]
    rng.shuffle(rows)
    check(spark, rows)


def test_rounds_within_a_bucket(spark):
    """Texts that share buckets without being linked: twenty centres a round find all links."""
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(60)]
    rows = []
    for family in range(14):
        own = [f"f{family}-{i}" for i in range(9)]
        for text in texts_like(rng, shared + own, 5, 3):
            rows.append((len(rows), text))
    check(spark, rows, bands=16, rows=1, centres=20)


def test_chain(spark):
    """Neighbours are linked, ends are not: one group all the same."""
    words = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 70])) for i in range(28)]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert smh.near_copies(df).count() == 0


def test_very_long_text(spark):
    words = [str(i) for i in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-4000])), (3, " ".join(words[30_000:]))]
    got = {r["doc_id"]: r["component_id"] for r in smh.near_copies(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def plain_signature(elements, places):
    """Element by element, with each one's whole permutation."""
    table = smh._shuffles(places)
    assert all(sorted(r) == list(range(places)) for r in table.tolist())
    out = [smh._FREE] * places
    for e in elements:
        turn = int(e >> np.uint64(32)) % places
        for rank in range(places):
            place = (int(table[int(e) & 1023, rank]) + turn) % places
            x = np.array([(int(e) + (rank + 1) * int(smh._GOLD)) % (1 << 64)], np.uint64)
            out[place] = min(out[place], np.uint64((int(smh._mix(x)[0]) >> 8) | rank << 56))
    return out


def test_early_stopping_changes_nothing():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 7, 40, 300)]
    got = smh.Signer(24).sign(sets)
    for s, row in zip(sets, got):
        assert row.tolist() == [int(v) for v in plain_signature(s, 24)]


@pytest.mark.parametrize("size", [20, 400])
def test_estimates(size):
    """Equal places estimate the similarity, with no more variance than independent hashes."""
    rng, places, errors = np.random.default_rng(2), 192, []
    signer, share = smh.Signer(places), 0.6
    for _ in range(150):
        both = int(size * share)
        drawn = rng.integers(0, 1 << 63, 2 * size - both).astype(np.uint64)
        a, b = signer.sign([drawn[:size], drawn[size - both :]])
        errors.append((a == b).mean() - both / len(drawn))
    truth = both / len(drawn)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 1.3 * truth * (1 - truth) / places


def test_spread_join(spark):
    rows = spark.range(5000).selectExpr("if(id < 3000, 7, id) as key", "id as row")
    other = spark.createDataFrame([(7, "a"), (7, "b"), (4000, "c"), (9, "d")], "key long, value string")
    hot = hot_keys(rows.groupBy("key").count(), "key", 5000)
    assert [tuple(r) for r in hot.collect()] == [(7, 12)]
    got = join_spread(rows, other, "key", hot, "row")
    want = rows.join(other, "key").select(got.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 6001
