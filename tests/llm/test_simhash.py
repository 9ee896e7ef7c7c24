import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickloom.llm import simhash


def plain_fingerprint(text, n=4):
    """The definition, shingle by shingle and bit by bit."""
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius):
    """{row: smallest id reachable}, from all pairs."""
    left, out = set(range(len(prints))), {}
    while left:
        group, new = set(), {left.pop()}
        while new:
            group |= new
            new = {j for j in left for i in new if bin(prints[i][1] ^ prints[j][1]).count("1") <= radius}
            left -= new
        ids = [prints[i][0] for i in group if prints[i][0] is not None]
        for i in group:
            out[i] = min(ids) if ids else None
    return out


def check(spark, rows, tile, radius=4):
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, component_id int")
    got = simhash.simhash_groups(df, radius=radius, tile=tile).select(
        "doc_id", simhash.as_hex(F.col("fingerprint")).alias("f"), "component_id"
    )
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    groups = plain_groups(prints, radius)
    want = [(d, f"{f:016x}", groups[i]) for i, (d, f) in enumerate(prints)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("tile", [3, 8192])
def test_groups_match_all_pairs(spark, tile):
    rng = random.Random(5)
    words = [f"w{i}é" for i in range(40)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 30, 300]))]
        text = rng.choice([" ", "\n", "\t \x0b"]).join(base)
        rows.append((i, text, "x", 1))
        if i % 3 == 0:
            rows.append((1000 - i, text.upper().replace("É", "é"), "x", 1))
            base[-1:] = ["changed"]
            rows.append((2000 - i, " ".join(base), "x", 1))
    rows += [(5000, None, None, None), (5001, "", None, None), (None, "lone row here", None, None)]
    rows += [rows[0], rows[0]]
    check(spark, rows, tile)


def test_long_chains_and_big_groups(spark):
    """A chain of fingerprints 4 bits apart is one group; its ends differ in most bits."""
    chain = [0]
    for step in range(12):
        chain.append(chain[-1] | 0b1111 << 4 * step)
    rng = random.Random(1)
    near = [rng.getrandbits(64)]
    near += [near[0] ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]
    prints = [(i, p) for i, p in enumerate(chain + near)]
    df = spark.createDataFrame(
        [(i, int(np.uint64(p).astype(np.int64))) for i, p in prints], "doc_id long, fingerprint long"
    )
    got = simhash.group_fingerprints(df, radius=4, tile=100)
    by_id = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert by_id == plain_groups(prints, 4)
    links = simhash.links(df, 4, 100)
    assert links.count() < 40 * len(prints)  # forests, not the 2 million pairs of the group


def test_slices_of_long_texts(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    monkeypatch.setattr(simhash, "SLICE", 100)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == 0
    assert simhash.keep_one_per_group(df).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e"), (7, "other text")]
    rows += [(None, "no id at all"), (None, None), (9, None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, _print int")
    got = simhash.keep_one_per_group(df)
    assert got.columns == df.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert kept == sorted([(1, "a b c d e"), (7, "other text"), (None, "no id at all"), (9, None)], key=repr)


def test_fingerprint_and_group_over_the_hot_share(spark, monkeypatch):
    monkeypatch.setattr("clickloom.llm.skew.FEW", 2)
    monkeypatch.setattr("clickloom.llm.skew.SHARES", 20)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    long = [rng.choice(words) for _ in range(2000)]
    rows = [(300 - i, " ".join(long), "x", 1) for i in range(80)] + [(None, " ".join(long), "x", 1)] * 3
    for i in range(30):  # many fingerprints of one component
        rows.append((400 + i, " ".join([*long[: 100 + i], "new", *long[101 + i :]]), "x", 1))
    rows += [(600 + i, f"text {i} of its own", "x", 1) for i in range(20)]
    check(spark, rows, tile=8192)
