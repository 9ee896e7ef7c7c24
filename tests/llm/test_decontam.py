import random

import pytest

from clickloom.llm import decontam

DOCS = "doc_id long, text string, t string, item long, distance int"


def plain_best(item, text):
    """Least edit distance of the item to a stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i in range(1, len(item) + 1):
        new = [i]
        for j in range(1, len(text) + 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (item[i - 1] != text[j - 1])))
        row = new
    return min(row), row.index(min(row))


def test_myers_equals_table():
    rng = random.Random(1)
    for _ in range(800):
        item = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 30)))
        assert decontam.myers(item, text) == plain_best(item, text)


def edited(rng, item, edits):
    text = list(item)
    for _ in range(edits):
        i = rng.randrange(len(text))
        text[i : i + 1] = rng.choice([[], ["z"], ["z", text[i]]])
    return "".join(text)


def cases():
    rng = random.Random(7)
    letters = "abcde  "
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(i, make(rng.choice([30, 60, 150]))) for i in range(12)]
    items += [(20, "AB"), (21, ""), (22, None), (23, " \n\t "), (24, items[0][1].upper()), (None, items[1][1])]
    docs = []
    for i in range(120):
        text = make(rng.choice([0, 20, 400]))
        if i % 2:
            item = rng.choice(items[:12])[1]
            at = rng.randint(0, len(text))
            hit = edited(rng, item, rng.choice([0, 1, 3, 5, 8, 14, 20]))
            text = text[:at] + rng.choice([str, str.upper])(hit).replace(" ", " \n ") + text[at:]
        docs.append((i, text))
    docs += [(7, docs[7][1]), (500, None), (501, ""), (None, items[2][1]), (502, items[3][1] * 40)]
    return items, docs


def plain_matches(items, docs, rate):
    out = []
    for doc, text in docs:
        for item, wanted in items:
            wanted, found = decontam.normalise(wanted), decontam.normalise(text)
            if wanted:
                distance, end = plain_best(wanted, found)
                if distance <= int(len(wanted) * rate):
                    out.append((doc, item, distance, end))
    return out


@pytest.mark.parametrize("block_chars", [100, 4_000_000])
def test_all_matches_and_no_other(spark, block_chars):
    items, docs = cases()
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS)
    tests = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, t string")
    got = decontam.find_contaminated(df, tests, rate=0.1, block_chars=block_chars)
    want = plain_matches(items, docs, 0.1)
    rows = [(r["doc_id"], r["item_id"], r["distance"], r["end"]) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    texts = dict(docs)
    by_item = dict(items)
    for r in got.where("doc_id is not null and item_id is not null").collect():
        stretch = decontam.normalise(texts[r["doc_id"]])[r["begin"] : r["end"]]
        assert plain_best(decontam.normalise(by_item[r["item_id"]]), stretch)[0] == r["distance"]
    clean = decontam.remove_contaminated(df, tests, rate=0.1, block_chars=block_chars)
    assert clean.columns == df.columns
    dirty = {(d, t) for d, t in docs if plain_matches(items, [(d, t)], 0.1)}
    left = sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=repr)
    assert left == sorted((d for d in docs if d not in dirty), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text", "", 0, 0)], DOCS)
    items = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert decontam.find_contaminated(docs.limit(0), items).count() == 0
    assert decontam.find_contaminated(docs, items.limit(0)).count() == 0
    assert decontam.remove_contaminated(docs, items.limit(0)).count() == 1
    assert decontam.remove_contaminated(docs, items).count() == 0
