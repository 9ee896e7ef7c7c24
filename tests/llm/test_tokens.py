import itertools
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from clickloom.llm import encoding, tokencounts, tokenfiles
from clickloom.llm.queries import byte_bpe

TEXTS = [
    "Plain words, and some more.\nSecond line  here\n\n",
    "It's 12 o'clock -- café, naïve, 日本語 \U0001f600\U0001f600 ẞ½٣",
    "",
    None,
    " \t \r\n ",
    "<|endoftext|> <turn> \\### it'd we've",
    "long " * 3000 + "tail\n" * 500,
    "é" * 2000,
    "same text",
    "same text",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(byte_bpe())
    found.encode_special_tokens = True
    return found


def test_encoder_equals_library(tokenizer, monkeypatch):
    ours = encoding.TextEncoder(byte_bpe())
    assert ours.store is not None
    rng = random.Random(3)
    signs = list("ab 1.'\n\t  é日😀s<|>!_ẞ½٣") + ["  ", "'re", " 's", "\r\n"]
    texts = [t or "" for t in TEXTS]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    spaces = [" ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85"]
    for length in range(1, 5):  # all runs of white space, inside a text and at its ends
        for run in itertools.product(spaces, repeat=length):
            texts += ["".join(["a", *run, "b"]), "".join(run), "".join(["c", *run])]
            if length < 4:
                texts.append("".join([*run, "d 1"]))
    for limit in (encoding.PIECES, 20):  # a small table is emptied again and again
        monkeypatch.setattr(encoding, "PIECES", limit)
        ids, counts = ours.ids_of(texts[:200])
        cuts = np.split(ids, np.cumsum(counts)[:-1])
        for text, cut in zip(texts, cuts):
            assert cut.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        for text in texts:
            whole = tokenizer.encode(text, add_special_tokens=False)
            ids, spans = ours.encode(text)
            assert ours.ids(text).tolist() == ids.tolist() == whole.ids
            assert [tuple(s) for s in spans.tolist()] == whole.offsets


def test_full_table_of_a_worker_is_small():
    ours = encoding.TextEncoder(byte_bpe(), spans=False)
    words = [f"w{i}" for i in range(100_000)]
    texts = [" ".join(words[at : at + 100]) for at in range(0, len(words), 100)]
    tracemalloc.start()
    try:
        for at in range(0, len(texts), 64):
            ours.ids_of(texts[at : at + 64])
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(ours.store) >= len(words)
    assert held / len(ours.store) * encoding.PIECES < 160 << 20


def test_small_numbers_widen_where_a_value_needs_it():
    for values in ([7, 1 << 40], [1 << 40, 3]):
        by_list, by_array = encoding._Growing(np.int32), encoding._Growing(np.int32)
        by_list.new += [*range(5000), *values]
        by_array.extend(np.arange(5000))
        by_array.extend(np.array(values))
        want = [*range(5000), *values]
        assert by_list.array().tolist() == by_array.array().tolist() == want
        by_array.extend(np.array([9]))
        assert by_array.array().tolist() == [*want, 9] and len(by_array) == 5003


@pytest.mark.parametrize("spans", [False, True])
def test_full_table_keeps_what_is_met_again(tokenizer, monkeypatch, spans):
    ours = encoding.TextEncoder(byte_bpe(), spans)
    monkeypatch.setattr(encoding, "PIECES", 60)
    for i in range(40):
        texts = [f"the common words, new{i} word{i * 7}x here", "  odd\tspaces the  end "]
        ids, counts = ours.ids_of(texts)
        for text, cut in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
            whole = tokenizer.encode(text, add_special_tokens=False)
            assert cut.tolist() == whole.ids
            if spans:
                assert [tuple(s) for s in ours.encode(text)[1].tolist()] == whole.offsets
    assert {"common", "words,", "here"} <= set(ours.store) and "new3" not in ours.store
    assert len(ours.store) <= 60 + 20


def test_encoder_slices_long_texts(tokenizer, monkeypatch):
    ours = encoding.TextEncoder(byte_bpe())
    monkeypatch.setattr(encoding, "SLICE", 50)
    text = " ".join(t or "" for t in TEXTS)
    whole = tokenizer.encode(text, add_special_tokens=False)
    ids, spans = ours.encode(text)
    assert ids.tolist() == whole.ids and [tuple(s) for s in spans.tolist()] == whole.offsets


def test_other_tokenizers_take_the_whole_text():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    ours = encoding.TextEncoder(path)
    assert ours.store is None
    text = "Some Words\nin two lines"
    assert ours.ids(text).tolist() == ours.tokenizer.encode(text, add_special_tokens=False).ids


def rows_of(texts):
    return [(i * 3 % 17 - 5, t, "x", i) for i, t in enumerate(texts)] + [(None, "no id", "y", 0)]


def test_files_round_trip(spark, tokenizer):
    rows = rows_of(TEXTS)
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "doc_id long, text string, part string, tokens long")
    folder = tokenfiles.write_token_files(df, byte_bpe())
    got = tokenfiles.read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    at = 0
    by_text = {}
    for doc, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        by_text.setdefault(doc, []).append(ids)
    for row in got:
        assert row["start"] == at and row["ids"] in by_text[row["doc_id"]]
        raw = np.array(row["ids"], "<u4").tobytes()
        assert row["n_tokens"] == len(row["ids"]) and row["ids_crc32"] == zlib.crc32(raw)
        at += row["n_tokens"]
    # The files themselves: back to back, in part order, they are the whole output.
    manifest = tokenfiles.read_manifest(spark, folder).orderBy("part").collect()
    flat, offsets = [], []
    for row in manifest:
        assert row["item_bytes"] == 2
        assert row["base"] == sum(len(f) for f in flat)
        name = f"{folder.removeprefix('file://')}/part-{row['part']:05d}"
        flat.append(np.fromfile(f"{name}.ids", "<u2"))
        offsets += np.fromfile(f"{name}.off", "<u8")[:-1].tolist()
        assert len(flat[-1]) == row["tokens"]
    assert np.concatenate(flat).tolist() == [i for r in got for i in r["ids"]]
    assert offsets == [r["start"] for r in got]


def test_files_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = tokenfiles.write_token_files(df, byte_bpe())
    assert tokenfiles.read_token_files(spark, folder).count() == 0


def test_wide_ids(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    folder = tokenfiles.write_token_files(df, byte_bpe(), end_id=70_000)
    row = tokenfiles.read_token_files(spark, folder, with_ids=True).first()
    assert row["ids"][-1] == 70_000 and row["n_tokens"] == 3


def plain_counts(tokenizer, values):
    """Token by token: the span that holds most of its characters, the first of equal ones."""
    whole, spans, lines = "\n".join(values), [], []
    at = 0
    for i, v in enumerate(values):
        spans.append((at, at + len(v) + 1, i))
        begin = at
        for piece in v.splitlines(keepends=True) if "\n" in v and "\r" not in v else [v]:
            lines.append((begin, begin + len(piece), i))
            begin += len(piece)
        at += len(v) + 1
    fields = [0] * len(values)
    for begin, end in tokenizer.encode(whole, add_special_tokens=False).offsets:
        share = [max(0, min(end, b) - max(begin, a)) for a, b, _ in spans]
        fields[share.index(max(share))] += 1
    return fields, [sum(1 for x in lines if x[2] == i) for i in range(len(values))]


def test_counts_per_field(spark, tokenizer):
    rows = [(i, f"src{i}", None if i % 2 else "en", t) for i, t in enumerate(TEXTS)]
    rows += [(None, None, "", "\n\n a"), (3, "!!", "!!", "!! x\n\n\n  y")]
    df = spark.createDataFrame(
        [(*r, 1) for r in rows], "doc_id long, source string, lang string, text string, field int"
    )
    got = tokencounts.count_tokens(df, byte_bpe(), ["source", "lang", "text"]).collect()
    assert len(got) == 3 * len(rows)
    for n, row in enumerate(rows):
        values = [v or "" for v in row[1:]]
        fields, lines = plain_counts(tokenizer, values)
        mine = got[3 * n : 3 * n + 3]
        assert [r["n_tokens"] for r in mine] == fields
        assert [r["n_chars"] for r in mine] == [len(v) for v in values]
        if "\r" not in values[2]:
            assert [r["n_sections"] for r in mine] == lines
        assert all(r["doc_id"] == row[0] for r in mine)


def test_boundary_rule():
    starts = np.array([0, 5, 10])
    spans = np.array([[0, 5], [4, 7], [3, 7], [8, 12], [2, 12], [9, 10], [12, 13]])
    owner, crossing = tokencounts.owners(spans, starts)
    assert owner.tolist() == [0, 1, 0, 1, 1, 1, 2] and crossing == 4


def test_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokencounts.count_tokens(df, byte_bpe(), ["text"]).count() == 0
