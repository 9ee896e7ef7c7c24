"""Ids and character spans of whole texts, with the tokenizers library.

A byte-level BPE tokenizer first splits a text into pieces (words with their leading space,
digits, punctuation, white space) and then merges inside each piece alone, so the ids of a text
are the ids of its pieces, one after another. `TextEncoder` lets the library's BPE model encode
each distinct piece once and looks repeated ones up; for other tokenizers, or wherever a probe
shows a difference, it hands whole texts to `Tokenizer.encode`. Both give the same ids and spans.

A piece never crosses the place before a space, unless that space stands inside white space: one
that follows white space and is followed by white space or the end of the text. Texts without
such a space are cut at their spaces, which is quick, and each stretch from one space to the next
is looked up whole. New stretches of a batch are encoded by one call of the library on all of them,
joined by spaces. Other texts are split by the pattern throughout.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import regex

from clickloom.llm.held import keep

# The byte-level splitting pattern, and the printable bytes that stand for themselves.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [(33, 126), (161, 172), (174, 255)]

# Under 2/3 of 2**20, where a dict doubles; every Python worker of an executor holds such a table.
PIECES = 650_000  # distinct stretches kept at a time; beyond that only those met again stay
HELD = 1 << 25  # as for PIECES, in characters
WORDS = 100  # new stretches joined to one text for the library, which is slower on long texts
SLICE = 1 << 20  # pieces looked up at a time, which bounds memory on very long texts

_PROBE = "It's  a\tprobe: 12 cafés,\n\n  日本 \U0001f600!! don't  x <|endoftext|>  "


def _byte_signs() -> dict[int, int]:
    """The printable sign that stands for each byte, as a table for str.translate."""
    signs, spare = {}, 256
    for byte in range(256):
        if not any(low <= byte <= high for low, high in PRINTABLE):
            signs[byte] = spare
            spare += 1
    return signs


class _Growing:
    """An array that rows are added to; new rows wait in a list until the array is read. Room not
    used yet takes no memory, as only zeroed pages that are written to do. A table of small
    numbers turns to 64 bits once a value needs them."""

    def __init__(self, kind):
        self.data, self.size, self.new = np.zeros(1 << 12, kind), 0, []

    def _put(self, values: np.ndarray) -> None:
        to = self.size + len(values)
        kind = self.data.dtype
        if kind == np.int32 and len(values) and values.max() > np.iinfo(kind).max:
            kind = np.dtype(np.int64)
        if to > len(self.data) or kind != self.data.dtype:
            room = len(self.data) if to <= len(self.data) else max(to, 2 * len(self.data))
            more = np.zeros(room, kind)
            more[: self.size] = self.data[: self.size]
            self.data = more
        self.data[self.size : to] = values
        self.size = to

    def array(self) -> np.ndarray:
        if self.new:
            wide = np.int64 if self.data.dtype == np.int32 else self.data.dtype
            values, self.new = np.array(self.new, wide), []
            self._put(values)
        return self.data[: self.size]

    def extend(self, values: np.ndarray) -> None:
        self.array()
        self._put(values)

    def __len__(self) -> int:
        return self.size + len(self.new)


class _Stretches(dict):
    """Key -> row of flat tables with the tokens' ids and, if asked for, character spans.

    The key `word` stands for a space and the word; the key ` text` for the text without a space
    before it, as texts begin. Words hold no spaces, so the two kinds do not meet.
    """

    def __init__(self, tokenizer, pattern, spans: bool):
        super().__init__()
        self.tokenizer, self.model, self.pattern = tokenizer, tokenizer.model, pattern
        self.spans, self.signs = spans, _byte_signs()
        vocabulary = tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, np.bool_)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(chr(self.signs[32]))]] = True
        self.clear()

    def clear(self):
        super().clear()
        self.first, self.count, self.chars = (_Growing(np.int32) for _ in range(3))
        self.opens, self.closes = _Growing(np.bool_), _Growing(np.bool_)
        self.ids, self.begin, self.end = _Growing(np.uint32), _Growing(np.int32), _Growing(np.int32)
        self.held = 0
        self.again = np.zeros(1 << 12, np.bool_)  # by row: met in a batch after the one that added it

    def shrink(self) -> None:
        """Keep the stretches met again, if they are at most half of the table; else none. All
        rows change."""
        keep = np.flatnonzero(self.again[: len(self.first)])
        names = list(self)  # rows are given in the order of the keys
        old = [t.array() for t in (self.first, self.count, self.chars, self.opens, self.closes)]
        flat = [t.array() for t in (self.ids, self.begin, self.end)]
        self.clear()
        if 2 * len(keep) > len(names) or 2 * int(old[2][keep].sum()) > HELD:
            return
        first, count, chars, opens, closes = (values[keep] for values in old)
        take = _positions(first, count)
        self.ids.extend(flat[0][take])
        if self.spans:
            self.begin.extend(flat[1][take])
            self.end.extend(flat[2][take])
        self.first.extend(np.cumsum(count) - count)
        for table, values in (
            (self.count, count),
            (self.chars, chars),
            (self.opens, opens),
            (self.closes, closes),
        ):
            table.extend(values)
        self.update((names[row], at) for at, row in enumerate(keep.tolist()))
        self.held = int(chars.sum())

    def _add(self, key: str, length: int, opens: bool, closes: bool, ids: list, spans: list) -> None:
        self[key] = len(self.first)
        self.first.new.append(len(self.ids))
        self.count.new.append(len(ids))
        self.chars.new.append(length)
        self.opens.new.append(opens)
        self.closes.new.append(closes)
        self.ids.new += ids
        if self.spans:
            self.begin.new += [a for a, _ in spans]
            self.end.new += [b for _, b in spans]
        self.held += length

    def learn(self, keys: list[str]) -> None:
        """Add the keys, all of them new; they may repeat."""
        distinct = list(dict.fromkeys(keys))
        joined = [key for key in distinct if key and key.strip() == key]
        if joined:
            self._learn_joined(joined)
        if len(joined) == len(distinct):
            return
        for key in distinct:
            if key and key.strip() == key:
                continue
            # White space at an end: opens and closes tell whether a neighbour may matter.
            spaced = not key.startswith(" ")
            text = " " + key if spaced else key[1:]
            opens = spaced and (not key or key[0].isspace())
            closes = bool(text) and text[-1].isspace()
            self._add(key, len(text), opens, closes, *self._tokens(text))

    def _learn_joined(self, words: list[str]) -> None:
        """Words without white space at their ends: joined by spaces, each is cut out where a
        token begins with a space, as no other token does."""
        row, count = len(self.first), len(words)
        lengths = np.fromiter(map(len, words), np.int64, count) + 1
        texts = [" " + " ".join(words[at : at + WORDS]) for at in range(0, count, WORDS)]
        encode = self.tokenizer.encode_batch if self.spans else self.tokenizer.encode_batch_fast
        found = encode(texts, add_special_tokens=False)
        each = [np.array(part.ids, np.uint32) for part in found]
        ids = np.concatenate(each)
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != count:
            raise ValueError("a token holds a space inside")
        counts = np.diff(starts, append=len(ids))
        if self.spans:
            begins = np.repeat(np.cumsum(lengths) - lengths, counts)
            shift = np.cumsum([0, *map(len, texts[:-1])])
            offsets = np.concatenate([np.array(part.offsets, np.int64) for part in found])
            offsets += np.repeat(shift, [len(part) for part in each])[:, None]
            self.begin.extend(offsets[:, 0] - begins)
            self.end.extend(offsets[:, 1] - begins)
        self.first.extend(starts + len(self.ids))
        self.ids.extend(ids)
        self.count.extend(counts)
        self.chars.extend(lengths)
        self.opens.extend(np.zeros(count, np.bool_))
        self.closes.extend(np.zeros(count, np.bool_))
        self.update(zip(words, range(row, row + count)))
        self.held += int(lengths.sum())

    def _tokens(self, text: str) -> tuple[list, list]:
        """Ids and spans of a text, piece by piece."""
        ids, spans, shift = [], [], 0
        for piece in self.pattern.findall(text):
            raw = piece.encode()
            # A sign of a token's value is one byte; a character belongs to every token with one
            # of its bytes.
            char_of = [i for i, c in enumerate(piece) for _ in c.encode()]
            at = 0
            for token in self.model.tokenize(raw.decode("latin-1").translate(self.signs)):
                to = at + len(token.value)
                ids.append(token.id)
                spans.append((shift + char_of[at], shift + char_of[to - 1] + 1))
                at = to
            shift += len(piece)
        return ids, spans

    def rows(self, keys: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.get, keys, repeat(-1)), np.int64, len(keys))
        if len(self.again) < len(self.first):
            more = np.zeros(2 * len(self.first) - len(self.again), np.bool_)
            self.again = np.concatenate([self.again, more])
        new = np.flatnonzero(found < 0).tolist()
        if new:
            words = [keys[at] for at in new]
            self.again[found[found >= 0]] = True
            self.learn(words)
            found[new] = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        else:
            self.again[found] = True
        return found


def _positions(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions first[i] .. first[i] + count[i] - 1, for all i in turn."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


class TextEncoder:
    """Encodes whole texts with the tokenizer file at `path`, without special tokens."""

    def __init__(self, path: str, spans: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pattern = regex.compile(SPLIT)
        self.store = None
        if self._byte_level(path):
            self.store = _Stretches(self.tokenizer, self.pattern, spans)
            whole = self.tokenizer.encode(_PROBE, add_special_tokens=False)
            same = self.ids(_PROBE).tolist() == whole.ids
            if spans:
                same &= [tuple(s) for s in self.encode(_PROBE)[1].tolist()] == whole.offsets
            if not same:
                self.store = None

    @staticmethod
    def _byte_level(path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        return (
            spec["model"].get("type") == "BPE"
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and not spec.get("normalizer")
            and not spec.get("post_processor")
        )

    def _room(self) -> None:
        """Make room if the table is full; rows looked up before are void then."""
        if len(self.store) > PIECES or self.store.held > HELD:
            self.store.shrink()

    def _split(self, text: str) -> list[str]:
        """Keys of the pieces of a text, by the pattern."""
        return [" " + piece for piece in self.pattern.findall(text)]

    def _rows(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Rows that make up texts of moderate length, and where each text's rows end."""
        keys: list[str] = []
        ends = []
        for text in texts:
            if text:
                words = text.split(" ")
                words[0] = " " + words[0]
                keys += words
            ends.append(len(keys))
        rows = self.store.rows(keys)
        closes, opens = self.store.closes.array()[rows], self.store.opens.array()[rows]
        inner = np.flatnonzero(closes[:-1] & opens[1:])
        if not len(inner):
            return rows, np.array(ends, np.int64)
        marked = set(np.searchsorted(ends, inner, "right").tolist())
        parts, at = [], 0
        for i, end in enumerate(ends):
            if i in marked:
                parts.append(self.store.rows(self._split(texts[i])))
            else:
                parts.append(rows[at:end])
            at = end
        return np.concatenate(parts), np.cumsum([len(p) for p in parts])

    def _row_slices(self, text: str) -> Iterator[np.ndarray]:
        """Rows of a text, a bounded number at a time; use each slice before the next is made."""
        self._room()
        if len(text) <= SLICE:
            yield self._rows([text])[0]
            return
        found: list[str] = []
        for match in self.pattern.finditer(text):
            found.append(" " + match.group())
            if len(found) == SLICE:
                yield self.store.rows(found)
                found = []
                self._room()
        yield self.store.rows(found)

    def _ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the number of ids of each."""
        count = self.store.count.array()[rows]
        return self.store.ids.array()[_positions(self.store.first.array()[rows], count)], count

    def ids(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text (null: none)."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.store is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        parts = [self._ids(rows)[0] for rows in self._row_slices(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def ids_of(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of several texts back to back, and the number of ids of each."""
        if self.store is None or sum(len(t) for t in texts if t) > SLICE:
            each = [self.ids(t) for t in texts]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            return np.concatenate([np.zeros(0, np.uint32), *each]), counts
        self._room()
        rows, ends = self._rows(texts)
        found, count = self._ids(rows)
        before = np.concatenate([[0], np.cumsum(count)])
        return found, np.diff(before[ends], prepend=0)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a whole text and the (begin, end) characters of each token. Needs `spans`."""
        if not text:
            return np.zeros(0, np.uint32), np.zeros((0, 2), np.int64)
        if self.store is None:
            whole = self.tokenizer.encode(text, add_special_tokens=False)
            return np.array(whole.ids, np.uint32), np.array(whole.offsets, np.int64).reshape(-1, 2)
        ids_of, spans, at = [], [], 0
        for rows in self._row_slices(text):
            store = self.store
            count, length = store.count.array()[rows], store.chars.array()[rows]
            take = _positions(store.first.array()[rows], count)
            start = np.repeat(at + np.cumsum(length) - length, count)
            ids_of.append(store.ids.array()[take])
            spans.append(
                np.stack([start + store.begin.array()[take], start + store.end.array()[take]], axis=1)
            )
            at += int(length.sum())
        return np.concatenate(ids_of), np.concatenate(spans)


def encoder(path: str, spans: bool = False) -> TextEncoder:
    """The encoder of a tokenizer file, loaded once per Python worker and stretch of such work."""
    return keep("encoding", (path, spans), lambda: TextEncoder(path, spans))
