"""Token counts per field and section, from one encoding of the whole document.

The fields of a document are joined by one newline each and encoded once. The tokens' character
spans are then joined with the spans of the fields, and of the sections (lines) inside them, by
binary search over the sorted bounds. The rule for a token that crosses a boundary: it belongs to
the span that holds most of its characters, the earlier one on a tie. The newline between two
fields belongs to the field before it. So every token is counted once, and the counts of a
document add up to its length.

Cases: a null or empty field is an empty span (its separator may still earn it a token); a
document of empty fields counts its separators only; repeated rows and null ids are kept; an
empty table gives no rows; other columns are not read. Work and memory follow the longest text.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.encoding import encoder

SCHEMA = (
    "id long, field string, n_chars long, n_tokens long, n_sections long, "
    "max_section_tokens long, shared_tokens long"
)


def owners(spans: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, int]:
    """Span number of each token, given sorted starts of adjacent spans; and how many cross."""
    first = np.searchsorted(starts, spans[:, 0], "right") - 1
    last = np.searchsorted(starts, np.maximum(spans[:, 1] - 1, spans[:, 0]), "right") - 1
    crossing = np.flatnonzero(first != last)
    for i in crossing.tolist():
        begin, end = spans[i].tolist()
        inner = starts[first[i] + 1 : last[i] + 1].tolist()
        cuts = [begin, *inner, end]
        held = [b - a for a, b in zip(cuts, cuts[1:])]
        first[i] += held.index(max(held))
    return first, len(crossing)


def _line_starts(text: str) -> np.ndarray:
    """Starts of the lines of a text; a newline ends its line."""
    units = np.frombuffer(text.encode("utf-32-le"), "<u4")
    after = np.flatnonzero(units == 10) + 1
    return np.concatenate([[0], after[after < len(units)]]).astype(np.int64)


def _count(encode, values: Sequence[str]):
    whole = "\n".join(values)
    _, spans = encode(whole)
    lengths = [len(v) for v in values]
    ends = np.cumsum([n + 1 for n in lengths])
    starts = ends - np.array(lengths) - 1
    field_of, _ = owners(spans, starts)
    lines = [_line_starts(v) + s for v, s in zip(values, starts)]
    sections = np.concatenate(lines)
    section_of, _ = owners(spans, sections)
    per_section = np.bincount(section_of, minlength=len(sections))
    per_field = np.bincount(field_of, minlength=len(values))
    crosses = np.searchsorted(sections, spans[:, 0], "right") != np.searchsorted(
        sections, spans[:, 1] - 1, "right"
    )
    shared = np.bincount(field_of[crosses], minlength=len(values))
    at = 0
    for i, rows in enumerate(lines):
        own = per_section[at : at + len(rows)]
        at += len(rows)
        yield i, lengths[i], int(per_field[i]), len(rows), int(own.max()), int(shared[i])


def count_tokens(
    docs: DataFrame, tokenizer: str, fields: Sequence[str], *, id_col: str = "doc_id"
) -> DataFrame:
    """One row per document and field: characters, tokens, lines, most tokens of a line, and
    tokens of the field that cross a line or field boundary."""
    fields = list(fields)

    def count(batches):
        encode = encoder(tokenizer, spans=True).encode
        for batch in batches:
            out: list[tuple] = []
            keys = batch.column(0).to_pylist()
            for row, key in enumerate(keys):
                values = [batch.column(1 + i)[row].as_py() or "" for i in range(len(fields))]
                for i, *found in _count(encode, values):
                    out.append((key, fields[i], *found))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())]
                    + [pa.array(c, pa.int64()) for c in columns[2:]],
                    names=[part.split()[0] for part in SCHEMA.split(", ")],
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        *(F.col(f).cast("string").alias(f"_field{i}") for i, f in enumerate(fields)),
    )
    return rows.mapInArrow(count, SCHEMA).withColumnRenamed("id", id_col)
