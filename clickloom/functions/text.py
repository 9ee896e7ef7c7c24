"""Size estimates of requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def word_count(col: str) -> Column:
    """Whitespace-separated words; null counts as none."""
    words = F.filter(F.split(F.col(col), r"\s+"), lambda w: w != "")
    return F.coalesce(F.size(words), F.lit(0))


def token_count(item: str, text_fields: Sequence[str]) -> Column:
    """Whole tokens at 0.75 per word of the item plus 0.25 per word of each text field."""
    total = F.floor(word_count(item) * F.lit(0.75))
    for field in text_fields:
        total = total + F.floor(word_count(field) * F.lit(0.25))
    return total


def json_bytes(fields: Sequence[str]) -> Column:
    """UTF-8 bytes of the compact JSON object of the given columns."""
    return F.octet_length(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
