"""Chat formatting with DataFrame functions only, and reading it back.

    <turn user>hello<next>are you there?</turn>
    <turn assistant>yes</turn>

The turns of a conversation are collected as structs and sorted by (turn, role, text); a fold
over the array merges adjacent turns of one role into blocks, each a range of the array; blocks
are rendered and concatenated. Texts and roles are escaped so that no control string can occur
inside them: backslash, `<` and `>` become `\\b`, `\\l` and `\\g`. Replacing those three in the
opposite order restores the text. `mask` lists the (begin, end) characters of each assistant text
in `formatted`; markers are never under it.

Cases: a null text is empty, a null role gives the tag `<turn>`; null turns come first; equal
turns and repeated rows are kept; a null conversation id is a conversation; an empty table gives
no rows; other columns are not read. A conversation must fit one row, as its output does; the
folds copy references, about n * n / 2 of them for n turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, NEXT = "<turn", "</turn>\n", "<next>"


def escape(text: Column) -> Column:
    for raw, safe in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _merge(turns: Column) -> Column:
    """Blocks of adjacent turns with one role: (role, first, n), first counting from 1."""
    empty = F.array().cast("array<struct<role:string,first:int,n:int>>")

    def block(role, first, n):
        return F.struct(
            role.alias("role"), first.cast("int").alias("first"), n.cast("int").alias("n")
        )

    def step(blocks, i):
        role, last = F.element_at(turns, i)["role"], F.try_element_at(blocks, F.lit(-1))
        same = (F.size(blocks) > 0) & last["role"].eqNullSafe(role)
        longer = block(last["role"], last["first"], last["n"] + 1)
        return F.when(
            same, F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(longer))
        ).otherwise(F.concat(blocks, F.array(block(role, i, F.lit(1)))))

    return F.aggregate(F.sequence(F.lit(1), F.size(turns)), empty, step)


def _spans(pieces: Column) -> Column:
    """Begin and end of the pieces that count for the loss, from (skip, take, loss) runs."""
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans")
    )

    def step(so_far, piece):
        begin = so_far["at"] + piece["skip"]
        end = begin + piece["take"]
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        spans = F.when(piece["loss"], F.concat(so_far["spans"], span)).otherwise(so_far["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, start, step)["spans"]


def format_chat(
    turns: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, formatted text, loss mask."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    convs = turns.groupBy(F.col(id_col)).agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    convs = convs.withColumn("_blocks", _merge(F.col("_turns")))

    def render(b):
        head = F.concat(
            F.lit(OPEN),
            F.coalesce(F.concat(F.lit(" "), escape(b["role"])), F.lit("")),
            F.lit(">"),
        )
        texts = F.transform(
            F.slice(F.col("_turns"), b["first"], b["n"]), lambda t: escape(t["text"])
        )
        return F.struct(
            head.alias("head"),
            texts.alias("texts"),
            F.coalesce(b["role"] == loss_role, F.lit(False)).alias("loss"),
        )

    convs = convs.withColumn("_parts", F.transform("_blocks", render))
    formatted = F.array_join(
        F.transform(
            "_parts",
            lambda p: F.concat(p["head"], F.array_join(p["texts"], NEXT), F.lit(CLOSE)),
        ),
        "",
    )

    def runs(p, at):
        opening = F.length(p["head"]) + F.when(at > 0, F.lit(len(CLOSE))).otherwise(0)
        return F.transform(
            p["texts"],
            lambda t, i: F.struct(
                F.when(i == 0, opening).otherwise(len(NEXT)).alias("skip"),
                F.length(t).alias("take"),
                p["loss"].alias("loss"),
            ),
        )

    pieces = F.flatten(F.transform("_parts", runs))
    return convs.select(id_col, formatted.alias("formatted"), _spans(pieces).alias("mask"))


def parse_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation, in order: array of (role, text)."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def block(b):
        tag = F.substring_index(b, ">", 1)
        role = F.when(tag != OPEN, unescape(F.substring(tag, len(OPEN) + 2, 1 << 30)))
        body = b.substr(F.length(tag) + 2, F.length(b))
        return F.transform(
            F.split(body, NEXT),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, block))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            mask,
            lambda m: unescape(formatted.substr(m["begin"] + 1, m["end"] - m["begin"])),
        ),
        "",
    )
