"""Merkle manifest of a dataset: leaves per row, a tree per group, a tree over the groups' roots.

Levels are strings. The leaves of a group, in order, are cut into aligned blocks of 512; a block
keeps its leaves as one string of 64 hexadecimal digits each, the nodes above them (a node is the
SHA-256 of up to eight neighbours, concatenated) as a second string, and so on up to the block's
single node. Parents come from hashing substrings of fixed width; the siblings of a node are what
lies left and right of it in its run of eight. The blocks' nodes are the leaves of the next stage,
cut into blocks in turn, until each group has one node, its subroot. The subroots, in order of the
groups, are the leaves of one more tree, whose node is the root.

A manifest is the list of these stages, each a table in the shared folder with one row per block
(73 bytes a leaf). `proofs` opens it from the top: every block receives the siblings above its own
node once and hands them to its members, so a row's proof is made where it is used and never
stored. Positions come from range partitions and running totals over one row per partition and
group; a group that holds a third of all rows spans a third of the partitions, and no block holds
more than 512 rows.

Cases: a null field is `-` (an empty text is `0:`), a null group is a group of its own, before
all others; rows with equal ids stand in order of their leaves, null ids first; equal rows are
leaves of their own; an empty table has no blocks and gives no proofs; other columns travel in one
struct, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.files import partitions_of
from clickloom.session import materialize

FAN = 8  # nodes under a parent
BLOCK = FAN**3  # leaves in a block, which has three levels above them
HEX = 64  # digits of a node


@dataclass
class Manifest:
    """Stages of the trees of the groups, then of the tree over their subroots; each bottom up.

    A stage has columns grp, block, members (array of structs: pos, node, row) and levels (strings).
    """

    groups: list[DataFrame]
    top: list[DataFrame]


def leaf(*fields: Column) -> Column:
    """SHA-256 over the fields: `-` if null, else byte count, `:` and the value as text."""
    parts = []
    for field in fields:
        value = field.cast("string")
        length = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(length, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with `pos`, their 0-based place in their `grp` in this order."""
    rows = materialize(rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    order = [F.col("grp"), *order, F.col("_tie")]
    sorted_rows = rows.repartitionByRange(partitions_of(rows), *order).sortWithinPartitions(*order)
    placed = materialize(
        sorted_rows.drop("_tie").withColumn("_row", F.monotonically_increasing_id()), "placed"
    ).withColumn("_part", F.shiftright("_row", 33))
    starts = placed.groupBy("grp", "_part").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_rows")
    )
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Group and partition are one column of the join, else both sides would be dealt by group alone.
    at = F.struct("grp", "_part").alias("_at")
    starts = starts.select(
        at, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return placed.withColumn("_at", at).join(starts, "_at").select(
        "grp", (F.col("_before") + F.col("_row") - F.col("_first")).alias("pos"), "node", "row"
    )


def _parents(level: str) -> str:
    runs = f"sequence(0, (length({level}) - 1) div {FAN * HEX})"
    cut = f"substring({level}, {FAN * HEX} * i + 1, {FAN * HEX})"
    return f"array_join(transform({runs}, i -> sha2({cut}, 256)), '')"


def _blocks(rows: DataFrame) -> DataFrame:
    """One stage: rows (grp, pos, node, row) -> blocks with their level strings.

    A block that is its group's only one ends at its single node; any other has all three levels.
    Only a first block with room left can be the only one of several possible heights.
    """
    member = F.struct("pos", "node", "row")
    blocks = rows.groupBy("grp", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list(member), lambda a, b: (a["pos"] - b["pos"]).cast("int")).alias(
            "members"
        )
    )
    blocks = blocks.withColumn("l0", F.expr("array_join(members.node, '')"))
    for height in range(1, 4):
        tall = f"block > 0 or size(members) > {FAN ** (height - 1)}"
        blocks = blocks.withColumn(
            f"l{height}", F.expr(f"if({tall}, {_parents(f'l{height - 1}')}, null)")
        )
    levels = F.array_compact(F.array("l0", "l1", "l2", "l3"))
    return materialize(blocks.select("grp", "block", "members", levels.alias("levels")), "merkle")


def _tree(rows: DataFrame) -> list[DataFrame]:
    """Stages up to the one in which every group has one block."""
    stages = []
    while True:
        stages.append(_blocks(rows))
        if not stages[-1].agg(F.max("block")).first()[0]:
            return stages
        rows = stages[-1].select(
            "grp",
            F.col("block").alias("pos"),
            F.element_at("levels", -1).alias("node"),
            F.lit(None).cast("string").alias("row"),
        )


def build(
    rows: DataFrame, *, group_col: str = "lang", id_col: str = "doc_id", leaf_col: str = "leaf"
) -> Manifest:
    """The manifest of a table that has a leaf per row; its other columns are kept along."""
    group = F.col(group_col).cast("string")
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("grp"),  # null first, bytewise
        F.col(leaf_col).alias("node"),
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
    )
    groups = _tree(_placed(leaves, [F.col("id").asc_nulls_first(), F.col("node")]))
    subroots = groups[-1].select(
        F.lit("").alias("grp"),
        F.element_at("levels", -1).alias("node"),
        F.col("grp").alias("row"),
    )
    return Manifest(groups, _tree(_placed(subroots, [F.col("row")])))


# Siblings of member i at each level below the block's node. Binary, as substrings of it need not
# count characters from the start.
_NODE = "i div shiftleft(1, 3 * l)"
_RUN = f"({_NODE} div {FAN}) * {FAN * HEX}"
_LEFT = f"substring(level, {_RUN} + 1, ({_NODE} % {FAN}) * {HEX})"
_RIGHT = f"substring(level, ({_NODE} + 1) * {HEX} + 1, {_RUN} + {FAN * HEX} - ({_NODE} + 1) * {HEX})"
_OPENED = f"""
transform(sequence(0, size(members) - 1), i -> named_struct(
    'member', members[i],
    'proof', concat(
        transform(below, (level, l) -> named_struct('left', {_LEFT}, 'right', {_RIGHT})),
        above)))"""


def _opened(stage: DataFrame, above: DataFrame) -> DataFrame:
    """Members of a stage with their proofs: those of their blocks (`above`: grp, block, above
    and columns to keep) below those within the block."""
    kept = [c for c in above.columns if c not in ("grp", "block", "above")]
    below = F.transform(
        F.slice("levels", 1, F.size("levels") - 1), lambda level: level.cast("binary")
    )
    blocks = stage.join(above, ["grp", "block"]).withColumn("below", below)
    members = blocks.select("grp", F.explode(F.expr(_OPENED)).alias("m"), *kept)
    return members.select("grp", "m.member.*", "m.proof", *kept)


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: leaf, row (all its columns), proof (array of left and right siblings up to
    the root, as bytes of hexadecimal digits), subroot, root."""
    last = manifest.top[-1]
    nothing = F.expr("cast(array() as array<struct<left: binary, right: binary>>)")
    above = last.select(
        "grp", "block", nothing.alias("above"), F.element_at("levels", -1).alias("root")
    )
    for stage in reversed(manifest.top):
        opened = _opened(stage, above)
        above = opened.select("grp", F.col("pos").alias("block"), F.col("proof").alias("above"), "root")
    above = opened.select(
        F.col("row").alias("grp"),
        F.lit(0).cast("long").alias("block"),
        F.col("proof").alias("above"),
        F.col("node").alias("subroot"),
        "root",
    )
    for stage in reversed(manifest.groups):
        opened = _opened(stage, above)
        above = opened.select(
            "grp", F.col("pos").alias("block"), F.col("proof").alias("above"), "subroot", "root"
        )
    return opened.select(F.col("node").alias("leaf"), "row", "proof", "subroot", "root")


def folded(leaf_col: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    node = F.aggregate(
        proof,
        leaf_col.cast("binary"),
        lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256).cast("binary"),
    )
    return node.cast("string")


def siblings(proof: Column) -> Column:
    """All siblings of a proof as one string, level by level, left to right."""
    every = F.aggregate(
        proof, F.lit("").cast("binary"), lambda all_, s: F.concat(all_, s["left"], s["right"])
    )
    return every.cast("string")
