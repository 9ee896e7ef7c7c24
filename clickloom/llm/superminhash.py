"""Near copies by the Jaccard similarity of word shingles: SuperMinHash, banding, verification.

A document's set holds its distinct shingles (`words` words in a row after lower-casing A-Z; a
shorter text is one shingle), each as a 64-bit hash. Documents with 100 * |A & B| >= percent *
|A | B| are linked, and groups are the components of the links.

Signature. SuperMinHash gives every element a permutation of the signature's places; the element
offers (its rank there, random fraction) to each place, and a place keeps the smallest offer. The
offers are made rank by rank for a batch of texts at once, and a text stops at the first rank by
which all its places are taken, as later ranks cannot win: a long text stops after one, and any
text makes about as many offers as it has elements and places * ln(places). The permutations come
from a table of Fisher-Yates shuffles, turned by an amount of the element's own.

Banding. Places form bands; texts that agree on a band share a bucket. With 32 bands of 6 a link
of similarity exactly 0.85 is in no bucket with a chance of 3 in ten million, a closer one less.

Verification is exact, on whole sets. Equal sets are one class from the start, and buckets with
the same members are one bucket. Work goes in rounds: in each bucket some classes, the centres, are
compared with all members of other components, and leave the bucket; links join components; a
bucket whose members are one component is done. Centres come from outside the bucket's largest
component, those that share most buckets first (the text that others were copied from), one a
bucket in the first round, then 512. So work in a bucket is its size times the members
that links have not joined yet, and no pair is left out. Only buckets that hold 10^5 texts of
little likeness would need very many rounds.

Pairs that cannot be links are told inside the join that would make them. Shingles fall into 64
parts by hash; of each class the shingles of every part are counted, less those that no other class
has. Two sets share at most the smaller count of each part, so the sum of these bounds their
similarity. In a large group of texts that are nearly close enough, almost no pair comes further.

A text is hashed once for its signature, and once more for its set if it shares a bucket; texts
are found again by MD5, and a bitmap of fixed size keeps most others out of that shuffle. Rows of
hot classes, buckets, nodes and components are spread over tasks (`skew`). Everything that is
collected is one number a round.

Cases: a null or empty text, or one without words, has no shingles, is linked with nothing and is
its own component; repeated rows are rows of their own; null ids never name a component: one
whose ids are all null has a null name; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.skew import hot_keys, join_spread
from clickloom.session import materialize

SEED = 42
BANDS = 32
ROWS = 6  # places in a band
TURNS = 1024  # shuffles in the table
CENTRES = 512  # members of a bucket that are compared with the rest in a round
PARTS = 64  # parts of the shingles in which sets are counted
CACHE = 1_000_000  # distinct words kept by a worker; beyond that the table starts anew
ELEMENTS = 1 << 17  # elements, and
TEXTS = 256  # texts that make offers at once

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _step(k: int) -> np.uint64:
    return np.uint64(k * int(_GOLD) & int(_FREE))


def _shuffles(places: int) -> np.ndarray:
    """TURNS shuffles of the places, Fisher-Yates step by step."""
    table = np.tile(np.arange(places, dtype=np.int64), (TURNS, 1))
    rows = np.arange(TURNS)
    for j in range(places - 1):
        draw = _mix(rows.astype(np.uint64) * np.uint64(places) + np.uint64(j) + _GOLD)
        other = j + (draw % np.uint64(places - j)).astype(np.int64)
        table[rows, j], table[rows, other] = table[rows, other], table[rows, j].copy()
    return table


class Signer:
    """Signatures of sets of 64-bit hashes; one object per worker."""

    def __init__(self, places: int):
        if places > 256:
            raise ValueError("a signature has 256 places at most")
        self.places, self.table = places, _shuffles(places)

    def sign(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of `places` values per set, none of which may be empty."""
        m = self.places
        lengths = [len(s) for s in sets]
        values = np.full(len(sets) * m, _FREE)
        element = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), lengths)
        pick = (element & np.uint64(TURNS - 1)).astype(np.int64)
        turn = ((element >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        first = owner * m
        for rank in range(m):
            place = self.table[pick, rank] + turn
            place[place >= m] -= m
            place += first
            level = np.uint64(rank << 56)
            if rank:
                open_ = values[place] >= level
                offer, place = element[open_], place[open_]
            else:
                offer = element
            offer = _mix(offer + _step(rank + 1)) >> np.uint64(8) | level
            np.minimum.at(values, place, offer)
            waiting = (values.reshape(-1, m) == _FREE).any(axis=1)
            if not waiting.any():
                break
            stay = waiting[owner]
            if not stay.all():
                element, owner, pick, turn, first = (
                    x[stay] for x in (element, owner, pick, turn, first)
                )
        return values.reshape(-1, m)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One signed 64-bit key per row and band."""
    parts = signatures.reshape(len(signatures), bands, -1)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, parts.shape[:2])
    for k in range(parts.shape[2]):
        keys = _mix(keys ^ parts[:, :, k]) + _GOLD
    return keys.view(np.int64)


class _Hashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


class Shingles:
    """Sorted distinct shingle hashes of a text; one object per worker."""

    def __init__(self, words: int):
        self.words, self.hashes = words, _Hashes()

    def of(self, text: bytes | None) -> np.ndarray:
        found = (text or b"").lower().split()
        if len(self.hashes) > CACHE:
            self.hashes.clear()
        each = np.fromiter(map(self.hashes.__getitem__, found), np.uint64, len(found))
        width = min(self.words, len(each))
        if not width:
            return each
        rolled = np.full(len(each) - width + 1, np.uint64(width))
        for k in range(width):
            rolled = _mix(rolled * _GOLD + each[k : k + len(rolled)])
        return np.unique(rolled)


def _sign(words: int, bands: int, rows: int):
    def sign(batches):
        shingles, signer = Shingles(words), Signer(bands * rows)

        def signed(keys, sets):
            filled = [s for s in sets if len(s)]
            found = iter(band_keys(signer.sign(filled), bands)) if filled else iter(())
            return pa.RecordBatch.from_arrays(
                [
                    *keys,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(found) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["id", "text_key", "n", "digest", "bands"],
            )

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            at, held, sets = 0, 0, []
            for i in range(batch.num_rows):
                sets.append(shingles.of(texts[i].as_py()))
                held += len(sets[-1])
                if held >= ELEMENTS or len(sets) >= TEXTS or i + 1 == batch.num_rows:
                    keys = [batch.column(k).slice(at, len(sets)) for k in (0, 1)]
                    yield signed(keys, sets)
                    at, held, sets = i + 1, 0, []

    return sign


def _sets(words: int):
    def find(batches):
        shingles = Shingles(words)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                found = shingles.of(texts[i].as_py()).view(np.int64)
                ends = pa.array([0, len(found)], pa.int32())
                sizes = np.bincount(found % PARTS, minlength=PARTS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1),
                        pa.ListArray.from_arrays(ends, pa.array(found)),
                        pa.array([sizes], pa.list_(pa.int64())),
                    ],
                    ["node", "shingles", "sizes"],
                )

    return find


def _signed(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int):
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.md5(text).alias("text_key"), text)
    schema = "id long, text_key string, n long, digest binary, bands array<long>"
    return materialize(texts.mapInArrow(_sign(words, bands, rows), schema), "signed")


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set: node, digest, least id, rows, n, a text that has the set, bands."""
    found = signed.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("least"),
        F.count("*").alias("count"),
        F.first("n").alias("n"),
        F.min("text_key").alias("text_key"),
        F.first("bands").alias("bands"),
    )
    return materialize(found.withColumn("node", F.monotonically_increasing_id()), "classes")


def _members(classes: DataFrame) -> DataFrame:
    """(bucket, node, n, weight): buckets with two classes or more, each set of members once;
    weight is the number of members of all the node's buckets."""
    keys = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = (
        keys.groupBy("bucket")
        .agg(
            F.count("*").alias("count"),
            F.bit_xor(F.xxhash64("node")).alias("one"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
        )
        .where("count > 1")
        .groupBy("count", "one", "two")
        .agg(F.min("bucket").alias("bucket"))
    )
    shared = materialize(shared.select("bucket", "count"), "buckets")
    total = shared.agg(F.sum("count")).first()[0] or 0
    members = materialize(
        join_spread(keys, shared, "bucket", hot_keys(shared, "bucket", total), "node"), "members"
    )
    weights = members.groupBy("node").agg(F.sum("count").alias("weight"))
    return materialize(members.join(weights, "node").drop("count"), "members")


BIT = "pmod(shiftright(_hash, 12), 32768)"


def _needed_sets(docs, text_col, classes, members, words) -> DataFrame:
    """(node, shingles) of the classes that share a bucket. Texts whose bit is not in a bitmap of
    the wanted keys stay out (8 MB at most, whatever the data), and copies of a text are reduced to
    one in each task before any is shuffled."""
    wanted = materialize(
        classes.select("node", "text_key").join(members.select("node").distinct(), "node"), "wanted"
    )
    slots = min(2048, 1 + wanted.count() // 1024)
    slot = F.pmod(F.xxhash64("text_key"), F.lit(slots)).alias("_slot")
    bitmaps = (
        wanted.select(F.xxhash64("text_key").alias("_hash"), slot)
        .groupBy("_slot")
        .agg(F.expr(f"bitmap_construct_agg({BIT}) AS _bits"))
    )
    text = F.col(text_col).cast("string")
    byte = f"conv(hex(substring(_bits, cast({BIT} div 8 as int) + 1, 1)), 16, 10)"
    known = f"shiftright(cast({byte} as int), cast({BIT} % 8 as int)) & 1 = 1"
    one = (
        docs.select(F.md5(text).alias("text_key"), text.alias("text"))
        .where("text_key is not null")
        .select("*", F.xxhash64("text_key").alias("_hash"), slot)
        .join(F.broadcast(bitmaps), "_slot")
        .where(known)
        .groupBy("text_key")
        .agg(F.first("text").alias("text"))
    )
    found = one.join(wanted, "text_key").select("node", "text")
    schema = "node long, shingles array<long>, sizes array<long>"
    return materialize(found.mapInArrow(_sets(words), schema), "sets")


def _profiles(sets: DataFrame) -> DataFrame:
    """(node, parts): per part, the number of shingles that other classes have too."""
    shingle = sets.select("node", F.explode("shingles").alias("shingle"))
    alone = (
        shingle.groupBy("shingle")
        .agg(F.count("*").alias("count"), F.min("node").alias("node"))
        .where("count = 1")
        .groupBy("node", F.pmod("shingle", F.lit(PARTS)).alias("part"))
        .agg(F.count("*").alias("count"))
        .groupBy("node")
        .agg(F.map_from_entries(F.collect_list(F.struct("part", "count"))).alias("alone"))
    )
    lost = "coalesce(alone[cast(p as bigint)], 0)"
    parts = F.expr(f"transform(sizes, (n, p) -> cast(n - {lost} as int))")
    found = sets.select("node", "sizes").join(alone, "node", "left")
    return materialize(found.select("node", parts.alias("parts")), "profiles")


def _alike(small: Column, large: Column, percent: int) -> Column:
    """Sizes that a link may have: the smaller set could lie within the larger."""
    return F.lit(100) * F.least(small, large) >= F.lit(percent) * F.greatest(small, large)


def _may_link(percent: int) -> Column:
    """Whether the counts per part leave room for a link of n and other_n shingles."""
    both = F.expr(
        "aggregate(zip_with(parts, other_parts, (x, y) -> least(x, y)), 0, (at, x) -> at + x)"
    )
    return F.lit(100) * both >= F.lit(percent) * (F.col("n") + F.col("other_n") - both)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are close enough."""
    total = pairs.count()
    joined = pairs
    for side, other in (("a", "b"), ("b", "a")):
        degrees = pairs.groupBy(side).agg(F.count("*").alias("count"))
        side_sets = sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}"))
        joined = join_spread(joined, side_sets, side, hot_keys(degrees, side, total), other)
    both = F.size(F.array_intersect("set_a", "set_b"))
    any_ = F.size("set_a") + F.size("set_b") - both
    return joined.where(F.lit(100) * both >= F.lit(percent) * any_).select("a", "b")


def _open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: with comp, and largest, the component
    with most members in the bucket."""
    labelled = members.join(roots, "node", "left").select(
        *members.columns, F.coalesce("root", "node").alias("comp")
    )
    labelled = materialize(labelled, "labelled")
    shares = labelled.groupBy("bucket", "comp").agg(
        F.count("*").alias("share"), F.max("weight").alias("weight")
    )
    mixed = (
        shares.groupBy("bucket")
        .agg(
            F.max_by("comp", F.struct("share", -F.col("weight"), "comp")).alias("largest"),
            F.sum("share").alias("count"),
            F.count("*").alias("comps"),
        )
        .where("comps > 1")
    )
    mixed = materialize(mixed, "mixed")
    hot = hot_keys(mixed, "bucket", mixed.agg(F.sum("count")).first()[0] or 0)
    return materialize(
        join_spread(labelled, mixed.select("bucket", "largest"), "bucket", hot, "node"), "open"
    )


RANK = """row_number() over
(partition by bucket order by comp = largest, weight desc, xxhash64(node), node)"""


def _linked_classes(members: DataFrame, sets: DataFrame, percent: int, centres: int) -> DataFrame:
    """(node, root) of the linked classes: links connect all that share a bucket and are close
    enough."""
    profiles = _profiles(sets)
    spark = members.sparkSession
    links = pairs = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    turn = 1  # the first round joins most groups; then as many centres as are allowed
    while True:
        open_ = _open_members(members, roots)
        total = open_.count()
        if not total:
            return roots
        # So many of a bucket at most leave each map task: no task receives a hot bucket whole.
        chosen = materialize(
            open_.withColumn("rank", F.expr(RANK)).where(F.col("rank") <= turn), "centres"
        )
        turn = centres
        counts = open_.groupBy("bucket").agg(F.count("*").alias("count"))
        hot = hot_keys(counts, "bucket", total)
        centre = chosen.join(profiles, "node").select(
            "bucket",
            F.col("parts").alias("other_parts"),
            F.col("node").alias("other"),
            F.col("n").alias("other_n"),
            F.col("comp").alias("other_comp"),
        )
        new = (
            join_spread(open_.join(profiles, "node"), centre, "bucket", hot, "node")
            .where("comp <> other_comp")
            .where(_alike(F.col("n"), F.col("other_n"), percent))
            .where(_may_link(percent))
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct()
        )
        new = materialize(new.join(pairs, ["a", "b"], "left_anti"), "pairs")
        fresh = materialize(_links(new, sets, percent), "links")
        if fresh.limit(1).count():
            links = materialize(links.unionByName(fresh), "links")
            roots = materialize(components(links), "roots")
        pairs = materialize(pairs.unionByName(new), "pairs")
        members = materialize(
            open_.select(*members.columns).join(
                chosen.select("bucket", "node"), ["bucket", "node"], "left_anti"
            ),
            "members",
        )


def near_copies(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    percent: int = 85,
    bands: int = BANDS,
    rows: int = ROWS,
    centres: int = CENTRES,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links)."""
    signed = _signed(docs, id_col, text_col, words, bands, rows)
    classes = _classes(signed)
    members = _members(classes)
    sets = _needed_sets(docs, text_col, classes, members, words)
    roots = _linked_classes(members, sets, percent, centres)

    linked = materialize(classes.join(roots, "node").select("digest", "root", "least"), "linked")
    names = linked.groupBy("root").agg(
        F.min("least").alias("component"), F.count("*").alias("count")
    )
    hot = hot_keys(names, "root", linked.count())
    named = join_spread(linked, names.drop("count"), "root", hot, "digest").select("digest", "component")
    groups = materialize(
        classes.select("digest", "least", "count", F.lit(True).alias("_of"))
        .join(named.withColumn("_linked", F.lit(True)), "digest", "left")
        .select(
            "digest",
            "count",
            F.when(F.col("_linked"), F.col("component"))
            .otherwise(F.col("least"))
            .alias("component_id"),
        ),
        "groups",
    )
    rows_ = signed.where("digest is not null").select(
        "id", "n", "digest", F.monotonically_increasing_id().alias("_row")
    )
    hot = hot_keys(groups, "digest", groups.agg(F.sum("count")).first()[0] or 0)
    found = join_spread(rows_, groups.drop("count"), "digest", hot, "_row")
    alone = signed.where("digest is null").select("id", "n", F.col("id").alias("component_id"))
    every = found.select("id", "n", "component_id").unionByName(alone)
    return every.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"
    )
