"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

A folder holds, for each part (a range of document ids):

    part-00000.ids   token ids back to back, unsigned 16 or 32 bits, little-endian; every
                     document ends with `end_id`
    part-00000.docs  per document two signed 64-bit integers: document id, number of ids
    part-00000.off   documents + 1 unsigned 64-bit integers: position of each document in the
                     whole output, and the position after the last one
    manifest/        Parquet: part, documents, tokens, base, item_bytes

Parts follow each other in ascending document id, so position p of the output lies in the part
with base <= p < base + tokens, at item p - base of its file. Writing takes one shuffle by id
range; the parts' bases are the prefix sums of their token counts (one row per part). Readers map
the files into memory and never load a whole part.

Cases: a null text is empty and yields the end id alone; null ids come first and read back as
null; rows with equal ids are kept, in order of their text; an empty table gives no parts; other
columns are not read. A text must fit a task's memory, its neighbours need not.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.encoding import encoder
from clickloom.llm.files import new_file, new_folder, one_task_each, open_input, partitions_of

NO_ID = -(1 << 63)  # stands for a null document id
READ = 1 << 20  # items, or documents, read at a time
TEXTS = 64  # texts encoded at a time


def _kind(item_bytes: int) -> str:
    return {2: "<u2", 4: "<u4"}[item_bytes]


def _name(folder: str, part: int, kind: str) -> str:
    return f"{folder}/part-{part:05d}.{kind}"


def _writer(folder: str, tokenizer: str, end_id: int, item_bytes: int):
    def write(batches):
        part, encode = TaskContext.get().partitionId(), encoder(tokenizer).ids_of
        documents = tokens = 0
        with (
            new_file(_name(folder, part, "ids")) as items,
            new_file(_name(folder, part, "docs")) as index,
        ):
            for batch in batches:
                keys = batch.column(0).fill_null(NO_ID)
                for at in range(0, batch.num_rows, TEXTS):
                    ids, counts = encode(batch.column(1).slice(at, TEXTS).to_pylist())
                    ended = np.insert(ids, np.cumsum(counts), end_id)
                    items.write(ended.astype(_kind(item_bytes)).tobytes())
                    pairs = np.stack([keys.slice(at, TEXTS).to_numpy(), counts + 1], axis=1)
                    index.write(pairs.astype("<i8").tobytes())
                    documents += len(counts)
                    tokens += len(ended)
        if documents:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "documents": pa.array([documents], pa.int64()),
                    "tokens": pa.array([tokens], pa.int64()),
                }
            )

    return write


def _pieces(file, items: int, kind: str):
    """The whole file as arrays of at most `READ` rows of `items` values."""
    step = READ * items * 8
    for at in range(0, file.size(), step):
        yield np.frombuffer(file.read_at(min(step, file.size() - at), at), kind).reshape(-1, items)


def _offsets(folder: str):
    def write(frames):
        for frame in frames:
            for row in frame.itertuples():
                with (
                    open_input(_name(folder, row.part, "docs")) as docs,
                    new_file(_name(folder, row.part, "off")) as out,
                ):
                    out.write(np.array([row.base], "<u8").tobytes())
                    at = row.base
                    for pairs in _pieces(docs, 2, "<i8"):
                        ends = np.cumsum(pairs[:, 1]) + at
                        out.write(ends.astype("<u8").tobytes())
                        at = int(ends[-1])
            yield frame

    return write


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
) -> str:
    """Encode every text, write the files in ascending `id_col`, return the folder."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    largest = max(encoder(tokenizer).tokenizer.get_vocab_size() - 1, end_id)
    item_bytes = 2 if largest < 1 << 16 else 4
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    placed = rows.repartitionByRange(partitions_of(docs), *order[:2]).sortWithinPartitions(*order)
    stats = placed.mapInArrow(
        _writer(folder, tokenizer, end_id, item_bytes), "part int, documents long, tokens long"
    )
    stats.write.mode("overwrite").parquet(f"{folder}/counts")
    stats = spark.read.schema("part int, documents long, tokens long").parquet(f"{folder}/counts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = stats.select(
        "*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")
    ).withColumn("item_bytes", F.lit(item_bytes))
    tasks = partitions_of(docs)
    one_task_each(based, "part", tasks).mapInPandas(_offsets(folder), based.schema).write.mode(
        "overwrite"
    ).parquet(f"{folder}/manifest")
    return folder


MANIFEST = "part int, documents long, tokens long, base long, item_bytes int"


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _documents(folder: str, row):
    """(ids of documents, starts, ends, items from the first start to the last end) of stretches
    of a part; the items are a view of the mapped file."""
    kind = _kind(row.item_bytes)
    with (
        open_input(_name(folder, row.part, "docs")) as docs,
        open_input(_name(folder, row.part, "off")) as off,
        open_input(_name(folder, row.part, "ids")) as items,
    ):
        done = 0
        for pairs in _pieces(docs, 2, "<i8"):
            raw = off.read_at(8 * (len(pairs) + 1), 8 * done)
            bounds = np.frombuffer(raw, "<u8").astype(np.int64)
            done += len(pairs)
            first = 0
            while first < len(pairs):
                last = int(np.searchsorted(bounds, bounds[first] + READ, "right")) - 1
                last = min(max(last, first + 1), len(pairs))
                at, to = int(bounds[first]), int(bounds[last])
                raw = items.read_at((to - at) * row.item_bytes, (at - row.base) * row.item_bytes)
                starts, ends = bounds[first:last], bounds[first + 1 : last + 1]
                yield pairs[first:last, 0], starts, ends, np.frombuffer(raw, kind)
                first = last


def _reader(folder: str, with_ids: bool):
    def read(batches):
        for row in (r for b in batches for r in b.to_pandas().itertuples()):
            for keys, starts, ends, ids in _documents(folder, row):
                wide, at = ids.astype("<u4"), int(starts[0])
                bytes_, cuts = memoryview(wide).cast("B"), ((ends - at) * 4).tolist()
                crcs = [zlib.crc32(bytes_[a:b]) for a, b in zip([0, *cuts], cuts)]
                columns = {
                    "doc_id": pa.array(keys, pa.int64(), mask=keys == NO_ID),
                    "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(ends - starts, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
                if with_ids:
                    offsets = pa.array(np.append(starts, ends[-1]) - at, pa.int32())
                    columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(wide, pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return read


def read_token_files(spark: SparkSession, folder: str, *, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return one_task_each(read_manifest(spark, folder), "part", tasks).mapInArrow(
        _reader(folder, with_ids), schema + (", ids array<long>" if with_ids else "")
    )


