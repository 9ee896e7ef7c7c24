"""Files that tasks write below the session's shared folder.

Tasks open them through `pyarrow.fs`, so any store that has a file system there (local or
mounted, S3, GCS, HDFS with libhdfs) will do. A file is written under a name of its own and then
moved into place: a repeated or speculative task replaces a file by an equal one, and readers
never see half a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import scratch_path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return scratch_path(spark, name)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@contextmanager
def new_file(path: str) -> Iterator:
    """An output stream; the file is put in place when the block ends without an error."""
    store, name = opened(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    draft = f"{name}.{uuid.uuid4().hex}.draft"
    with store.open_output_stream(draft) as out:
        yield out
    store.move(draft, name)


def write_file(path: str, chunks) -> int:
    """Write byte chunks as one file, in place at once; returns the bytes written."""
    size = 0
    with new_file(path) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    return size


def open_input(path: str):
    """Random access to a file; memory-mapped where the store is a local or mounted folder."""
    import pyarrow as pa

    store, name = opened(path)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(name)
    return store.open_input_file(name)


def one_task_each(df: DataFrame, key: str, count: int) -> DataFrame:
    """Deal `count` descriptor rows numbered 0.. in `key` over as many tasks, evenly."""
    if count <= 1:
        return df.coalesce(1)
    return df.repartitionByRange(count, F.col(key))


def partitions_of(df: DataFrame) -> int:
    """Tasks for a shuffle of `df`: the session's setting, never under the scan's own count."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
