"""Reading daily event files and choosing day ranges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.vocab import DAY_US

EVENTS = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("action_type", T.StringType()),
        T.StructField("subdomain", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("day", T.IntegerType()),
    ]
)
ITEMS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("brand_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)
USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("socdem_cluster", T.IntegerType()),
        T.StructField("region", T.IntegerType()),
    ]
)


def _day_files(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Day -> paths of the flat ``{day}.<ext>`` files of a folder, any number a day; other names
    are ignored."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    if store.exists(folder):
        for status in store.listStatus(folder):
            stem = status.getPath().getName().split(".")[0]
            if stem.isdigit():
                found.setdefault(int(stem), []).append(status.getPath().toString())
    return found


def write_day_files(events: DataFrame, path: str, parts: int = 16) -> None:
    """Flat files ``{day}.{task}.parquet`` without the column ``day``, up to ``parts`` a day.

    A task streams its rows, ordered by day, into one file at a time, so a hot day spreads
    over tasks and none holds it. Files are written as drafts, which readers pass over, and get
    their names when the task has written all of them: an attempt that fails leaves no day file,
    and one that is repeated replaces its files by equal ones.
    """
    salt = F.pmod(F.xxhash64(*events.columns), F.lit(parts))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, name = fs.FileSystem.from_uri(path)
        where.create_dir(name, recursive=True)
        context = TaskContext.get()
        task, attempt = context.partitionId(), context.taskAttemptId()
        out, current, drafts = None, None, []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for day in rows["day"].unique().to_pylist():  # in order, as the rows are
                part = rows.filter(pc.equal(rows["day"], day)).drop_columns(["day"])
                if day != current:
                    if out is not None:
                        out.close()
                    file, current = f"{name}/{day}.{task:05d}.parquet", day
                    draft = f"{name}/_draft-{day}-{task:05d}-{attempt}"
                    out = parquet.ParquetWriter(draft, part.schema, filesystem=where)
                    drafts.append((draft, file))
                out.write_table(part)
        if out is not None:
            out.close()
        for draft, file in drafts:
            where.move(draft, file)
        yield from ()

    dated = events.where(F.col("day").isNotNull())
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = dated.repartition(tasks, "day", salt).sortWithinPartitions("day")
    placed.mapInArrow(store, "day int").write.format("noop").mode("overwrite").save()


def read_events(
    spark: SparkSession,
    path: str,
    day_from: int | None = None,
    day_to: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Events of a day range. Missing days are skipped, no day at all is an error.

    Takes a ``day=`` partitioned table (the range prunes partitions) or a folder of
    flat daily files (only the files of the range are opened, the day comes from the
    file name).
    """
    flat = _day_files(spark, path)
    if flat:
        wanted = [
            p
            for d, paths in sorted(flat.items())
            for p in paths
            if (day_from is None or d >= day_from) and (day_to is None or d <= day_to)
        ]
        if not wanted:
            raise FileNotFoundError(f"no daily files in {path} for [{day_from}, {day_to}]")
        reader = spark.read.schema(schema) if schema else spark.read
        return with_day_from_file(reader.parquet(*wanted))
    reader = spark.read.schema(schema) if schema else spark.read
    events = reader.parquet(path)
    if day_from is not None:
        events = events.where(F.col("day") >= day_from)
    if day_to is not None:
        events = events.where(F.col("day") <= day_to)
    if events.select("day").isEmpty():
        raise FileNotFoundError(f"no events in {path} for [{day_from}, {day_to}]")
    return events


def with_day_from_file(df: DataFrame, pattern: str = r"(\d+)\.[^/]*$") -> DataFrame:
    """``day`` = the number in the name of the file a row was read from.

    By default the integer stem of the file; null where there is none.
    """
    found = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return df.withColumn("day", found.try_cast("int"))


def with_day_from_ts(df: DataFrame, ts_us: str) -> DataFrame:
    return df.withColumn("day", F.expr(f"{ts_us} div {DAY_US}").cast("int"))


def resolve_day_range(
    df: DataFrame, day_from: int | None = None, day_to: int | None = None
) -> tuple[int, int]:
    """Fill missing bounds with the first and last stored day."""
    if day_from is not None and day_to is not None:
        return day_from, day_to
    first, last = df.agg(F.min("day"), F.max("day")).first()
    if first is None:
        raise FileNotFoundError("no stored days")
    return (first if day_from is None else day_from, last if day_to is None else day_to)


def day_range(df: DataFrame) -> DataFrame:
    """The stored range as a one-row frame."""
    return df.agg(F.min("day").alias("day_from"), F.max("day").alias("day_to"))


def last_n_days(df: DataFrame, n: int) -> DataFrame:
    """Rows of the n latest days that exist (gaps do not count)."""
    days = df.select("day").distinct().orderBy(F.desc("day")).limit(n)
    return df.join(F.broadcast(days), "day", "left_semi")


def last_fraction_of_days(df: DataFrame, fraction: float) -> DataFrame:
    """Rows of the last ``max(int(days * fraction), 1)`` calendar days."""
    days = F.max("day") - F.min("day") + 1
    kept = F.greatest(F.floor(days * F.lit(fraction)), F.lit(1))
    start = df.select((F.max("day") - kept + 1).cast("long")).scalar()
    return df.where(F.col("day") >= start)
