"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows may hold whole texts or vectors; a batch is bounded by its bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # Joins may reuse a partitioning on a subset of their keys (all user-keyed
    # feature groups share one shuffle on (user_id, day)).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

# Only at session start: Column operations otherwise record their Python call site, which
# costs milliseconds each and adds up over hundreds of feature columns.
# One BLAS thread per Python worker, as the tasks already fill the cores.
START_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
}


def build_session(app: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **START_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the SQL settings the jobs rely on in a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a local one is made only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
        current = sc.getCheckpointDir()
    return current


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for intermediate tables."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _scratch.append(path)
    return path


def drop_folder(path: str) -> bool:
    """Delete an intermediate table; False if it was never written."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    found = store.get_file_info(name).type == fs.FileType.Directory
    if found:
        store.delete_dir(name)
    return found


def drop_scratch() -> int:
    """Delete all intermediate tables of this process; call it when no result reads them any more."""
    dropped = 0
    while _scratch:
        dropped += drop_folder(_scratch.pop())
    return dropped


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and pins partition contents."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder as Parquet and read back; columns stay prunable."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
