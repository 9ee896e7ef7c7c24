"""From raw documents to token files: five stages, each written as Parquet and read again.

    quality        documents that the weak-label classifier scores under 0.5 go
    near_copies    of each group of near copies (SimHash, 4 words, 4 bits) one document stays
    benchmark      documents that hold a benchmark item, up to a tenth of its characters, go
    mixture        sources are sampled to their target weights; documents repeat or go
    tokens         what is left is encoded to flat files and read back

All stages but the last return the columns of `documents`. Null, empty and very long texts,
repeated rows, ties, empty tables and further columns are handled as the operators in
`clickloom.llm` say. ORACLE_SQL is None, as SQL can't express the classifier, the hash of the
fingerprints or the encoding; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontam, mixing, quality, simhash, tokenfiles
from clickloom.llm.queries import byte_bpe, table
from clickloom.session import apply_runtime_conf, scratch_path

ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs)
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    scored = quality.score(rows, model, name="quality_score")
    return scored.where(F.col("quality_score") >= quality.THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_group(docs, words=4, radius=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit_copies(docs, weights=(5, 2, 1), cap=3.0)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = tokenfiles.write_token_files(docs, byte_bpe())
    return tokenfiles.read_token_files(spark, folder)


STAGES = [
    ("quality", drop_low_quality),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mixture", mix),
    ("tokens", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; returns the rows of the last one."""
    apply_runtime_conf(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
