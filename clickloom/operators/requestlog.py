"""Analytics over the request log of the recommendation service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import json_bytes, token_count
from clickloom.operators.quantiles import quantile_floor

REQUEST_FIELDS = ("user_id", "item_id", "model_params", "model_key")


def with_request_metrics(log: DataFrame) -> DataFrame:
    """Add ``request_size`` and ``token_count``."""
    return request_size(token_estimate(log))


def request_size(log: DataFrame, fields: Sequence[str] = REQUEST_FIELDS) -> DataFrame:
    return log.withColumn("request_size", json_bytes(fields))


def token_estimate(
    log: DataFrame, item: str = "item_id", text_fields: Sequence[str] = ("item_id",)
) -> DataFrame:
    return log.withColumn("token_count", token_count(item, text_fields))


def log_summary(log: DataFrame) -> DataFrame:
    """Totals of the whole log; an empty log gives zeros."""
    ok = F.count_if(F.col("status") == "ok")
    return log.agg(
        F.count("*").alias("total_requests"),
        F.coalesce(F.avg("duration_ms"), F.lit(0.0)).alias("avg_duration"),
        F.coalesce(F.min("duration_ms"), F.lit(0)).alias("min_duration"),
        F.coalesce(F.max("duration_ms"), F.lit(0)).alias("max_duration"),
        ok.alias("success_count"),
        F.count_if(F.col("status") == "error").alias("error_count"),
        F.coalesce(F.try_divide(ok, F.count("*")), F.lit(0.0)).alias("success_rate"),
    )


def size_summary(log: DataFrame) -> DataFrame:
    """Average request size and tokens, and the number of models, over the whole log."""
    return with_request_metrics(log).agg(
        F.coalesce(F.avg("request_size"), F.lit(0.0)).alias("avg_request_size"),
        F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_token_count"),
        F.count_distinct(F.col("model_key")).alias("models"),
    )


def duration_quantiles(log: DataFrame) -> DataFrame:
    """p50, p95 and p99 of the duration at index ``floor(nq)``; empty gives zeros."""
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = quantile_floor(log, "duration_ms", wanted)
    return found.agg(*(F.coalesce(F.max(p), F.lit(0)).alias(p) for p in wanted))


def by_model(log: DataFrame) -> DataFrame:
    return log.groupBy("model_key").agg(
        F.count("*").alias("request_count"),
        F.coalesce(F.avg("duration_ms"), F.lit(0.0)).alias("avg_duration"),
        F.coalesce(F.avg("request_size"), F.lit(0.0)).alias("avg_request_size"),
        F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_token_count"),
    )


def log_histograms(log: DataFrame, bins: int = 20) -> DataFrame:
    """(kind, bucket, count) rows: statuses, equal-width latency bins, models."""
    statuses = log.groupBy("status").agg(F.count("*").alias("count")).select(
        F.lit("status").alias("kind"), F.col("status").alias("bucket"), "count"
    )
    models = log.groupBy("model_key").agg(F.count("*").alias("count")).select(
        F.lit("model").alias("kind"), F.col("model_key").alias("bucket"), "count"
    )
    lo = log.select(F.min("duration_ms").cast("double")).scalar()
    hi = log.select(F.max("duration_ms").cast("double")).scalar()
    share = F.try_divide(F.col("duration_ms").cast("double") - lo, hi - lo)
    place = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
    latency = (
        log.where(F.col("duration_ms").isNotNull())
        .groupBy(place.cast("string").alias("bucket"))
        .agg(F.count("*").alias("count"))
        .select(F.lit("latency").alias("kind"), "bucket", "count")
    )
    return statuses.unionByName(models).unionByName(latency)


def latest(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("created_at"), F.desc("id"))
