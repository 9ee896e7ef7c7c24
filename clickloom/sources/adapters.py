"""Views of the benchmark tables as clickstream tables.

``interactions`` is dense (30 days, few users), ``interactions_wide`` sparse (years,
many users). The same expressions exist as SQL text in ``plans/oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.columns import day_of


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def interactions(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        "event_id",
        "user_id",
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("item_id"),
        F.expr(
            "CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'click' "
            "WHEN 'purchase' THEN 'clickout' WHEN 'signup' THEN 'like' END"
        ).alias("action_type"),
        F.expr(
            "CASE event_id % 6 WHEN 0 THEN 'u2i' WHEN 1 THEN 'i2i' WHEN 2 THEN 'catalog' "
            "WHEN 3 THEN 'search' WHEN 4 THEN 'other' END"
        ).alias("subdomain"),
        F.expr(
            "CASE event_id % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'other' END"
        ).alias("os"),
        "ts",
        day_of("ts").alias("day"),
    )


def interactions_wide(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem")
    orders = table(spark, root, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.expr(
            "CASE WHEN l_linestatus = 'O' OR l_returnflag = 'N' THEN 'view' "
            "WHEN l_returnflag = 'A' THEN 'click' WHEN l_quantity < 35 THEN 'clickout' "
            "ELSE 'like' END"
        ).alias("action_type"),
        F.expr(
            "CASE WHEN l_linenumber = 7 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'u2i' "
            "WHEN o_orderpriority = '2-HIGH' THEN 'i2i' "
            "WHEN o_orderpriority = '3-MEDIUM' THEN 'catalog' "
            "WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE 'search' END"
        ).alias("subdomain"),
        F.expr(
            "CASE o_orderstatus WHEN 'F' THEN 'android' WHEN 'O' THEN 'ios' ELSE 'other' END"
        ).alias("os"),
        F.col("o_orderdate").alias("ts"),
        day_of("o_orderdate").alias("day"),
    )


def items(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.expr(
            "CASE WHEN p_partkey % 37 = 5 THEN NULL "
            "ELSE CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) END"
        ).alias("brand_id"),
        F.expr("CASE WHEN p_partkey % 41 = 7 THEN NULL ELSE p_type END").alias("category"),
        F.col("p_size").cast("string").alias("subcategory"),
        F.expr("CASE WHEN p_partkey % 50 = 3 THEN NULL ELSE p_retailprice END").alias("price"),
    )


def users(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.expr(
            "CASE WHEN c_custkey % 29 = 4 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 0 "
            "WHEN c_mktsegment = 'BUILDING' THEN 1 WHEN c_mktsegment = 'FURNITURE' THEN 2 "
            "WHEN c_mktsegment = 'HOUSEHOLD' THEN 3 ELSE 4 END"
        ).alias("socdem_cluster"),
        F.expr("CASE WHEN c_custkey % 31 = 6 THEN NULL ELSE c_nationkey END").alias("region"),
    )


def request_log(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.regexp_extract("props", "([0-9]+)", 1).alias("item_id"),
        F.expr(
            "CASE event_id % 3 WHEN 0 THEN 'svd' WHEN 1 THEN 'ials' ELSE 'vae' END"
        ).alias("model_key"),
        F.expr("CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END").alias("status"),
        F.expr(
            "CASE WHEN event_id % 97 = 11 THEN NULL ELSE CAST(floor(value * 10) AS INT) END"
        ).alias("duration_ms"),
        F.create_map(F.lit("source"), F.col("event_type")).alias("model_params"),
        F.col("ts").alias("created_at"),
    )
