"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.session import apply_runtime_conf
from clickloom.vocab import ACTIONS, SUBDOMAINS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The adapters of sources/adapters.py as SQL text for the checking engine.
VIEWS = {
    "interactions": """
        SELECT event_id, user_id,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id,
               CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'click'
                    WHEN 'purchase' THEN 'clickout' WHEN 'signup' THEN 'like' END AS action_type,
               CASE event_id % 6 WHEN 0 THEN 'u2i' WHEN 1 THEN 'i2i' WHEN 2 THEN 'catalog'
                    WHEN 3 THEN 'search' WHEN 4 THEN 'other' END AS subdomain,
               CASE event_id % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'other' END AS os,
               ts, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day
        FROM events""",
    "interactions_wide": """
        SELECT l_orderkey * 10 + l_linenumber AS event_id, o_custkey AS user_id,
               l_partkey AS item_id,
               CASE WHEN l_linestatus = 'O' OR l_returnflag = 'N' THEN 'view'
                    WHEN l_returnflag = 'A' THEN 'click'
                    WHEN l_quantity < 35 THEN 'clickout' ELSE 'like' END AS action_type,
               CASE WHEN l_linenumber = 7 THEN NULL
                    WHEN o_orderpriority = '1-URGENT' THEN 'u2i'
                    WHEN o_orderpriority = '2-HIGH' THEN 'i2i'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'catalog'
                    WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE 'search' END AS subdomain,
               CASE o_orderstatus WHEN 'F' THEN 'android' WHEN 'O' THEN 'ios'
                    ELSE 'other' END AS os,
               o_orderdate AS ts,
               CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT p_partkey AS item_id,
               CASE WHEN p_partkey % 37 = 5 THEN NULL
                    ELSE CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) END AS brand_id,
               CASE WHEN p_partkey % 41 = 7 THEN NULL ELSE p_type END AS category,
               CAST(p_size AS VARCHAR) AS subcategory,
               CASE WHEN p_partkey % 50 = 3 THEN NULL ELSE p_retailprice END AS price
        FROM part""",
    "users": """
        SELECT c_custkey AS user_id,
               CASE WHEN c_custkey % 29 = 4 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 0
                    WHEN c_mktsegment = 'BUILDING' THEN 1 WHEN c_mktsegment = 'FURNITURE' THEN 2
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN 3 ELSE 4 END AS socdem_cluster,
               CASE WHEN c_custkey % 31 = 6 THEN NULL ELSE c_nationkey END AS region
        FROM customer""",
    "request_log": """
        SELECT event_id AS id, user_id, regexp_extract(props, '([0-9]+)', 1) AS item_id,
               CASE event_id % 3 WHEN 0 THEN 'svd' WHEN 1 THEN 'ials' ELSE 'vae' END AS model_key,
               CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
               CASE WHEN event_id % 97 = 11 THEN NULL
                    ELSE CAST(floor(value * 10) AS INTEGER) END AS duration_ms,
               event_type AS source, ts AS created_at
        FROM events""",
    # Events with every scalar target.
    "targeted": """
        SELECT i.*, c.len, t.total / c.len AS target, ln(1 + t.total / c.len) AS log_target,
               sqrt(t.total / c.len) AS sqrt_target, ln(t.total / c.len) + 1 AS log_weight
        FROM interactions i
        JOIN (SELECT action_type, CAST(count(*) AS DOUBLE) AS len FROM interactions GROUP BY 1) c
          ON i.action_type = c.action_type
        CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS total FROM interactions) t""",
    "train": """
        SELECT * FROM targeted WHERE day < (SELECT max(day) - 5 FROM targeted)""",
    "test": """
        SELECT * FROM targeted WHERE day > (SELECT max(day) - 5 FROM targeted)""",
    "truth": """
        SELECT user_id, item_id, max(log_target) AS rel, count(*) AS n FROM test GROUP BY 1, 2""",
    "pop": """
        SELECT item_id, count(*) AS popularity,
               row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank
        FROM train GROUP BY item_id""",
    "preds": """
        SELECT * FROM (
          SELECT u.user_id, p.item_id, CAST(p.popularity AS DOUBLE) AS score,
                 row_number() OVER (PARTITION BY u.user_id ORDER BY p.rank) - 1 AS pos
          FROM (SELECT DISTINCT user_id FROM test) u CROSS JOIN pop p
          WHERE NOT EXISTS (SELECT 1 FROM train s
                            WHERE s.user_id = u.user_id AND s.item_id = p.item_id))
        WHERE pos < 15""",
    # One row per (day, user, item) with all counters.
    "aggs": "SELECT day, user_id, item_id, "
    + ", ".join(
        f"count(*) FILTER (action_type = '{a}'"
        + (f" AND subdomain = '{s}'" if s != "all_subdomains" else "")
        + f") AS num_{a}_{s}"
        for a in ACTIONS
        for s in [*SUBDOMAINS, "all_subdomains"]
    )
    + " FROM interactions WHERE action_type IS NOT NULL GROUP BY 1, 2, 3",
}
NEEDS = {
    "targeted": ["interactions"],
    "train": ["targeted"],
    "test": ["targeted"],
    "truth": ["test"],
    "pop": ["train"],
    "preds": ["pop", "train", "test"],
    "aggs": ["interactions"],
}


def sql(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the views it uses (and what those use in turn)."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    parts = [f"{v} AS ({VIEWS[v]})" for v in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, root: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(spark, root)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: rounded doubles, lists as text, timestamps as microseconds."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            col = F.round(col.cast("double"), digits)
        elif isinstance(kind, T.ArrayType):
            element = kind.elementType
            if isinstance(element, (T.FloatType, T.DoubleType)):
                col = F.transform(col, lambda x: F.round(x.cast("double") * 1000).cast("bigint"))
            col = F.concat_ws(",", F.transform(col, lambda x: x.cast("string")))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.unix_micros(col.cast("timestamp"))
        out.append(col.alias(field.name))
    return df.select(*out)
