"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.skew import hot_keys, join_spread
from clickloom.session import cut_lineage


def _with_least(links: DataFrame, total: int) -> DataFrame:
    """Links (a, b) with `least`, the smallest b of their a; an a may have any number of links."""
    found = links.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("count"))
    return join_spread(links, found.drop("count"), "a", hot_keys(found, "a", total), "b")


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Each node sends its larger neighbours to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = _with_least(both, 2 * total).where("b > a")
    return known.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """Each node sends itself and its smaller neighbours to the smallest of them."""
    known = _with_least(links, total)
    # The node's own link to the smallest stands in the row of that smallest neighbour.
    sent = F.when(F.col("b") > F.col("least"), F.col("b")).otherwise(F.col("a"))
    return known.select(sent.alias("a"), F.col("least").alias("b")).where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): root is the smallest node reachable; linked nodes only.

    Nodes are integers. Every round is checkpointed to the shared folder; rounds end when the
    links, all of them stars by then, no longer change. Self links and repeated links do no harm.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = cut_lineage(links.where("a > b").distinct())
    seen = None
    while True:
        mark = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        stars = cut_lineage(_large_star(links, mark[0]))
        links = cut_lineage(_small_star(stars, mark[0]))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
