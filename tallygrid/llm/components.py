"""Connected components of links in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import stored
from tallygrid.operators.spread import attach


def _pointed(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: each node's neighbours (the larger ones, or the smaller ones and
    itself) are linked to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if larger else both.filter("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    found = attach(near, least, ["a"])
    if larger:
        links = found.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        links = found.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    return links.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b): the smallest node ``b`` of its component for every node ``a`` that is linked
    and is not that smallest one. ``links`` has columns a and b of numbers.

    Alternating large and small star steps end in one star a component, after about as
    many rounds as the logarithm of the number of nodes. Every round is a written table.
    """
    edges = stored(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return edges
        before = mark
        edges = stored(_pointed(_pointed(edges, True), False), "links")
