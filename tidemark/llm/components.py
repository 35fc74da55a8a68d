"""Connected components of a graph of any size, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the smallest node that it reaches) for every node of edges (u, v: of one orderable type, any direction).

    Loops and repeated edges change nothing; rows with nulls are left out; no edges give no rows. Each round links every
    node's larger neighbours, then its smaller ones, to the smallest node among its neighbours and itself, and ends in
    a written table. A hub only has its minimum shuffled whole; its edges meet that minimum in an equi-join, which
    Spark may split. A graph whose components don't settle within the rounds is an error.
    """
    e = cut(edges.where("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e1 = large.where("u != v").distinct()
        low = e1.groupBy("u").agg(F.min("v").alias("m"))
        small = e1.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = cut(small.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components haven't settled after {rounds} rounds")
    return e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
