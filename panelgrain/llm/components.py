"""Connected components of links between ids, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrain.llm.shared import written


def _star(links: DataFrame, lesser: bool) -> DataFrame:
    """One star step: the neighbours of a node move to its smallest neighbour."""
    if lesser:
        sides = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        sides = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = sides.join(least, "a")
    if lesser:
        # The node itself and its smaller neighbours; those were links to it.
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    else:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest id each linked node reaches; nodes without links are left out.

    Large-star and small-star steps take turns until the links no longer change, which takes about
    the logarithm of a component's size. Minima are combined before the shuffle and joined back, so a
    node with very many links is split by adaptive joins. Each turn is written to the shared folder.
    """
    now = written(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b").distinct(), "links")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).groupBy("node").agg(F.min("component").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = seen
        now = written(_star(_star(now, False), True), "links")
