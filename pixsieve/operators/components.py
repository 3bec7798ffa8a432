"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixsieve.session import write_table


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Hangs neighbours on the least node of each neighbourhood.

    ``edges`` has a > b. With ``larger_only`` every node sends its larger neighbours to the least one,
    else its smaller neighbours and itself. Neighbourhoods are never gathered: the least node is an
    aggregate, joined back to the edges.
    """
    if larger_only:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        moved = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        return moved.filter("a > b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the least node reachable.

    Every step writes its edges to the shared checkpoint folder, so lineage stays short; it ends when the
    edges are stars and no longer change.
    """
    edges = write_table(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    mark = None
    while True:
        edges = write_table(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"), F.countDistinct("a").alias("nodes")).first()
        if mark == now:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
