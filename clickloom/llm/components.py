"""Connected components by alternating star steps, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is its smallest id.

    Large-star hangs the larger neighbours of each node on its smallest one,
    small-star its smaller neighbours; a few rounds leave a forest of stars. A
    hub's rows meet one row in each join, so adaptive execution can split them,
    and minima are pre-aggregated. Loops and repeated links do no harm.
    """
    edges = cut(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = (
            hung.filter("v <> m")
            .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
        )
        edges = cut(small.distinct())
        parents = edges.select(F.col("v").alias("u")).distinct()
        if edges.join(parents, "u", "left_semi").isEmpty():
            break
    roots = edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
