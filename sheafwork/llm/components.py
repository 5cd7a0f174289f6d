"""Connected components of a graph given as a frame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``.

    The component is the smallest node that can be reached. Each round hooks every
    node to its smallest neighbour, follows two hooks, and contracts the links, so
    the graph shrinks by a factor each time. Nothing but a count of links reaches the
    driver. Links of a node to itself, repeated links and nulls do no harm.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = written(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    both = links.select("a").union(links.select("b")).distinct()
    members = written(both.select(F.col("a").alias("node"), F.col("a").alias("component")))
    while not links.isEmpty():
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = ends.groupBy("a").agg(F.least("a", F.min("b")).alias("up"))
        onward = hooks.select(F.col("a").alias("up"), F.col("up").alias("top"))
        hooks = written(hooks.join(onward, "up").select(F.col("a").alias("low"), "top"))
        members = written(
            members.join(hooks, members.component == hooks.low, "left").select(
                "node", F.coalesce("top", "component").alias("component")
            )
        )
        tops = hooks.select(F.col("low").alias("b"), F.col("top").alias("top_b"))
        moved = (
            links.join(hooks.withColumnRenamed("low", "a"), "a")
            .join(tops, "b")
            .where("top <> top_b")
        )
        links = written(
            moved.select(
                F.least("top", "top_b").alias("a"), F.greatest("top", "top_b").alias("b")
            ).distinct()
        )
    return members
