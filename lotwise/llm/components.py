"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import attach, materialized


def _star(edges: DataFrame, key: str, total: int) -> DataFrame:
    """edges with _least: the smallest of its key's other ends and the key itself."""
    other = "b" if key == "a" else "a"
    least = edges.groupBy(key).agg(F.least(F.min(other), F.first(key)).alias("_least"), F.count("*").alias("_n"))
    return attach(edges, least, key, "_n", total)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, label for every node of edges (a, b): label is the smallest node it reaches.

    Every round links all neighbours of a node to the smallest of them, first the larger
    ones, then the smaller ones, until nothing changes; the number of edges never grows.
    Hubs are summed before they shuffle and joined by broadcast (shared.attach), so a
    component with most of the nodes is dealt over all tasks. Loops, repeated and
    reversed edges count once. No edges give no rows.
    """
    down = lambda df, x, y: df.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).filter("a != b").distinct()
    edges = materialized(down(edges, "a", "b"))
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        total = 2 * edges.count()
        if not total:
            break
        # large star: a node's larger neighbours go to its smallest one
        large = materialized(down(_star(both, "a", total).filter("b > a"), F.col("b"), F.col("_least")))
        # small star: its smaller neighbours and itself go to the smallest
        star = _star(large, "a", total)
        edges = materialized(
            down(
                star.select(F.col("b").alias("x"), F.col("_least").alias("y")).unionByName(star.select(F.col("a").alias("x"), F.col("_least").alias("y"))),
                F.col("x"), F.col("y"),
            )
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
