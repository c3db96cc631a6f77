"""The crawl graph: bounded traversal, what is not yet visited, and what to fetch in detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import checkpointed


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """url, depth: pages reached from seeds (url) along edges (url, link), seeds at depth 1.

    depth is the shortest, so it doesn't depend on the order of arrival. A page at
    max_depth is reached but not followed. Each level joins only the pages that the level
    before found, and is checkpointed, so the plan doesn't grow with depth.
    """
    seen = checkpointed(seeds.select("url").filter("url is not null").distinct().withColumn("depth", F.lit(1)))
    # cut once, dealt by url, so that a level shuffles only the pages before it
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = checkpointed(edges.select("url", "link").filter("url is not null and link is not null").repartition(n, "url").distinct())
    for depth in range(2, max_depth + 1):
        front = seen.filter(F.col("depth") == depth - 1).select("url")
        found = links.join(front, "url", "left_semi").select(F.col("link").alias("url")).distinct()
        new = checkpointed(found.join(seen, "url", "left_anti").withColumn("depth", F.lit(depth)))
        if new.isEmpty():
            break
        seen = seen.unionByName(new)
    return seen


def unvisited(frontier: DataFrame, visited: DataFrame) -> DataFrame:
    """Frontier rows whose url was not seen before; a null url is dropped."""
    return frontier.filter("url is not null").join(visited.select("url"), "url", "left_anti")


def detail_candidates(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pages whose url is among those that discovery found."""
    return pages.join(wanted.select("url"), "url", "left_semi")


def with_raw(items: DataFrame, raw: DataFrame) -> DataFrame:
    """Items with the raw object they came from, for another parse."""
    return items.join(raw.select("s3_key", "html"), "s3_key")
