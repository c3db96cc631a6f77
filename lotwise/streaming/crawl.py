"""The frontier as a stream: each url is followed once, across batches and restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .health import use_state_store


def stream_unseen(frontier: DataFrame, visited: DataFrame | None = None) -> DataFrame:
    """url, dont_filter of requests to make, over a stream of (url string[, dont_filter boolean, ...]).

    A url comes out with the first batch that asks for it and never again, unless it is in
    visited (url), a table as it is when a batch begins. Requests with dont_filter set, as
    retries have, all come out, and don't make their url seen. Requests without a url go;
    a null dont_filter is false. Repeated rows are one request, except those past the filter.

    The state is a digest of 32 bytes for each url, dealt by digest, so no url or host makes
    a partition hot; it has no end, as a url counts as seen for good. RocksDB keeps it on
    disk, behind Bloom filters of its files, which is what tells most new urls apart.
    """
    use_state_store(frontier.sparkSession)
    past = F.coalesce(F.col("dont_filter"), F.lit(False)) if "dont_filter" in frontier.columns else F.lit(False)
    asked = frontier.filter("url is not null").select("url", past.alias("dont_filter"))
    fresh = asked.filter(~F.col("dont_filter")).withColumn("_digest", F.unhex(F.sha2("url", 256))).dropDuplicates(["_digest"]).drop("_digest")
    if visited is not None:
        fresh = fresh.join(visited.select("url").filter("url is not null"), "url", "left_anti")
    return fresh.unionByName(asked.filter("dont_filter")) if "dont_filter" in frontier.columns else fresh
