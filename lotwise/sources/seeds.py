"""Where a crawl begins: brand lists and URL lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def comma_list(spark: SparkSession, text: str) -> DataFrame:
    """value: the trimmed, non-empty parts of a comma list, in order, repeats kept."""
    parts = F.transform(F.split(F.lit(text or ""), ","), lambda x: F.trim(x))
    return spark.range(1).select(F.explode(F.filter(parts, lambda x: x != "")).alias("value"))


def brand_seeds(spark: SparkSession, brands: str, base_url: str) -> DataFrame:
    """url, brand, depth 1: one listing page for each brand of a comma list."""
    base = base_url.rstrip("/")
    return comma_list(spark, brands).select(F.concat(F.lit(base + "/"), "value").alias("url"), F.col("value").alias("brand"), F.lit(1).alias("depth"))


def url_list(spark: SparkSession, urls_file: str | None = None, urls: str | None = None) -> DataFrame:
    """url: lines of a file, then a comma list; trimmed, blanks dropped, repeats kept.

    Raises ValueError if there are none.
    """
    found = comma_list(spark, urls or "").withColumnRenamed("value", "url")
    if urls_file:
        lines = spark.read.text(urls_file).select(F.trim("value").alias("url")).filter("url != ''")
        found = lines.unionAll(found)
    if found.isEmpty():
        raise ValueError("no urls: give urls_file or urls")
    return found
