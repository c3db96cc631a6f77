"""The raw landing zone: pages are landed before they are parsed, and read again later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import lineage
from .objects import KeyedObjects

#: Version of the parsers, stamped on every landed page.
PARSER_VERSION = "1.0.0"


def source_of(spider: Column) -> Column:
    """A source is its crawler's name up to the first underscore."""
    return F.split(spider, "_")[0]


def object_key(source: Column, fetched_at: Column, extension: str = "html", unique: Column | None = None) -> Column:
    """source/YYYY-MM-DD/HHMMSS_xxxxxxxx.ext.gz, in UTC (fetched_at is timestamp_ntz or in a UTC session)."""
    unique = F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 8) if unique is None else unique
    return F.concat(source, F.lit("/"), F.date_format(fetched_at, "yyyy-MM-dd/HHmmss"), F.lit("_"), unique, F.lit(f".{extension}.gz"))


def stamped(responses: DataFrame, parser_version: str = PARSER_VERSION, unique: Column | None = None) -> DataFrame:
    """Final responses of any status (spider, url, html, http_status, fetched_at) with their lineage."""
    return responses.withColumn("source", source_of(F.col("spider"))).withColumns({
        "s3_key": object_key(F.col("source"), F.col("fetched_at"), unique=unique),
        "parser_version": F.lit(parser_version),
    })


def land(pages: DataFrame, path: str) -> None:
    """Write stamped pages as a table, partitioned by source and day.

    Pages share files of a good size: at large scale one object a page is more names
    than a store or a reader can bear.
    """
    pages.withColumn("dt", F.to_date("fetched_at")).write.mode("append").partitionBy("source", "dt").option("compression", "zstd").parquet(path)


def read_landed(spark: SparkSession, path: str, parser_versions: list[str] | None = None) -> DataFrame:
    """Landed pages, for a parse; only those of some parser versions, for a new one."""
    with lineage.listed_by_few_tasks(spark):
        pages = spark.read.parquet(path)
    return pages if parser_versions is None else pages.filter(F.col("parser_version").isin(parser_versions))


def export_objects(pages: DataFrame, path: str) -> None:
    """Write each page (s3_key, html) as a gzip object under its key, for other readers."""
    pages.sparkSession.dataSource.register(KeyedObjects)
    pages.select("s3_key", "html").write.format("keyed_objects").option("path", path).mode("append").save()


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """s3_key, html of objects that were written whole; filters on s3_key reach the reader."""
    spark.dataSource.register(KeyedObjects)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("keyed_objects").option("path", path).load()
