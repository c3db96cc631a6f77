"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of this machine where it is unset and all runs in one process."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lotwise-")
        sc.setCheckpointDir(found)
    return found


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a query that ends meanwhile go with it, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def listed_by_few_tasks(spark: SparkSession):
    """Tables that are opened meanwhile are listed by four tasks a core, not by one a partition, each of which takes longer to start than to list."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _file_system(spark, path).deleteOnExit(_hadoop_path(spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage, keeping partitions and their order."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
