import os

from lotwise.plans import lineage


def test_scratch_and_delete(spark):
    path = lineage.scratch(spark, "numbers")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    lineage.delete(spark, path)
    assert not os.path.exists(path)


def test_checkpoint_keeps_rows(spark):
    assert lineage.checkpointed(spark.range(10)).count() == 10
