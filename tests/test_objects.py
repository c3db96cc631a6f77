import gzip
import os

import pytest
from pyspark.sql import functions as F

from lotwise.sources import landing

SCHEMA = "s3_key string, html string"


def files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


def test_objects_under_their_keys(spark, tmp_path):
    rows = [(f"cars{i % 2}/2024-01-0{i % 3 + 1}/00000{i}_x.html.gz", f"<p>{i}é\r\n</p>") for i in range(9)] + [("cars0/2024-01-01/empty.html.gz", None)]
    root = str(tmp_path / "store")
    landing.export_objects(spark.createDataFrame(rows[:5], SCHEMA).repartition(2), root)
    landing.export_objects(spark.createDataFrame(rows[5:], SCHEMA).withColumn("other", F.lit(1)).repartition(3), root)
    for key, html in rows:
        with open(f"{root}/{key}", "rb") as f:
            assert gzip.decompress(f.read()).decode() == (html or "")
    want = sorted((k, h or "") for k, h in rows)
    found = landing.read_objects(spark, root)
    assert sorted(map(tuple, found.collect())) == want
    assert sorted(map(tuple, found.filter("s3_key LIKE 'cars1/2024-01-02/%'").collect())) == [r for r in want if r[0].startswith("cars1/2024-01-02/")]
    assert [tuple(r) for r in found.filter(F.col("s3_key") == want[3][0]).collect()] == [want[3]]
    assert found.filter(F.col("s3_key").isin(want[1][0], want[2][0], "none")).count() == 2
    assert found.filter("s3_key = 'a' and s3_key = 'b'").count() == 0


def test_filters_reach_the_reader(spark, tmp_path):
    root = str(tmp_path / "store")
    landing.export_objects(spark.createDataFrame([("a/1", "x"), ("b/1", "y")], SCHEMA).coalesce(1), root)
    os.remove(f"{root}/b/1")  # what isn't wanted isn't fetched
    assert [r["html"] for r in landing.read_objects(spark, root).filter("s3_key LIKE 'a/%'").collect()] == ["x"]


def test_failed_writes_leave_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    assert landing.read_objects(spark, root).count() == 0
    good = spark.range(40).select(F.concat(F.lit("k/"), F.col("id").cast("string")).alias("s3_key"), F.lit("x").alias("html"))
    bad = good.union(spark.createDataFrame([("../out", "x")], SCHEMA)).repartition(4)
    with pytest.raises(Exception, match="not a key"):
        landing.export_objects(bad, root)
    assert files(root) == [] and landing.read_objects(spark, root).count() == 0
