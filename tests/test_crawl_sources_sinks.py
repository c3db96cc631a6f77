import datetime
import json

import pytest
from pyspark.sql import functions as F

from lotwise.operators import crawl
from lotwise.sinks import outbox
from lotwise.sources import landing, seeds


def test_reachable(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "c"), ("d", "a"), ("b", None), ("x", "y"), ("a", "b")], "url string, link string")
    starts = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    assert sorted(map(tuple, crawl.reachable(edges, starts, 3).collect())) == [("a", 1), ("b", 2), ("c", 2), ("d", 3)]
    assert sorted(map(tuple, crawl.reachable(edges, starts, 1).collect())) == [("a", 1)]
    assert crawl.reachable(edges, starts.limit(0), 3).count() == 0


def test_frontier_and_candidates(spark):
    urls = spark.createDataFrame([("a",), ("b",), (None,)], "url string")
    assert [r["url"] for r in crawl.unvisited(urls, spark.createDataFrame([("a",), (None,)], "url string")).collect()] == ["b"]
    assert [r["url"] for r in crawl.detail_candidates(urls, urls.filter("url = 'a'")).collect()] == ["a"]


def test_seeds(spark, tmp_path):
    assert [tuple(r) for r in seeds.brand_seeds(spark, " a, b ,,a", "https://x.example/").collect()] == [("https://x.example/a", "a", 1), ("https://x.example/b", "b", 1), ("https://x.example/a", "a", 1)]
    file = tmp_path / "urls.txt"
    file.write_text("http://a\n\n  http://b  \nhttp://a\n")
    assert [r["url"] for r in seeds.url_list(spark, str(file), "http://c, ,http://a").collect()] == ["http://a", "http://b", "http://a", "http://c", "http://a"]
    for empty in ({}, {"urls": " , "}):
        with pytest.raises(ValueError):
            seeds.url_list(spark, **empty)


@pytest.fixture
def landed(spark):
    at = datetime.datetime(2024, 5, 6, 7, 8, 9)
    rows = [("cars_detail", "http://a", "<p>é\nx</p>", 200, at), ("cars_discovery", "http://b", "<p>b</p>", 503, at), ("vans", "http://c", "<p>c</p>", 404, at + datetime.timedelta(days=1))]
    return landing.stamped(spark.createDataFrame(rows, "spider string, url string, html string, http_status int, fetched_at timestamp_ntz"))


def test_landing(spark, landed, tmp_path):
    path = str(tmp_path / "raw")
    landing.land(landed.withColumn("parser_version", F.when(F.col("url") == "http://c", "0.9").otherwise("1.0.0")), path)
    got = {r["url"]: r for r in landing.read_landed(spark, path).collect()}
    assert {u: r["http_status"] for u, r in got.items()} == {"http://a": 200, "http://b": 503, "http://c": 404}
    assert got["http://a"]["html"] == "<p>é\nx</p>" and got["http://a"]["source"] == "cars" and str(got["http://c"]["dt"]) == "2024-05-07"
    import re

    assert re.fullmatch(r"cars/2024-05-06/070809_[0-9a-f]{8}\.html\.gz", landed.first()["s3_key"])
    assert [r["url"] for r in landing.read_landed(spark, path, ["0.9"]).collect()] == ["http://c"]
    plan = landing.read_landed(spark, path).filter("source = 'vans'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_objects(spark, landed, tmp_path):
    path = str(tmp_path / "objects")
    landing.export_objects(landed, path)
    got = landing.read_objects(spark, path).collect()
    assert sorted((r["s3_key"].split("/")[0], r["html"]) for r in got) == [("cars", "<p>b</p>"), ("cars", "<p>é\nx</p>"), ("vans", "<p>c</p>")]
    assert all(r["s3_key"].endswith(".gz") for r in got)


def test_envelopes(spark, tmp_path):
    rows = spark.createDataFrame([("detail", "k1", None, "ñ"), ("summary", "k2", 1, "x")], "item_type string, key string, price int, title string")
    found = outbox.envelopes(rows)
    (r,) = found.collect()
    assert json.loads(r["body"]) == {"key": "k1", "price": None, "title": "ñ", "schema_version": 1}
    assert (r["exchange"], r["routing_key"], r["status"]) == ("listings", "listing.observed", "pending")
    path = str(tmp_path / "outbox")
    outbox.append_outbox(found, path)
    outbox.append_outbox(outbox.envelopes(rows), path)  # the same body again
    ids = [x["message_id"] for x in spark.read.parquet(path).collect()]
    assert len(set(ids)) == 2
    outcomes = spark.createDataFrame([(ids[0], "sent"), (ids[0], "unroutable"), ("no such", "sent")], "message_id string, outcome string")
    status = {x["message_id"]: x["status"] for x in outbox.with_outcome(spark.read.parquet(path), outcomes).collect()}
    assert status == {ids[0]: "unroutable", ids[1]: "pending"}
    outbox.write_json_lines(rows, str(tmp_path / "lines"))
    outbox.write_json_lines(rows, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 2
    outbox.append_alerts(rows.select("key"), str(tmp_path / "alerts"))
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 2
