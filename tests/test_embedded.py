import pytest
from pyspark.sql import functions as F

from lotwise.functions import embedded as E

from .pages import context_script, ld_script


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("x")).first()["x"]


SCHEMA = "a string, b struct<c:int>"


@pytest.mark.parametrize("body,want", [
    ('{"a":"x","b":{"c":1}};tail()', ("x", (1,))),
    ('{"a":"}{","b":{"c":2}} {"a":"late"}', ("}{", (2,))),  # braces in a string, and a second object
    ('{"a":1,"a":"last"}', ("last", None)),  # of repeated keys the last
    ('{"a":"first"};_n.ctx.r={"a":"second"}', ("first", None)),  # cut at the first mark
    ('{"a":', None),
    ("nothing", None),
])
def test_context(spark, body, want):
    html = f"<p>{context_script(body)}</p>"
    found = one(spark, html, E.context(F.col("html"), SCHEMA))
    if want is None:
        assert found is None or all(v is None for v in found)
    else:
        assert (found["a"], tuple(found["b"]) if found["b"] else None) == want


def test_context_needs_script_and_mark(spark):
    for html in (None, "", "<script id='__NORDIC_RENDERING_CTX__'>_n.ctx.r={}</script>", '<script nonce="1" id="__NORDIC_RENDERING_CTX__">_n.ctx.r={}</script>'):
        assert one(spark, html, E.has_context_script(F.col("html"))) is False
        assert one(spark, html, E.context_text(F.col("html"))) is None
    html = '<script id="__NORDIC_RENDERING_CTX__">var x</script>'
    assert one(spark, html, E.has_context_script(F.col("html"))) is True
    assert one(spark, html, E.context_text(F.col("html"))) is None


@pytest.mark.parametrize("scripts,want", [
    ([{"@type": "Car", "n": 1}, {"@type": "Car", "n": 2}], "1"),
    ([[{"@type": "Other"}, {"@type": "Car", "n": 3}]], "3"),
    (['{"@type":"Car","n":', {"@type": "Car", "n": 4}], "4"),
    (['{"@type":"Car","n":5} x', {"@type": "Car", "n": 6}], "6"),
    (['{"@type":"Car","n":5},{"@type":"Car","n":5}', {"@type": "Car", "n": 7}], "7"),
    ([{"@type": ["Car"], "n": 8}], None),
    (["1", '"Car"', "[[]]", "null", {"@type": "Car", "n": 9}], "9"),
    (["{'@type':'Car','n':1}"], None),
    ([], None),
])
def test_json_ld(spark, scripts, want):
    html = "".join(map(ld_script, scripts))
    assert one(spark, html, E.guarded(E.json_ld(F.col("html"), "Car"), "n")) == want


def test_component_map(spark):
    components = [{"type": "a", "a": "1"}, {"type": "b", "b": "2"}, {"type": "a", "a": "3"}, {"type": "c"}]
    df = spark.createDataFrame([(components,)], "c array<map<string,string>>")
    row = df.select(E.component_map(F.col("c")).alias("m"), E.component(F.col("c"), "a").alias("a"), E.component(F.col("c"), "z").alias("z"), E.untyped_component(F.col("c")).alias("u")).first()
    assert (row["m"], row["a"], row["z"], row["u"]) == ({"a": "3", "b": "2", "c": None}, "3", None, False)
    df = spark.createDataFrame([([{"x": "1"}],), (None,)], "c array<map<string,string>>")
    assert [r[0] for r in df.select(E.untyped_component(F.col("c"))).collect()] == [True, False]


def test_truthy(spark):
    for text, want in ((None, False), ("{}", False), ("{ }", False), ("null", False), ('{"a":{}}', True), ("[]", False), ("1", True)):
        assert one(spark, text, E.truthy(F.col("html"))) is want
