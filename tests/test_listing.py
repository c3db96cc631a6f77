import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lotwise import schemas
from lotwise.operators import listing as L

from .pages import card, component, frame, listing

NOW = datetime.datetime(2024, 2, 3)


def rows(spark, *results, **k):
    return L.summary_rows(frame(spark, [listing(results)], **k), "cars", F.lit(NOW)).collect()


def test_schema_and_fields(spark):
    full = card(
        "K1", component("title", {"text": "old"}), component("title", {"text": "Some car"}),
        component("price", {"current_price": {"value": 12500, "currency": "USD"}, "price_complements": {"initial_payment_amount": "30 %"}}),
        component("attributes_list", {"texts": ["2018", "70 Km"]}), component("location", {"text": "North"}),
        url="cars.example.com/K1", is_pad="false", category_id="C", domain_id="D",
    )
    df = L.summary_rows(frame(spark, [listing([full])]), "cars", F.lit(NOW))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], schemas.SUMMARY).schema]
    (r,) = df.collect()
    assert (r["source_listing_key"], r["url"], r["is_ad"], r["title_raw"], r["price_amount"], r["price_currency"]) == ("K1", "https://cars.example.com/K1", False, "Some car", Decimal("12500.00"), "USD")
    assert (r["attributes_raw"], r["location_raw"], r["financing_initial_payment"], r["s3_key"]) == (["2018", "70 Km"], "North", "30 %", "cars/2024-02-03/0.html.gz")


def test_groups_adverts_and_new_ones(spark):
    new = component("attributes_list", {"texts": [" 0,00\xa0KM "]})
    got = rows(
        spark, card("a"), {"id": "OTHER", "polycard": card("x")["polycard"]}, card("ad", is_pad="true"), card("ad2", is_pad=True),
        {"id": "GROUP_ITEMS_INTERVENTION", "items": [card("b"), {"id": "Z"}, card("n", new)]}, card("c", is_pad=None), {"id": "GROUP_ITEMS_INTERVENTION"},
    )
    assert [r["source_listing_key"] for r in got] == ["a", "b", "c"]
    assert all(r["price_amount"] is None and r["url"] is None for r in got)


def test_shapes_that_vary(spark):
    price = lambda c: component("price", {"current_price": {"value": 1.5, "currency": "ARS"}, "price_complements": c})
    got = rows(spark, card("l", price([{"initial_payment_amount": "no"}])), card("s", price("text")), card("n", price(None)), card("o", price({"initial_payment_amount": 5})))
    assert [(r["price_amount"], r["financing_initial_payment"]) for r in got] == [(Decimal("1.50"), None)] * 3 + [(Decimal("1.50"), "5")]


def test_one_bad_card_leaves_the_others(spark):
    bad = {"id": "POLYCARD", "polycard": {"metadata": {"id": "bad"}, "components": [{"x": 1}]}}
    pages = frame(spark, [listing([card("a"), bad, card("b")], [{"url": "/2"}])])
    assert [r["source_listing_key"] for r in L.summary_rows(pages, "cars").collect()] == ["a", "b"]
    assert [r["link"] for r in L.pagination_links(pages).collect()] == ["https://cars.example.com/2"]
    assert [r["reason"] for r in L.listing_quarantine(pages).collect()] == ["component without a type in card 1"]


def test_pagination(spark):
    nodes = [{"value": "1", "url": "https://cars.example.com/1", "is_actual_page": True}, {"value": "2", "url": "2?x=1"}, "https://old.example", None, {"value": "3"}, {"url": 4}, {"url": "//b.example/5", "is_actual_page": False}]
    pages = frame(spark, [listing([], nodes)])
    assert [(r["pos"], r["link"]) for r in L.pagination_links(pages).collect()] == [(1, "https://cars.example.com/list/2?x=1"), (6, "https://b.example/5")]
    assert [(r["pos"], r["reason"]) for r in L.skipped_nodes(pages).collect()] == [(2, "not an object"), (3, "not an object"), (4, "no string url"), (5, "no string url")]


def test_pages_that_cannot_be_read(spark):
    pages = frame(spark, ["<html/>", '<script id="__NORDIC_RENDERING_CTX__">x</script>', '<script id="__NORDIC_RENDERING_CTX__">_n.ctx.r={"a</script>', '<script id="__NORDIC_RENDERING_CTX__">_n.ctx.r={"appProps":{}}</script>', None])
    assert L.summary_rows(pages, "cars").count() == 0
    got = sorted((r["url"][-1], r["reason"]) for r in L.listing_quarantine(pages).collect())
    assert got == [("0", "no context script"), ("1", "no context mark"), ("2", "context is not JSON"), ("3", "no search block"), ("4", "no context script")]
    assert rows(spark, card("a"), status=404) == []


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = L.summary_rows(frame(spark, [listing([card("a")])]), "cars")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_each_page_is_parsed_once(spark):
    pages = frame(spark, [listing([])])
    for df in (L.page_cards(pages), L.summary_rows(pages, "cars"), L.pagination_links(pages), L.skipped_nodes(pages)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("__NORDIC") == 1


def test_pagination_has_no_shuffle_and_no_python(spark):
    plan = L.pagination_links(frame(spark, [listing([], [{"url": "../n"}])]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
