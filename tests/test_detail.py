import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lotwise import schemas
from lotwise.operators import detail as D

from .pages import detail, frame

NOW = datetime.datetime(2024, 2, 3)
VEHICLE = {"@type": "Vehicle", "sku": "S9", "brand": "B", "color": "Gris", "fuelType": "Diésel", "numberOfDoors": "5", "vehicleTransmission": "Manual", "itemCondition": "used", "offers": {"price": 9900, "priceCurrency": "USD", "priceValidUntil": "2024-03-01"}}
CRUMBS = {"@type": "BreadcrumbList", "itemListElement": [{"position": 2, "item": {"name": "Two"}}, {"name": "Zero"}, {"position": 1, "name": "One"}, {"position": 3, "name": ""}]}
TRACK = {"melidata_event": {"event_data": {"seller_id": 77, "state": "South", "item_status": "active"}}}
NAME = {"seller_name": {"title": {"text": "Who"}}}
DEALER = {**NAME, "phone_link": {"track": {"melidata_event": {"event_data": {"item_seller_type": "car_dealer"}}}}}


def row(spark, *args):
    return D.detail_rows(frame(spark, [detail(*args)]), "cars", F.lit(NOW)).first()


def test_whole_row(spark):
    components = {
        "header": {"subtitle": "2019"}, "item_proximity": {"content_rows": [{"label": {"text": "Here"}}, {}]}, "highlighted_specs_attrs": {"components": [{"k": 1}]},
        "initial_payment_amount": {"title": {"text": "40 %"}}, "seller_card_motors": DEALER, "seller_profile": NAME, "track": TRACK,
    }
    df = D.detail_rows(frame(spark, [detail(components, '{"@type":"Vehicle"', [CRUMBS, VEHICLE], {**VEHICLE, "sku": "second"})]), "cars", F.lit(NOW))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], schemas.DETAIL).schema]
    r = df.first()
    assert (r["source_listing_key"], r["brand_raw"], r["number_of_doors"], r["price_amount"], r["price_valid_until"]) == ("S9", "B", "5", Decimal("9900.00"), "2024-03-01")
    assert (r["breadcrumb_raw"], r["subtitle_raw"], r["location_raw"], r["highlighted_specs_raw"]) == ("Zero > One > Two", "2019", "Here", ['{"k":1}'])
    assert (r["seller_name"], r["seller_type"], r["seller_id"], r["province_raw"], r["item_status"], r["financing_initial_payment"]) == ("Who", "car_dealer", 77, "South", "active", "40 %")


def test_sellers(spark):
    assert tuple(row(spark, {"seller_profile": NAME})[k] for k in ("seller_name", "seller_type")) == ("Who", "particular")
    assert row(spark, {"seller_card_motors": {}, "seller_profile": NAME})["seller_type"] == "particular"
    assert row(spark, {"seller_card_motors": NAME, "seller_profile": NAME})["seller_type"] is None
    assert tuple(row(spark, {})[k] for k in ("seller_name", "seller_type")) == (None, None)


def test_missing_parts_are_null(spark):
    r = row(spark, {"item_proximity": {"content_rows": []}})
    assert r["location_raw"] is None and r["breadcrumb_raw"] is None and r["source_listing_key"] is None and r["url"].endswith("/0")


def test_quarantine(spark):
    odd = {**CRUMBS, "itemListElement": [{"position": "x", "name": "n"}, {"position": None, "name": "m"}]}
    pages = frame(spark, [
        "<html/>", detail({"item_proximity": {"content_rows": [{"icon": 1}]}}), detail({}, [1, VEHICLE]), detail({}, odd), detail({}, VEHICLE),
        '<script id="__NORDIC_RENDERING_CTX__">_n.ctx.r=oops</script>',
    ])
    got = sorted((r["url"][-1], r["reason"]) for r in D.detail_quarantine(pages).collect())
    assert got == [("0", "no context script"), ("1", "proximity row without a label"), ("2", "JSON-LD value is no object"), ("3", "breadcrumb position is no number"), ("5", "context is not JSON")]
    kept = {r["url"][-1]: r for r in D.detail_rows(pages, "cars").collect()}
    assert set(kept) == {"2", "3", "4"} and kept["2"]["source_listing_key"] == "S9" and kept["3"]["breadcrumb_raw"] == "n > m"


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = D.detail_rows(frame(spark, [detail({}, VEHICLE)]), "cars")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_each_script_is_found_and_parsed_once(spark):
    pages = frame(spark, [detail({}, VEHICLE)])
    for df in (D.detail_rows(pages, "cars"), D.detail_quarantine(pages)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("StructField(appProps") == 1 and plan.count("application/ld") == 1 and plan.count("_n\\.ctx\\.r=") == 1, plan
        assert plan.count("StructField(sku") <= 1 and plan.count("StructField(itemListElement") == 1
