"""Detail pages: one wide row from JSON-LD and the rendering context of the same page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import embedded as E
from ..functions import predicates as P
from ..sources.parsed import unread

# Fixed value: how a private seller is called.
PRIVATE = "particular"


def breadcrumb_text(node: Column) -> Column:
    """The text of a breadcrumb's JSON."""
    return crumbs_text(F.from_json(node, schemas.BREADCRUMB, E.STRICT)["itemListElement"])


def crumbs_text(items: Column) -> Column:
    """Names in order of position (none: 0; ties: as listed), joined; null without names."""
    sortable = F.transform(
        F.filter(items, lambda e: e.isNotNull()),
        lambda e, i: F.struct(
            F.coalesce(e["position"].try_cast("double"), F.lit(0.0)).alias("position"), i.alias("i"),
            F.coalesce(F.nullif(e["name"], F.lit("")), e["item"]["name"]).alias("name"),
        ),
    )
    names = F.filter(F.transform(F.array_sort(sortable), lambda e: e["name"]), lambda n: n.isNotNull() & (n != ""))
    return F.nullif(F.array_join(names, " > "), F.lit(""))


def seller(components: Column) -> Column:
    """struct<name, type>: the dealer card if it says anything, else the private one."""
    dealer, private = components["seller_card_motors"], components["seller_profile"]
    is_dealer, is_private = E.truthy(dealer), E.truthy(private)
    card = F.from_json(F.when(is_dealer, dealer).when(is_private, private), schemas.DEALER_CARD, E.STRICT)
    kind = F.when(is_dealer, card["phone_link"]["track"]["melidata_event"]["event_data"]["item_seller_type"]).when(is_private, F.lit(PRIVATE))
    return F.struct(card["seller_name"]["title"]["text"].alias("name"), kind.alias("type"))


def _read(pages: DataFrame) -> DataFrame:
    """Pages with what their scripts hold; each script is found, and each JSON parsed, once, or read of parsed pages."""
    pages = pages.filter(P.is_parseable(F.col("http_status")))
    if "html" not in pages.columns:
        return _read_parsed(pages)
    html, nodes, context = F.col("html"), F.col("_nodes"), F.col("_context")
    found = E.computed_once(pages, _text=E.context_text(html), _nodes=E.typed_nodes(html))
    once = E.computed_once(
        found,
        _script=F.col("_text").isNotNull() | E.has_context_script(html),
        _context=F.from_json("_text", schemas.DETAIL_CONTEXT, E.STRICT),
        _vehicle=F.from_json(E.first_of_type(nodes, "Vehicle"), schemas.VEHICLE, E.STRICT),
        _crumbs=F.from_json(E.first_of_type(nodes, "BreadcrumbList"), schemas.BREADCRUMB, E.STRICT)["itemListElement"],
        _odd_node=F.exists(nodes, lambda n: ~E.is_object(n["json"])),
    )
    value = F.when(context.isNotNull() & (context["appProps"].isNotNull() | F.try_parse_json("_text").isNotNull()), True)
    return once.withColumns({"_unread": unread(F.col("_script"), F.col("_text"), value), "_components": F.col("_context.appProps.pageProps.initialState.components")})


def _read_parsed(pages: DataFrame) -> DataFrame:
    """The same of parsed pages (sources.parsed), by paths that reach the scan."""
    here = "$.appProps.pageProps.initialState.components"

    def gets(column: str, path: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            return F.struct(*[gets(column, f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind.fields])
        return F.try_variant_get(column, path, kind.simpleString())

    fields = lambda ddl: T.DataType.fromDDL(ddl)
    components = fields(schemas.DETAIL_CONTEXT)["appProps"].dataType["pageProps"].dataType["initialState"].dataType["components"].dataType
    crumbs = fields(schemas.BREADCRUMB)["itemListElement"].dataType
    return pages.withColumns({
        "_unread": F.col("page_unread"), "_odd_node": F.col("page_odd_node"),
        "_components": gets("page_context", here, components),
        "_vehicle": gets("page_vehicle", "$", fields(schemas.VEHICLE)),
        "_crumbs": gets("page_breadcrumb", "$.itemListElement", crumbs),
    })


def _rows_without_label() -> Column:
    rows = F.col("_components.item_proximity.content_rows")
    return (F.size(rows) > 0) & F.get(rows, 0)["label"]["text"].isNull()


def _reason() -> Column:
    return F.coalesce("_unread", F.when(F.coalesce(_rows_without_label(), F.lit(False)), "proximity row without a label"))


#: Why a detail page gives no row.
REASONS = ("no context script", "no context mark", "context is not JSON", "proximity row without a label")


def _odd_position() -> Column:
    return F.exists("_crumbs", lambda e: e["position"].isNotNull() & e["position"].try_cast("double").isNull())


def _observed(read: DataFrame, on: Observation | str) -> DataFrame:
    sure = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    counts = [F.count("*").alias("pages"), sure(F.col("_odd_node")).alias("odd_nodes"), sure(_odd_position()).alias("odd_positions")]
    return read.observe(on, *counts, *E.count_by_reason(_reason(), REASONS))


def detail_rows(pages: DataFrame, source: str, now: Column | None = None, observed: Observation | str | None = None) -> DataFrame:
    """Rows of schemas.DETAIL, one for each page that can be read; no shuffle.

    pages has url, html, s3_key, http_status, parser_version, or what sources.parsed made of
    html; values are then cast where they have another type. A page without JSON-LD or
    without some component has nulls there; pages without a context are left out and
    listed by detail_quarantine(). An observation (of a stream: a name in its progress) gets
    counts of the same scan: pages, odd_nodes, odd_positions and pages rejected by each of REASONS.
    """
    now = F.current_timestamp() if now is None else now
    read = _read(pages) if observed is None else _observed(_read(pages), observed)
    read = read.filter(_reason().isNull()).withColumn("_seller", seller(F.col("_components")))
    tracked = "_components.track.melidata_event.event_data."
    return read.select(
        F.lit(source).alias("source"),
        F.col("_vehicle.sku").alias("source_listing_key"),
        "url",
        F.col("_vehicle.brand").alias("brand_raw"),
        F.col("_vehicle.color").alias("color"),
        F.col("_vehicle.fuelType").alias("fuel_type_raw"),
        F.col("_vehicle.numberOfDoors").alias("number_of_doors"),
        F.col("_vehicle.vehicleTransmission").alias("transmission_raw"),
        F.col("_vehicle.itemCondition").alias("item_condition"),
        F.col("_vehicle.offers.price").alias("price_amount"),
        F.col("_vehicle.offers.priceCurrency").alias("price_currency"),
        F.col("_vehicle.offers.priceValidUntil").alias("price_valid_until"),
        crumbs_text(F.col("_crumbs")).alias("breadcrumb_raw"),
        F.col("_components.header.subtitle").alias("subtitle_raw"),
        F.get("_components.item_proximity.content_rows", F.lit(0))["label"]["text"].alias("location_raw"),
        F.col("_components.highlighted_specs_attrs.components").alias("highlighted_specs_raw"),
        F.col("_seller.name").alias("seller_name"),
        F.col("_seller.type").alias("seller_type"),
        F.col(tracked + "seller_id").alias("seller_id"),
        F.col(tracked + "state").alias("province_raw"),
        F.col(tracked + "item_status").alias("item_status"),
        F.col("_components.initial_payment_amount.title.text").alias("financing_initial_payment"),
        now.alias("fetched_at"),
        "s3_key", "http_status", "parser_version",
    )


def detail_quarantine(pages: DataFrame) -> DataFrame:
    """Rows of schemas.QUARANTINE: pages that detail_rows() leaves out, and odd JSON-LD.

    A JSON-LD value that is no object is skipped by the reader; its page is listed, and
    so is a page with a breadcrumb position that is no number.
    """
    reasons = F.array(_reason(), F.when(F.col("_odd_node"), "JSON-LD value is no object"), F.when(_odd_position(), "breadcrumb position is no number"))
    return _read(pages).select("s3_key", "url", F.explode_outer(F.array_compact(reasons)).alias("reason")).filter(F.col("reason").isNotNull())
