"""Pages made from relational rows, for queries that run the real extractors on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ld_scripts(*blocks: Column) -> Column:
    """JSON-LD scripts in order; a null block gives none."""
    return F.concat(*[F.coalesce(F.concat(F.lit('<script data-n="1" type="application/ld+json">'), b, F.lit("</script>")), F.lit("")) for b in blocks])


def context_script(json: Column, after: str = ';_n.ctx.r={"late":1};') -> Column:
    """A context script with text before the mark and after the JSON."""
    return F.concat(F.lit('<script id="__NORDIC_RENDERING_CTX__" nonce="a1">var _n={};_n.ctx.r='), json, F.lit(after + "</script>"))


def page(*parts: Column) -> Column:
    return F.concat(F.lit('<html><head><script>var x = "{";</script>'), *parts, F.lit("</head><body><p>text</p></body></html>"))


def raw_pages(rows: DataFrame, key: str, html: Column, status: int = 200) -> DataFrame:
    """rows as landed pages, with their own columns too."""
    return rows.withColumns({
        "url": F.concat(F.lit("https://cars.example.com/"), F.col(key).cast("string")),
        "html": html,
        "s3_key": F.concat(F.lit("cars/2024-01-01/"), F.col(key).cast("string"), F.lit(".html.gz")),
        "http_status": F.lit(status),
        "parser_version": F.lit("1.0.0"),
    })


def search_page(results: Column, pagination: Column | None = None) -> Column:
    """A listing page with this JSON list of results."""
    nodes = F.lit("[]") if pagination is None else pagination
    return page(context_script(F.concat(
        F.lit('{"appProps":{"sharedState":{"search":{"results":'), results, F.lit(',"pagination":{"pagination_nodes_url":'), nodes, F.lit("}}}}}")
    )))


def card(metadata: Column, *components: Column) -> Column:
    """JSON of one card from JSON of its metadata and components; null components are left out."""
    return F.concat(F.lit('{"id":"POLYCARD","polycard":{"metadata":'), metadata, F.lit(',"components":['), F.concat_ws(",", *components), F.lit("]}}"))


def json_of(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def typed(kind: str, payload: Column) -> Column:
    """JSON of a component; null if its payload is."""
    return F.concat(F.lit(f'{{"type":"{kind}","{kind}":'), payload, F.lit("}"))


def listing_page(part: DataFrame) -> DataFrame:
    """One page for each brand, size and range of part keys: its parts as cards, the even ones in a group.

    A range of keys has about 40 parts of a brand and size, so pages don't grow with the table.

    By p_partkey, a fifth are adverts in three spellings, a seventh are new, and price
    complements have three shapes.
    """
    k = F.col("p_partkey")
    flag = F.when(k % 15 == 0, F.lit('"true"')).when(k % 15 == 5, F.lit('"TRUE"')).when(k % 15 == 10, F.lit("true")).when(k % 2 == 0, F.lit('"false"'))
    metadata = F.concat(
        F.lit("{"), F.coalesce(F.concat(F.lit('"is_pad":'), flag, F.lit(",")), F.lit("")),
        F.substring(json_of(
            id=F.concat(F.lit("L"), k.cast("string")),
            url=F.concat(F.when(k % 4 == 0, F.lit("https://")).otherwise(F.lit("")), F.lit("cars.example.com/L"), k.cast("string")),
            category_id=F.col("p_brand"), domain_id=F.lit("CARS"),
        ), 2, 1000),
    )
    attributes = F.to_json(F.struct(F.array(F.col("p_size").cast("string"), F.when(k % 7 == 0, F.lit(" 0,00 Km")).otherwise(F.lit("100 Km"))).alias("texts")))
    extra = F.when(k % 3 == 0, F.lit(',"price_complements":{"initial_payment_amount":"10 %"}')).when(k % 3 == 1, F.lit(',"price_complements":[{"initial_payment_amount":"no"}]')).otherwise(F.lit(""))
    price = F.concat(F.lit('{"current_price":{"value":'), F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit(',"currency":"'), F.when(k % 2 == 0, "USD").otherwise("ARS"), F.lit('"}'), extra, F.lit("}"))
    one = card(
        metadata,
        typed("title", json_of(text=F.lit("old title"))),
        typed("attributes_list", attributes),
        typed("price", price),
        typed("location", F.when(k % 6 != 0, json_of(text=F.col("p_type")))),
        typed("title", json_of(text=F.col("p_name"))),
    )
    cards = part.select("p_brand", "p_size", F.floor(k / 50_000).alias("_range"), "p_partkey", (F.col("p_partkey") % 2 == 0).alias("grouped"), one.alias("card"))
    listed = cards.groupBy("p_brand", "p_size", "_range").agg(
        F.array_sort(F.collect_list(F.when(~F.col("grouped"), F.struct("p_partkey", "card")))).alias("top"),
        F.array_sort(F.collect_list(F.when(F.col("grouped"), F.struct("p_partkey", "card")))).alias("group"),
    )
    results = F.concat(
        F.lit('[{"id":"OTHER","note":"}{"},'), F.concat_ws(",", F.array_join("top.card", ","), F.lit('{"id":"POLYCARD_LIKE"}')),
        F.lit(',{"id":"GROUP_ITEMS_INTERVENTION","items":[{"id":"OTHER"}'),
        F.when(F.size("group") > 0, F.concat(F.lit(","), F.array_join("group.card", ","))).otherwise(F.lit("")), F.lit("]}]"),
    )
    results = F.regexp_replace(results, r"\},,\{", "},{")
    return raw_pages(listed.withColumn("_key", F.concat_ws("-", "p_brand", F.col("p_size").cast("string"), F.col("_range").cast("string"))), "_key", search_page(results))


def described_html(html: Column, url: Column, key: Column) -> Column:
    """A detail page whose context holds another page's whole html, as its description; null without any.

    Its vehicle has the key, its breadcrumb the url, and a seventh by key have an odd JSON-LD value.
    """
    # no text may end its script
    safe = lambda json: F.replace(json, F.lit("</"), F.lit("<\\/"))
    vehicle = safe(F.concat(F.lit('{"@type":"Vehicle",'), F.substring(json_of(sku=key.cast("string")), 2, 4000)))
    crumbs = safe(F.concat(F.lit('{"@type":"BreadcrumbList","itemListElement":['), json_of(position=F.lit(1), name=url), F.lit("]}")))
    components = F.concat(F.lit('{"description":'), json_of(content=html), F.lit("}"))
    context = safe(F.concat(F.lit('{"appProps":{"pageProps":{"initialState":{"components":'), components, F.lit("}}}}")))
    return F.when(html.isNotNull(), page(ld_scripts(F.when(key % 7 == 0, F.lit("7")), crumbs, vehicle), context_script(context)))


def detail_page(supplier: DataFrame) -> DataFrame:
    """One page for each supplier row (with n_name, r_name): a third each of dealer, private and no seller."""
    k = F.col("s_suppkey")
    vehicle = F.concat(
        F.lit('{"@context":"x","@type":"Vehicle",'),
        F.substring(json_of(
            sku=F.concat(F.lit("S"), k.cast("string")), brand=F.col("n_name"), color=F.when(k % 2 == 0, F.lit("rojo \"vivo\"")), fuelType=F.lit("Nafta"),
            numberOfDoors=(k % 5).cast("string"), vehicleTransmission=F.lit("Manual"), itemCondition=F.lit("used"),
            offers=F.struct(F.col("s_acctbal").cast("decimal(18,2)").alias("price"), F.lit("ARS").alias("priceCurrency"), F.lit("2024-12-31").alias("priceValidUntil")),
        ), 2, 4000),
    )
    crumbs = F.concat(
        F.lit('[{"@type":"BreadcrumbList","itemListElement":[{"position":3,"item":{"name":"'), F.col("s_name"), F.lit('"}},{"position":1,"name":"'), F.col("r_name"),
        F.lit('"},{"position":2,"name":"","item":{"name":"'), F.col("n_name"), F.lit('"}},{"position":4}]}]'),
    )
    name = F.concat(F.lit('{"title":{"text":"'), F.col("s_name"), F.lit('"}}'))
    dealer = F.concat(F.lit('"seller_card_motors":{"seller_name":'), name, F.lit(',"phone_link":{"track":{"melidata_event":{"event_data":{"item_seller_type":"car_dealer"}}}}},"seller_profile":{"seller_name":{"title":{"text":"other"}}},'))
    private = F.concat(F.lit('"seller_card_motors":{},"seller_profile":{"seller_name":'), name, F.lit("},"))
    components = F.concat(
        F.lit("{"), F.when(k % 3 == 0, dealer).when(k % 3 == 1, private).otherwise(F.lit("")),
        F.lit('"header":{"subtitle":"2019 | 50 km"},"item_proximity":{"content_rows":'),
        F.when(k % 4 == 0, F.lit("[]")).otherwise(F.concat(F.lit('[{"label":{"text":"'), F.col("r_name"), F.lit('"}},{}]'))),
        F.lit('},"highlighted_specs_attrs":{"components":[{"a":1},"b"]},"initial_payment_amount":{"title":{"text":"20 %"}},"track":{"melidata_event":{"event_data":{"seller_id":'),
        (k * 1000).cast("string"), F.lit(',"state":"'), F.col("n_name"), F.lit('","item_status":"active"}}}}'),
    )
    context = F.concat(F.lit('{"appProps":{"pageProps":{"initialState":{"components":'), components, F.lit("}}}}"))
    return raw_pages(supplier, "s_suppkey", page(ld_scripts(F.lit('{"@type":"Vehicle", broken'), crumbs, vehicle), context_script(context)))
