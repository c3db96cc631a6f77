"""The query catalogue: each operator on whole tables, and SQL that should give the same.

Pages are synthesised from relational rows, so SQL can compute what the extractors should
find without reading a page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import embedded as E
from ..functions import predicates as P
from ..functions import urls as U
from ..operators import crawl, detail, health, listing
from ..sinks import outbox
from ..sources import landing, parsed, seeds
from ..streaming import crawl as stream_crawl
from ..streaming import health as stream_health
from ..streaming import listing as stream_listing
from ..streaming import retry as stream_retry
from . import settings, synth
from .lineage import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vehicle(brand: str = "p_brand"):
    offers = F.struct(F.col("p_retailprice").cast(schemas.MONEY).alias("price"), F.lit("ARS").alias("priceCurrency"))
    inner = synth.json_of(sku=F.concat(F.lit("P"), F.col("p_partkey").cast("string")), brand=F.expr(brand), numberOfDoors=F.col("p_size").cast("string"), offers=offers)
    return F.concat(F.lit('{"@type":"Vehicle",'), F.substring(inner, 2, 4000))


def _vehicles(pages: DataFrame) -> DataFrame:
    v = F.from_json(E.json_ld(F.col("html"), "Vehicle"), schemas.VEHICLE, E.STRICT)
    return pages.withColumn("_v", v).select(
        "p_partkey", F.col("_v.sku").alias("sku"), F.col("_v.brand").alias("brand"), F.col("_v.numberOfDoors").alias("doors"),
        F.col("_v.offers.price").cast("double").alias("price"), F.col("_v.offers.priceCurrency").alias("currency"),
    )


_VEHICLE_SQL = """
SELECT p_partkey, 'P' || p_partkey AS sku, {brand} AS brand, CAST(p_size AS VARCHAR) AS doors,
       round(p_retailprice, 2) AS price, 'ARS' AS currency FROM part"""


@query(_VEHICLE_SQL.format(brand="p_brand"))
def jsonld_vehicle(spark, sf_dir):
    return _vehicles(synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.page(synth.ld_scripts(_vehicle()))))


@query(_VEHICLE_SQL.format(brand="p_brand"))
def jsonld_first_of_many(spark, sf_dir):
    other = F.lit('[{"@type":"BreadcrumbList"},{"@type":["Vehicle"],"brand":"list"}]')
    scripts = synth.ld_scripts(F.lit('{"@type":"Vehicle","brand":'), F.lit('"Vehicle"'), other, _vehicle(), _vehicle("'second'"))
    return _vehicles(synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.page(scripts)))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS brand FROM part")
def jsonld_type_absent(spark, sf_dir):
    scripts = synth.ld_scripts(F.lit('{"@type":"BreadcrumbList"}'), F.when(F.col("p_partkey") % 3 != 0, _vehicle()))
    return _vehicles(synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.page(scripts))).select("p_partkey", "brand")


@query("""
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_brand WHEN 1 THEN 'twice' WHEN 4 THEN p_brand END AS brand FROM part""")
def jsonld_strict_block(spark, sf_dir):
    k = F.col("p_partkey") % 5
    v = _vehicle()
    twice = F.lit('{"@type":"Vehicle","brand":"once","brand":"twice"}')
    block = F.when(k == 0, v).when(k == 1, twice).when(k == 2, F.concat(v, F.lit(" trailing"))).when(k == 3, F.concat(v, F.lit(","), v)).otherwise(F.concat(F.lit("\n ["), v, F.lit("] ")))
    return _vehicles(synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.page(synth.ld_scripts(block)))).select("p_partkey", "brand")


@query("SELECT p_partkey, 'P' || p_partkey || '}' AS card_id, p_brand AS brand FROM part")
def ctx_extract(spark, sf_dir):
    metadata = synth.json_of(id=F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit("}")), category_id=F.col("p_brand"))
    pages = synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.search_page(F.concat(F.lit("["), synth.card(metadata), F.lit("]"))))
    results = E.context(F.col("html"), schemas.LISTING_CONTEXT)["appProps"]["sharedState"]["search"]["results"]
    return pages.withColumn("_m", F.get(E.cards(results), 0)["metadata"]).select("p_partkey", F.col("_m.id").alias("card_id"), F.col("_m.category_id").alias("brand"))


@query("""
SELECT o_orderkey, CAST(0 AS INTEGER) AS pos, 'O' || o_orderkey AS card_id FROM orders
UNION ALL
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER),
       'L' || l_linenumber || '-' || l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def cards_unnest(spark, sf_dir):
    line = synth.card(synth.json_of(id=F.concat(F.lit("L"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"))))
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("card")).alias("l"))
    # an order has a few lines
    grouped = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l"))["card"].alias("cards"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey").join(grouped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    top = synth.card(synth.json_of(id=F.concat(F.lit("O"), F.col("o_orderkey").cast("string"))))
    results = F.concat(
        F.lit('[{"id":"OTHER"},'), top, F.lit(',{"id":"GROUP_ITEMS_INTERVENTION","items":['),
        F.concat_ws(",", F.lit('{"id":"OTHER"}'), F.array_join("cards", ",")), F.lit("]}]"),
    )
    pages = synth.raw_pages(orders, "o_orderkey", synth.search_page(F.regexp_replace(results, r",\]", "]")))
    return listing.page_cards(pages).select("o_orderkey", "pos", F.col("card.metadata.id").alias("card_id"))


@query("SELECT p_partkey, p_name AS title, p_brand AS location, CAST(2 AS INTEGER) AS kinds FROM part")
def component_map_last_wins(spark, sf_dir):
    text = lambda c: synth.json_of(text=c)
    card = synth.card(F.lit("{}"), synth.typed("title", text(F.lit("first"))), synth.typed("location", text(F.col("p_brand"))), synth.typed("title", text(F.col("p_name"))))
    pages = synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.search_page(F.concat(F.lit("["), card, F.lit("]"))))
    mapped = listing.page_cards(pages).withColumn("_c", E.component_map(F.col("card.components")))
    of = lambda kind: F.from_json(F.try_element_at("_c", F.lit(kind)), "text string")["text"]
    return mapped.select("p_partkey", of("title").alias("title"), of("location").alias("location"), F.size("_c").alias("kinds"))


@query("SELECT p_partkey FROM part WHERE p_partkey % 5 NOT IN (0, 1, 2)")
def ad_filter_nullsafe(spark, sf_dir):
    k = F.col("p_partkey") % 5
    flag = F.when(k == 0, F.lit('{"is_pad":"true"}')).when(k == 1, F.lit('{"is_pad":"TRUE"}')).when(k == 2, F.lit('{"is_pad":true}')).when(k == 3, F.lit('{"is_pad":"false"}')).otherwise(F.lit("{}"))
    pages = synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.search_page(F.concat(F.lit("["), synth.card(flag), F.lit("]"))))
    return listing.page_cards(pages).filter(~P.is_ad(F.col("card.metadata.is_pad"))).select("p_partkey")


@query("SELECT p_partkey, p_partkey % 8 < 5 AS is_new FROM part")
def zero_km_filter(spark, sf_dir):
    k = F.col("p_partkey") % 8
    texts = ["0 km", "0,00KM", " 0.0 Km ", "0 km", " 0 km ", "10 km", "0 kms"]
    said = F.lit(None).cast("string")
    for i, t in enumerate(texts):
        said = F.when(k == i, F.lit(t)).otherwise(said)
    attributes = F.when(said.isNotNull(), F.array(F.lit("2024"), said))
    return _table(spark, sf_dir, "part").select("p_partkey", P.is_zero_km(attributes).alias("is_new"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN CAST(p_size AS VARCHAR) END AS initial FROM part")
def price_complements_guard(spark, sf_dir):
    k = F.col("p_partkey") % 4
    shapes = F.when(k == 0, synth.json_of(initial_payment_amount=F.col("p_brand"))).when(k == 1, synth.json_of(initial_payment_amount=F.col("p_size")))
    shapes = shapes.when(k == 2, F.lit('[{"initial_payment_amount":"x"}]')).otherwise(F.lit('"initial_payment_amount"'))
    return _table(spark, sf_dir, "part").select("p_partkey", E.guarded(shapes, "initial_payment_amount").alias("initial"))


@query("""
SELECT 'cars' AS source, 'L' || p_partkey AS source_listing_key, 'https://cars.example.com/L' || p_partkey AS url, false AS is_ad,
       p_brand AS category_id, 'CARS' AS domain_id, p_name AS title_raw, round(p_retailprice, 2) AS price_amount,
       CASE WHEN p_partkey % 2 = 0 THEN 'USD' ELSE 'ARS' END AS price_currency, p_size || '/100 Km' AS attributes_raw,
       CASE WHEN p_partkey % 6 <> 0 THEN p_type END AS location_raw,
       CASE WHEN p_partkey % 3 = 0 THEN '10 %' END AS financing_initial_payment,
       'cars/2024-01-01/' || p_brand || '-' || p_size || '-' || (p_partkey // 50000) || '.html.gz' AS s3_key, 200 AS http_status, '1.0.0' AS parser_version
FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0""")
def summary_rows(spark, sf_dir):
    rows = listing.summary_rows(synth.listing_page(_table(spark, sf_dir, "part")), "cars")
    return rows.drop("discovered_at").withColumns({"price_amount": F.col("price_amount").cast("double"), "attributes_raw": F.array_join("attributes_raw", "/")})


def _suppliers(spark, sf_dir) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    # both have a fixed number of rows at any scale; Spark sees their size and broadcasts
    joined = _table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return synth.detail_page(joined)


_SUPPLIER_FROM = "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(f"""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 < 2 THEN s_name END AS seller_name,
       CASE s_suppkey % 3 WHEN 0 THEN 'car_dealer' WHEN 1 THEN 'particular' END AS seller_type {_SUPPLIER_FROM}""")
def seller_resolution(spark, sf_dir):
    components = E.context(F.col("html"), schemas.DETAIL_CONTEXT)["appProps"]["pageProps"]["initialState"]["components"]
    return _suppliers(spark, sf_dir).withColumn("_s", detail.seller(components)).select("s_suppkey", F.col("_s.name").alias("seller_name"), F.col("_s.type").alias("seller_type"))


@query(f"SELECT s_suppkey, r_name || ' > ' || n_name || ' > ' || s_name AS breadcrumb_raw {_SUPPLIER_FROM}")
def breadcrumb(spark, sf_dir):
    return _suppliers(spark, sf_dir).select("s_suppkey", detail.breadcrumb_text(E.json_ld(F.col("html"), "BreadcrumbList")).alias("breadcrumb_raw"))


@query(f"""
SELECT 'cars' AS source, 'S' || s_suppkey AS source_listing_key, 'https://cars.example.com/' || s_suppkey AS url, n_name AS brand_raw,
       CASE WHEN s_suppkey % 2 = 0 THEN 'rojo "vivo"' END AS color, 'Nafta' AS fuel_type_raw, CAST(s_suppkey % 5 AS VARCHAR) AS number_of_doors,
       'Manual' AS transmission_raw, 'used' AS item_condition, round(s_acctbal, 2) AS price_amount, 'ARS' AS price_currency,
       '2024-12-31' AS price_valid_until, r_name || ' > ' || n_name || ' > ' || s_name AS breadcrumb_raw, '2019 | 50 km' AS subtitle_raw,
       CASE WHEN s_suppkey % 4 <> 0 THEN r_name END AS location_raw, '{{"a":1}};b' AS highlighted_specs_raw,
       CASE WHEN s_suppkey % 3 < 2 THEN s_name END AS seller_name,
       CASE s_suppkey % 3 WHEN 0 THEN 'car_dealer' WHEN 1 THEN 'particular' END AS seller_type,
       s_suppkey * 1000 AS seller_id, n_name AS province_raw, 'active' AS item_status, '20 %' AS financing_initial_payment,
       'cars/2024-01-01/' || s_suppkey || '.html.gz' AS s3_key, 200 AS http_status, '1.0.0' AS parser_version {_SUPPLIER_FROM}""")
def detail_rows(spark, sf_dir):
    rows = detail.detail_rows(_suppliers(spark, sf_dir), "cars").drop("fetched_at")
    return rows.withColumns({"price_amount": F.col("price_amount").cast("double"), "highlighted_specs_raw": F.array_join("highlighted_specs_raw", ";")})


@query(SQL["summary_rows"])
def parsed_summary_rows(spark, sf_dir):
    """Summary rows of a table of parsed pages."""
    path = scratch(spark, "parsed")
    parsed.write_parsed(synth.listing_page(_table(spark, sf_dir, "part")), path)
    rows = listing.summary_rows(spark.read.parquet(path), "cars")
    return rows.drop("discovered_at").withColumns({"price_amount": F.col("price_amount").cast("double"), "attributes_raw": F.array_join("attributes_raw", "/")})


@query(SQL["detail_rows"])
def parsed_detail_rows(spark, sf_dir):
    """Detail rows of a table of parsed pages."""
    path = scratch(spark, "parsed")
    parsed.write_parsed(_suppliers(spark, sf_dir), path)
    rows = detail.detail_rows(spark.read.parquet(path), "cars").drop("fetched_at")
    return rows.withColumns({"price_amount": F.col("price_amount").cast("double"), "highlighted_specs_raw": F.array_join("highlighted_specs_raw", ";")})


@query("""
SELECT s_suppkey % 6 AS variant, CASE s_suppkey % 6 WHEN 1 THEN 'no context script' WHEN 2 THEN 'no context mark' WHEN 3 THEN 'context is not JSON'
  WHEN 4 THEN 'proximity row without a label' ELSE 'JSON-LD value is no object' END AS reason, count(*) AS pages
FROM supplier WHERE s_suppkey % 6 <> 0 GROUP BY ALL""")
def quarantine_reasons(spark, sf_dir):
    found = detail.detail_quarantine(_unreadable(spark, sf_dir))
    variant = (F.regexp_extract("url", r"(\d+)$", 1).cast("long") % 6).alias("variant")
    return found.groupBy(variant, "reason").agg(F.count("*").alias("pages"))


def _unreadable(spark, sf_dir) -> DataFrame:
    """A page for each supplier, of which a sixth each can't be read for one of four reasons, or has an odd JSON-LD value."""
    k = F.col("s_suppkey") % 6
    script = lambda body: F.lit(f'<script id="__NORDIC_RENDERING_CTX__">{body}</script>')
    components = '_n.ctx.r={"appProps":{"pageProps":{"initialState":{"components":{"item_proximity":{"content_rows":[%s]}}}}}}'
    good = script(components % '{"label":{"text":"x"}}')
    html = (
        F.when(k == 1, synth.page(synth.ld_scripts(F.lit("{}")))).when(k == 2, synth.page(script("var a={}"))).when(k == 3, synth.page(script("_n.ctx.r={broken")))
        .when(k == 4, synth.page(script(components % '{"icon":"x"}'))).when(k == 5, synth.page(synth.ld_scripts(F.lit("[1]")), good)).otherwise(synth.page(good))
    )
    return synth.raw_pages(_table(spark, sf_dir, "supplier"), "s_suppkey", html)


@query("""
SELECT 'listing' AS kind, unnest(['pages', 'cards', 'adverts']) AS metric,
       unnest([(SELECT count(DISTINCT (p_brand, p_size, p_partkey // 50000)) FROM part), (SELECT count(*) FROM part), (SELECT count(*) FROM part WHERE p_partkey % 5 = 0)]) AS n
UNION ALL
SELECT 'detail', unnest(['pages', 'rejected_no_context_script', 'rejected_no_context_mark', 'rejected_context_is_not_json', 'rejected_proximity_row_without_a_label', 'odd_nodes']),
       unnest([count(*), count(*) FILTER (WHERE s_suppkey % 6 = 1), count(*) FILTER (WHERE s_suppkey % 6 = 2), count(*) FILTER (WHERE s_suppkey % 6 = 3), count(*) FILTER (WHERE s_suppkey % 6 = 4), count(*) FILTER (WHERE s_suppkey % 6 = 5)]) FROM supplier""")
def observed_counts(spark, sf_dir):
    """Counts that come with the rows: of each kind of page one pass writes its rows and counts what it left out."""
    found = []
    for kind, rows, pages in (("listing", listing.summary_rows, synth.listing_page(_table(spark, sf_dir, "part"))), ("detail", detail.detail_rows, _unreadable(spark, sf_dir))):
        counts = Observation(kind)
        rows(pages, "cars", observed=counts).write.parquet(scratch(spark, kind))
        found += [(kind, metric, n) for metric, n in counts.get.items() if n]
    return spark.createDataFrame(found, "kind string, metric string, n long")


def _paged(spark, sf_dir) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    nodes = F.concat(
        F.lit('[{"value":"1","url":"/x","is_actual_page":true},{"value":"2","url":"/next'), key, F.lit('"},"plain",{"value":"3","url":7},{"url":"https://cars.example.com/abs'), key, F.lit('"}]'),
    )
    return synth.raw_pages(_table(spark, sf_dir, "part"), "p_partkey", synth.search_page(F.lit("[]"), nodes))


@query("""
SELECT p_partkey, CAST(c.pos AS INTEGER) AS pos, 'https://cars.example.com/' || CASE c.pos WHEN 1 THEN 'next' ELSE 'abs' END || p_partkey AS link
FROM part CROSS JOIN (VALUES (1), (4)) c(pos)""")
def pagination_links(spark, sf_dir):
    links = listing.pagination_links(_paged(spark, sf_dir))
    return links.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("p_partkey"), "pos", "link")


@query("""
SELECT p_partkey, CAST(c.pos AS INTEGER) AS pos, c.reason FROM part CROSS JOIN (VALUES (2, 'not an object'), (3, 'no string url')) c(pos, reason)""")
def skipped_nodes(spark, sf_dir):
    skipped = listing.skipped_nodes(_paged(spark, sf_dir))
    return skipped.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("p_partkey"), "pos", "reason")


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://' || regexp_replace(url, '^https?://', '') ELSE url END AS url FROM pages""")
def normalize_url(spark, sf_dir):
    bare = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    return _table(spark, sf_dir, "pages").select("page_id", U.normalize_url(bare).alias("url"))


@query("SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' ELSE regexp_extract(url, '://([^/?#]*)', 1) END AS domain FROM pages")
def domain_of(spark, sf_dir):
    url = F.when(F.col("page_id") % 5 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    return _table(spark, sf_dir, "pages").select("page_id", U.domain_of(url).alias("domain"))


@query("""
SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) LIKE '%.example.org' OR regexp_extract(url, '://([^/?#]*)', 1) = 'example.org' AS allowed FROM pages""")
def allowed_domain(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", P.allowed_domain(U.domain_of(F.col("url")), "example.org").alias("allowed"))


@query("""
SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/next/' || page_id AS link FROM pages""")
def resolve_links(spark, sf_dir):
    link = F.concat(F.lit("/next/"), F.col("page_id").cast("string"))
    return _table(spark, sf_dir, "pages").select("page_id", U.resolve_url("url", link).alias("link"))


@query("SELECT event_id, hour(ts - INTERVAL 3 HOUR) BETWEEN 2 AND 6 AS in_window FROM events")
def batch_window(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", P.in_batch_window(F.col("ts")).alias("in_window"))


_DAY = 86_400_000_000
_RATE = {"window_us": 3 * _DAY, "min_samples": 10}


def _events(spark, sf_dir) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), us.alias("us"), (F.col("event_type") == "error").alias("failed"), "event_type")


_RATES_SQL = f"""
rates AS (
  SELECT key, us, failed, count(*) OVER w AS total, CAST(sum(CAST(failed AS INTEGER)) OVER w AS BIGINT) AS fails
  FROM (SELECT DISTINCT user_id AS key, epoch_us(ts) AS us, event_type = 'error' AS failed FROM events)
  WINDOW w AS (PARTITION BY key ORDER BY us RANGE BETWEEN {3 * _DAY - 1} PRECEDING AND CURRENT ROW))"""

_OPENINGS_SQL = f"""
WITH RECURSIVE {_RATES_SQL},
over_it AS (
  SELECT key, us, rate, row_number() OVER (PARTITION BY key ORDER BY us) AS n
  FROM (SELECT DISTINCT key, us, fails / CAST(total AS DOUBLE) AS rate FROM rates WHERE total >= 10 AND fails / CAST(total AS DOUBLE) > 0.3)),
fold(key, us, rate, n, opened, until) AS (
  SELECT key, us, rate, n, true, us + {2 * _DAY} FROM over_it WHERE n = 1
  UNION ALL
  SELECT o.key, o.us, o.rate, o.n, o.us >= f.until, CASE WHEN o.us >= f.until THEN o.us + {2 * _DAY} ELSE f.until END
  FROM over_it o JOIN fold f ON o.key = f.key AND o.n = f.n + 1)
"""


@query(f"WITH {_RATES_SQL} SELECT key, us, failed, total, fails, CASE WHEN total >= 10 THEN round(fails / CAST(total AS DOUBLE), 6) END AS rate FROM rates")
def error_rate_window(spark, sf_dir):
    return health.error_rates(_events(spark, sf_dir), **_RATE).withColumn("rate", F.round("rate", 6))


@query(_OPENINGS_SQL + "SELECT key, us, round(rate, 6) AS rate, until AS open_until_us FROM fold WHERE opened")
def breaker_openings(spark, sf_dir):
    return health.breaker_openings(_events(spark, sf_dir), **_RATE, pause_us=2 * _DAY).withColumn("rate", F.round("rate", 6))


_HOT_RATES_SQL = _RATES_SQL.replace("user_id AS key", "'all' AS key").replace("event_type = 'error'", "event_type IN ('error', 'signup')").replace(str(3 * _DAY - 1), str(_DAY - 1))


@query(f"""
WITH RECURSIVE {_HOT_RATES_SQL},
over_it AS (SELECT DISTINCT key, us, fails / CAST(total AS DOUBLE) AS rate FROM rates WHERE total >= 10 AND fails / CAST(total AS DOUBLE) > 0.3),
leads AS (SELECT a.key, a.us, a.rate, b.us AS next FROM over_it a ASOF LEFT JOIN over_it b ON a.key = b.key AND a.us + {_DAY // 6} <= b.us),
fold(key, us, rate, next) AS (
  SELECT * FROM leads WHERE us = (SELECT min(us) FROM leads)
  UNION ALL
  SELECT l.* FROM leads l JOIN fold f ON l.key = f.key AND l.us = f.next)
SELECT key, us, round(rate, 6) AS rate, us + {_DAY // 6} AS open_until_us FROM fold""")
def hot_breaker_openings(spark, sf_dir):
    """The breaker of one key that all events are of, along pointers."""
    events = _events(spark, sf_dir).select(F.lit("all").alias("key"), "us", F.col("event_type").isin("error", "signup").alias("failed"))
    return health.breaker_openings(events, window_us=_DAY, pause_us=_DAY // 6, fold_points=0).withColumn("rate", F.round("rate", 6))


@query(_OPENINGS_SQL + "SELECT key, us, 'breaker opened for ' || key || ' at rate ' || CAST(round(rate, 4) AS VARCHAR) AS message FROM fold WHERE opened")
def opening_alerts(spark, sf_dir):
    return health.opening_alerts(health.breaker_openings(_events(spark, sf_dir), **_RATE, pause_us=2 * _DAY))


_CLOSED_SQL = f"""
WITH RECURSIVE {_RATES_SQL},
steps AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY us, closes) AS n FROM (
    SELECT DISTINCT key, us, fails / CAST(total AS DOUBLE) AS rate, false AS closes FROM rates WHERE total >= 10 AND fails / CAST(total AS DOUBLE) > 0.3
    UNION ALL SELECT user_id, epoch_us(ts), NULL, true FROM events WHERE event_type = 'signup')),
fold(key, us, rate, n, closes, opened, until) AS (
  SELECT key, us, rate, n, closes, NOT closes, CASE WHEN NOT closes THEN us + {2 * _DAY} END FROM steps WHERE n = 1
  UNION ALL
  SELECT s.key, s.us, s.rate, s.n, s.closes, NOT s.closes AND s.us >= coalesce(f.until, s.us),
         CASE WHEN s.closes THEN least(s.us, f.until) WHEN s.us >= coalesce(f.until, s.us) THEN s.us + {2 * _DAY} ELSE f.until END
  FROM steps s JOIN fold f ON s.key = f.key AND s.n = f.n + 1)
"""


@query(_CLOSED_SQL + f"""
SELECT o.key, o.us, round(o.rate, 6) AS rate, least(o.us + {2 * _DAY}, (SELECT min(c.us) FROM steps c WHERE c.closes AND c.key = o.key AND c.us >= o.us)) AS open_until_us
FROM fold o WHERE o.opened""")
def breaker_closings(spark, sf_dir):
    closes = _table(spark, sf_dir, "events").filter("event_type = 'signup'").select(F.col("user_id").alias("key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return health.breaker_openings(_events(spark, sf_dir), **_RATE, pause_us=2 * _DAY, closes=closes).withColumn("rate", F.round("rate", 6))


@query(_OPENINGS_SQL + """
SELECT r.key, r.us FROM (SELECT user_id AS key, epoch_us(ts) AS us FROM events) r
WHERE NOT EXISTS (SELECT 1 FROM fold f WHERE f.opened AND f.key = r.key AND f.us < r.us AND f.until > r.us)""")
def admitted_requests(spark, sf_dir):
    events = _events(spark, sf_dir)
    return health.admitted(events.select("key", "us"), health.breaker_openings(events, **_RATE, pause_us=2 * _DAY))


@query("""
WITH RECURSIVE asked AS (
  SELECT user_id AS key, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS seq FROM events),
fold(key, us, seq, tokens, wait_s) AS (
  SELECT key, us, seq, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM asked WHERE seq = 1
  UNION ALL
  SELECT key, us, seq, CASE WHEN have >= 1 THEN have - 1 ELSE have END, CASE WHEN have >= 1 THEN 0 ELSE (1 - have) / 0.0001 END
  FROM (SELECT a.key, a.us, a.seq,
               CASE WHEN (a.us - f.us) / 1e6 > 50000 THEN 1.0 ELSE least(CAST(1.0 AS DOUBLE), f.tokens + (a.us - f.us) / 1e6 * 0.0001) END AS have
        FROM asked a JOIN fold f ON a.key = f.key AND a.seq = f.seq + 1))
SELECT key, us, seq, round(wait_s, 6) AS wait_s FROM fold""")
def token_bucket_waits(spark, sf_dir):
    asked = _events(spark, sf_dir).select("key", "us")
    # a wait has whole microseconds, so this many digits leave no tie to rounding
    return health.token_bucket_waits(asked, capacity=1.0, rate=0.0001, idle_s=50000.0).withColumn("wait_s", F.round("wait_s", 6))


@query("SELECT event_id, least(5.0 * power(2.0, event_id % 8), 300.0) AS median_s FROM events")
def backoff_schedule(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", health.backoff_median(F.col("event_id") % 8).alias("median_s"))


def _drawn_sql(key: str, seed: int) -> str:
    u = [f"(CAST('0x' || substr(md5({key} || ':{seed}:{d}'), 1, 12) AS BIGINT) + 1) / {float(1 << 48)!r}" for d in (0, 1)]
    return f"sqrt(-2.0 * ln({u[0]})) * cos(2 * pi() * {u[1]})"


@query(f"SELECT event_id, round(least(5.0 * power(2.0, event_id % 3), 300.0) * exp(0.4 * {_drawn_sql('event_id', 7)}), 6) AS delay_s FROM events")
def backoff_jitter(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", F.round(health.backoff_with_jitter(F.col("event_id") % 3, F.col("event_id"), seed=7), 6).alias("delay_s"))


@query(f"SELECT event_id, round(1.0 * exp(0.4 * {_drawn_sql('event_id', 3)}), 6) AS delay_s FROM events")
def request_jitter(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", F.round(health.lognormal_delay(F.lit(1.0), F.col("event_id"), seed=3), 6).alias("delay_s"))


def _attempts(spark, sf_dir) -> DataFrame:
    k = F.col("event_id")
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 403, 404, 429, 503)]), (k % 5 + 1).cast("int"))
    return _table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), (k % 4).alias("attempt"), status.alias("status"))


_ATTEMPTS_SQL = "(SELECT 'u' || user_id AS url, event_id % 4 AS attempt, [200, 403, 404, 429, 503][event_id % 5 + 1] AS status FROM events)"


@query(f"""
SELECT url, attempt, status, status >= 400 AS gave_up
FROM (SELECT url, attempt, status, row_number() OVER (PARTITION BY url ORDER BY attempt DESC, status DESC) AS n FROM {_ATTEMPTS_SQL}) WHERE n = 1""")
def retry_final(spark, sf_dir):
    return health.final_responses(_attempts(spark, sf_dir))


@query(f"""
SELECT url, attempt, status, status IN (403, 429, 503) AND attempt < 3 AS will_retry,
       CASE WHEN status IN (403, 429, 503) AND attempt < 3 THEN least(5.0 * power(2.0, attempt), 300.0) END AS delay_s FROM {_ATTEMPTS_SQL}""")
def retry_schedule(spark, sf_dir):
    return health.retry_log(_attempts(spark, sf_dir))


def _edges(spark, sf_dir, dont_filter=None) -> DataFrame:
    """Links between as many pages as there are customers, and some more that link nowhere."""
    pages = _table(spark, sf_dir, "customer").count() * 9 // 8
    return _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("url"), F.concat(F.lit("p"), (F.col("o_orderkey") * 31 % pages).cast("string")).alias("link"),
        *([] if dont_filter is None else [dont_filter.alias("dont_filter")]),
    )


_EDGES_SQL = "edges AS (SELECT DISTINCT 'p' || o_custkey AS url, 'p' || (o_orderkey * 31 % (SELECT count(*) * 9 // 8 FROM customer)) AS link FROM orders)"
_SEEDS = ("p1", "p2", "p3")


@query(f"""
WITH RECURSIVE {_EDGES_SQL},
walk(url, depth) AS (
  SELECT 'p1', 1 UNION SELECT 'p2', 1 UNION SELECT 'p3', 1
  UNION
  SELECT link, depth + 1 FROM walk JOIN edges ON walk.url = edges.url WHERE depth < 3)
SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY url""")
def reachable_pages(spark, sf_dir):
    starts = spark.createDataFrame([(u,) for u in _SEEDS], "url string")
    return crawl.reachable(_edges(spark, sf_dir), starts, 3)


@query(f"WITH {_EDGES_SQL} SELECT DISTINCT link AS url FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges v WHERE v.url = e.link)")
def frontier_antijoin(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return crawl.unvisited(edges.select(F.col("link").alias("url")).distinct(), edges.select("url").distinct())


@query("SELECT page_id, url FROM pages p WHERE EXISTS (SELECT 1 FROM pages w WHERE w.url = p.url AND w.url LIKE '%/en/%')")
def detail_candidates(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return crawl.detail_candidates(pages, pages.filter("url LIKE '%/en/%'"))


@query("SELECT 'https://cars.example.com/' || n_name AS url, n_name AS brand, 1 AS depth FROM nation")
def brand_seeds(spark, sf_dir):
    names = [r["n_name"] for r in _table(spark, sf_dir, "nation").collect()]  # a fixed number at any scale
    return seeds.brand_seeds(spark, " , ".join(names) + ", ,", "https://cars.example.com/")


@query("SELECT r_name AS url FROM region UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation")
def url_list(spark, sf_dir):
    path = scratch(spark, "urls")
    region = _table(spark, sf_dir, "region")
    lines = F.explode(F.array(F.concat(F.lit("  "), "r_name"), F.lit(" "), F.col("r_name")))
    region.select(lines.alias("value")).write.text(path)
    names = [r["n_name"] for r in _table(spark, sf_dir, "nation").collect()]
    return seeds.url_list(spark, path, ",".join(names))


def _responses(spark, sf_dir) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id") * 3_600).cast("timestamp_ntz")
    status = F.when(F.col("page_id") % 10 == 0, 404).otherwise(200)
    return pages.select(
        F.concat(F.lit("cars"), (F.col("page_id") % 2).cast("string"), F.lit("_detail")).alias("spider"), "url", "html", status.alias("http_status"), at.alias("fetched_at"), "page_id"
    )


def _landed(spark, sf_dir, parser_version=landing.PARSER_VERSION) -> DataFrame:
    unique = F.lower(F.lpad(F.hex("page_id"), 8, "0"))
    return landing.stamped(_responses(spark, sf_dir), parser_version, unique)


_LANDED_SQL = """
landed AS (
  SELECT page_id, url, html, 'cars' || (page_id % 2) AS source, CASE WHEN page_id % 10 = 0 THEN 404 ELSE 200 END AS http_status,
         TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 HOUR AS seen FROM pages)"""


@query(f"""
WITH {_LANDED_SQL}
SELECT page_id, source, strftime(seen, '%Y-%m-%d') AS dt, http_status, '1.0.0' AS parser_version, length(html) AS html_chars,
       source || '/' || strftime(seen, '%Y-%m-%d/%H%M%S') || '_' || lpad(lower(printf('%x', page_id)), 8, '0') || '.html.gz' AS s3_key FROM landed""")
def landing_roundtrip(spark, sf_dir):
    path = scratch(spark, "landing")
    landing.land(_landed(spark, sf_dir), path)
    return landing.read_landed(spark, path).select(
        "page_id", "source", F.col("dt").cast("string").alias("dt"), "http_status", "parser_version", F.length("html").cast("long").alias("html_chars"), "s3_key"
    )


@query(f"WITH {_LANDED_SQL} SELECT source, strftime(seen, '%Y-%m-%d') AS dt, length(html) AS html_chars FROM landed")
def object_roundtrip(spark, sf_dir):
    path = scratch(spark, "objects")
    landing.export_objects(_landed(spark, sf_dir), path)
    at = lambda i: F.split_part("s3_key", F.lit("/"), F.lit(i))
    return landing.read_objects(spark, path).select(at(1).alias("source"), at(2).alias("dt"), F.length("html").cast("long").alias("html_chars"))


@query(f"""
WITH {_LANDED_SQL}
SELECT page_id, length(html) AS html_chars, md5(html) AS html_md5,
       source || '/' || strftime(seen, '%Y-%m-%d/%H%M%S') || '_' || lpad(lower(printf('%x', page_id)), 8, '0') || '.html.gz' AS s3_key
FROM landed WHERE source = 'cars1'""")
def objects_by_key(spark, sf_dir):
    """Items and the objects that they were read from, by key, for one source."""
    path = scratch(spark, "objects")
    landed = _landed(spark, sf_dir)
    landing.export_objects(landed, path)
    objects = landing.read_objects(spark, path).filter(F.col("s3_key").startswith("cars1/"))
    return landed.select("page_id", "s3_key").join(objects, "s3_key").select("page_id", F.length("html").cast("long").alias("html_chars"), F.md5("html").alias("html_md5"), "s3_key")


@query(f"WITH {_LANDED_SQL} SELECT page_id, length(html) AS html_chars FROM landed WHERE page_id % 3 = 1")
def reprocess_range(spark, sf_dir):
    path = scratch(spark, "versions")
    version = F.concat(F.lit("1."), (F.col("page_id") % 3).cast("string"))
    landed = _landed(spark, sf_dir).withColumn("parser_version", version)
    landing.land(landed, path)
    old = landing.read_landed(spark, path, ["1.1"])
    return crawl.with_raw(landed.select("page_id", "s3_key"), old).select("page_id", F.length("html").cast("long").alias("html_chars"))


@query(f"""
WITH {_LANDED_SQL}
SELECT source, strftime(seen, '%Y-%m-%d') AS dt, CASE WHEN source = 'cars0' THEN '1.1.0' ELSE '1.0.0' END AS page_version, count(*) AS pages,
       CAST(count(*) FILTER (WHERE http_status = 404) AS BIGINT) AS missing, CASE WHEN source = 'cars0' THEN 2 ELSE 1 END AS parses,
       CAST(count(*) FILTER (WHERE html IS NULL) AS BIGINT) AS unread,
       CAST(count(*) FILTER (WHERE html IS NOT NULL AND page_id % 7 = 0) AS BIGINT) AS odd_nodes,
       CAST(coalesce(sum(page_id) FILTER (WHERE html IS NOT NULL), 0) AS BIGINT) AS keys,
       CAST(coalesce(sum(CAST('0x' || substr(md5(url), 1, 8) AS BIGINT)) FILTER (WHERE html IS NOT NULL), 0) AS BIGINT) AS url_digests,
       CAST(coalesce(sum(length(html)), 0) AS BIGINT) AS html_chars,
       CAST(coalesce(sum(CAST('0x' || substr(md5(html), 1, 8) AS BIGINT)), 0) AS BIGINT) AS html_digests
FROM landed GROUP BY ALL""")
def reprocess_in_place(spark, sf_dir):
    """One source's pages are parsed, then the others', then all again, which does nothing; then that source by a new version.

    Each page's whole html is landed in another page's context; all figures but the first
    three are of what the parse found in it, in pages of any status.
    """
    raw, path = scratch(spark, "landing"), scratch(spark, "parsed")
    landed = _landed(spark, sf_dir).withColumn("html", synth.described_html(F.col("html"), F.col("url"), F.col("page_id")))
    first = F.col("source").eqNullSafe("cars0")
    landing.land(landed.filter(first), raw)
    runs = [parsed.refresh(spark, raw, path)]
    landing.land(landed.filter(~first), raw)
    runs += [parsed.refresh(spark, raw, path), parsed.refresh(spark, raw, path)]
    runs.append(parsed.refresh(spark, raw, path, "1.1.0", only=F.col("source") == "cars0"))
    done = runs[0]
    for run in runs[1:]:
        done = done.unionByName(run)
    parses = done.groupBy(F.col("source").alias("_source"), F.col("dt").alias("_dt")).agg(F.count("*").cast("int").alias("parses"))
    html = F.try_variant_get("page_context", "$.appProps.pageProps.initialState.components.description.content", "string")
    url = F.try_variant_get("page_breadcrumb", "$.itemListElement[0].name", "string")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias
    digest = lambda c: F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")
    rows = parsed.read_parsed(spark, path).groupBy("source", "dt", "page_version").agg(
        F.count("*").alias("pages"), F.count_if(F.col("http_status") == 404).alias("missing"),
        F.count_if(F.col("page_unread").isNotNull()).alias("unread"), F.count_if("page_odd_node").alias("odd_nodes"),
        total(F.try_variant_get("page_vehicle", "$.sku", "string").cast("long"))("keys"), total(digest(url))("url_digests"),
        total(F.length(html).cast("long"))("html_chars"), total(digest(html))("html_digests"),
    )
    parsed_as_often = F.col("source").eqNullSafe(F.col("_source")) & F.col("dt").eqNullSafe(F.col("_dt"))
    return rows.join(parses, parsed_as_often).drop("_source", "_dt").withColumn("dt", F.col("dt").cast("string"))


@query("""
SELECT 'listings' AS exchange, 'listing.observed' AS routing_key, p_partkey AS k, p_brand AS brand, true AS has_null_color, 1 AS schema_version
FROM part WHERE p_partkey % 2 = 0""")
def envelope(spark, sf_dir):
    kind = F.when(F.col("p_partkey") % 2 == 0, "detail").otherwise("summary")
    items = _table(spark, sf_dir, "part").select(kind.alias("item_type"), "p_partkey", "p_brand", F.lit(None).cast("string").alias("color"))
    body = F.from_json("body", "p_partkey long, p_brand string, schema_version int")
    return outbox.envelopes(items).withColumn("_b", body).select(
        "exchange", "routing_key", F.col("_b.p_partkey").alias("k"), F.col("_b.p_brand").alias("brand"),
        F.contains("body", F.lit('"color":null')).alias("has_null_color"), F.col("_b.schema_version").alias("schema_version"),
    )


@query("SELECT p_partkey, p_name, round(p_retailprice, 2) AS price FROM part")
def json_lines_roundtrip(spark, sf_dir):
    path = scratch(spark, "lines")
    outbox.write_json_lines(_table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_retailprice").alias("price")), path)
    return spark.read.schema("p_partkey long, p_name string, price double").json(path)


@query(f"SELECT url, attempt, status, status < 400 AS ok FROM {_ATTEMPTS_SQL}")
def success_predicate(spark, sf_dir):
    return _attempts(spark, sf_dir).withColumn("ok", P.is_success(F.col("status")))


@query("""
SELECT p_brand AS brand, CASE p_partkey % 4 WHEN 0 THEN 'sent' WHEN 1 THEN 'unroutable' WHEN 2 THEN 'refused' ELSE 'pending' END AS status, count(*) AS messages
FROM part GROUP BY ALL""")
def outbox_status(spark, sf_dir):
    """Messages with one body each get their own outcome."""
    box = scratch(spark, "outbox")
    part = _table(spark, sf_dir, "part")
    for k, outcome in enumerate((*outbox.OUTCOMES, None)):  # the relay reports on each quarter alike
        items = part.filter(F.col("p_partkey") % 4 == k).select(F.lit("detail").alias("item_type"), "p_brand")
        outbox.append_outbox(outbox.envelopes(items, run=str(outcome)), box)
    found = spark.read.parquet(box)
    reports = found.select("message_id", F.regexp_extract("message_id", "^([a-z]+|None)-", 1).alias("outcome")).filter("outcome <> 'None'")
    brand = F.get_json_object("body", "$.p_brand").alias("brand")
    return outbox.with_outcome(found, reports).groupBy(brand, "status").agg(F.count("*").alias("messages"))


@query(_OPENINGS_SQL.replace("total >= 10", "total >= 12").replace("> 0.3", "> 0.35") + "SELECT key, us, round(rate, 6) AS rate, until AS open_until_us FROM fold WHERE opened")
def session_settings(spark, sf_dir):
    """Breaker openings under the settings of a session."""
    session = spark.newSession()
    for name, value in (("window_us", 3 * _DAY), ("min_samples", 12), ("threshold", 0.35), ("pause_us", 2 * _DAY)):
        session.conf.set(f"lotwise.breaker.{name}", str(value))
    return health.breaker_openings(_events(spark, sf_dir), **settings.breaker_settings(session)).withColumn("rate", F.round("rate", 6))


#: Files that the events are dealt over, in no order of time.
_FILES = 12


def _streamed(spark, sf_dir, columns, operator, ticks: dict, sink=None, schema: str | None = None) -> DataFrame:
    """Rows that a stream gives over the events in many files, each with rows of all times, and a restart.

    Rows wait until their key's last one is known: a file of ticks, one a key, comes after
    the restart. There are no late rows then; if there were, they would be in the result.
    """
    path, out, late, progress = (scratch(spark, x) for x in ("events", "out", "late", "progress"))
    rows = _table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), *columns)
    rows.withColumn("_file", F.pmod(F.xxhash64("key", "us"), F.lit(_FILES))).repartition(_FILES, "_file").drop("_file").write.parquet(path)

    def run():
        stream = operator(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(path))
        writer = stream.writeStream.foreachBatch(stream_health.routed(out, late) if sink is None else sink(out)).option("checkpointLocation", progress)
        stream_health.start_available_now(writer, spark).awaitTermination()
        return stream.drop("late")

    run()
    last = rows.groupBy("key").agg(F.max("us").alias("us")).select("key", (F.col("us") + 2 * _HOLD_US).alias("us"), *[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in ticks.items()])
    last.write.mode("append").parquet(path)
    found = run()
    if sink is not None:
        return spark.read.schema(schema).parquet(f"{out}/batch=*")
    schema = found.schema
    read = lambda p: spark.read.schema(schema).parquet(f"{p}/batch=*")
    return read(out).unionByName(read(late))


_HOLD_US = 10_000 * _DAY


def _stream_openings(spark, sf_dir, closing: bool) -> DataFrame:
    failed, closes = (F.col("event_type") == "error").alias("failed"), F.lit(False).alias("closes")
    if closing:
        # an event that closes is counted too
        both = F.explode(F.when(F.col("event_type") == "signup", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
        closes = both.alias("closes")
    operator = lambda events: stream_health.stream_breaker_openings(events, **_RATE, pause_us=2 * _DAY, hold_us=_HOLD_US)
    found = _streamed(spark, sf_dir, [failed, closes], operator, {"failed": None, "closes": False})
    return found.select("key", "us", F.round("rate", 6).alias("rate"), "open_until_us")


@query(_OPENINGS_SQL + "SELECT CAST(key AS VARCHAR) AS key, us, round(rate, 6) AS rate, until AS open_until_us FROM fold WHERE opened")
def stream_breaker_openings(spark, sf_dir):
    return _stream_openings(spark, sf_dir, closing=False)


@query(_CLOSED_SQL + f"SELECT CAST(key AS VARCHAR) AS key, us, round(rate, 6) AS rate, us + {2 * _DAY} AS open_until_us FROM fold WHERE opened")
def stream_breaker_closings(spark, sf_dir):
    return _stream_openings(spark, sf_dir, closing=True)


@query(SQL["opening_alerts"].replace("SELECT key, us, 'breaker", "SELECT CAST(key AS VARCHAR) AS key, us, 'breaker"))
def stream_alerts(spark, sf_dir):
    operator = lambda events: stream_health.stream_breaker_openings(events, **_RATE, pause_us=2 * _DAY, hold_us=_HOLD_US)
    columns = [(F.col("event_type") == "error").alias("failed"), F.lit(False).alias("closes")]
    return _streamed(spark, sf_dir, columns, operator, {"failed": None, "closes": False}, stream_health.alerted, "key string, us long, message string")


@query("""
SELECT 'u' || user_id AS url, CAST(event_id % 4 + 1 AS INTEGER) AS attempt, epoch_us(ts) + CAST(5000000 * power(2.0, event_id % 4) AS BIGINT) AS due_us
FROM events WHERE [200, 403, 404, 429, 503][event_id % 5 + 1] IN (403, 429, 503) AND event_id % 4 < 3""")
def stream_retries(spark, sf_dir):
    k = F.col("event_id")
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 403, 404, 429, 503)]), (k % 5 + 1).cast("int")).alias("status")
    operator = lambda log: stream_retry.stream_retries(log.withColumnRenamed("key", "url"))
    due = _streamed(spark, sf_dir, [status, (k % 4).cast("int").alias("attempt")], operator, {"status": 200, "attempt": 0}, stream_retry.appended, "url string, attempt int, due_us long")
    return due.select(F.concat(F.lit("u"), "url").alias("url"), "attempt", "due_us")


@query(SQL["token_bucket_waits"].replace("SELECT key, us, seq, round(wait_s, 6)", "SELECT CAST(key AS VARCHAR) AS key, us, round(wait_s, 6)"))
def stream_token_bucket(spark, sf_dir):
    operator = lambda asked: stream_health.stream_token_bucket(asked, capacity=1.0, rate=0.0001, idle_s=50000.0, hold_us=_HOLD_US)
    return _streamed(spark, sf_dir, [F.lit(True).alias("asks")], operator, {"asks": False}).withColumn("wait_s", F.round("wait_s", 6))


@query("""
WITH asked AS (SELECT 'p' || (o_orderkey * 31 % (SELECT count(*) * 9 // 8 FROM customer)) AS url, o_orderkey % 7 = 0 AS dont_filter FROM orders)
SELECT DISTINCT url, false AS dont_filter FROM asked WHERE NOT dont_filter AND url NOT IN (SELECT 'p' || c_custkey FROM customer WHERE c_custkey % 11 = 0)
UNION ALL SELECT url, true FROM asked WHERE dont_filter""")
def stream_frontier(spark, sf_dir):
    """Links in many files, some of them retries, over several batches and a restart."""
    path, out, progress = (scratch(spark, x) for x in ("links", "out", "progress"))
    links = _edges(spark, sf_dir, F.col("o_orderkey") % 7 == 0).drop("url").withColumnRenamed("link", "url")
    visited = _table(spark, sf_dir, "customer").filter("c_custkey % 11 = 0").select(F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("url"))
    dealt = F.pmod(F.xxhash64("url", "dont_filter"), F.lit(_FILES))
    for half in (0, 1):
        # both halves have rows of most urls
        links.filter(F.pmod(F.monotonically_increasing_id(), F.lit(2)) == half).repartition(_FILES // 2, dealt).write.mode("append").parquet(path)
        stream = stream_crawl.stream_unseen(spark.readStream.schema(links.schema).option("maxFilesPerTrigger", 2).parquet(path), visited)
        writer = stream.writeStream.foreachBatch(stream_retry.appended(out)).option("checkpointLocation", progress)
        stream_health.start_available_now(writer, spark).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/batch=*")


@query(f"SELECT 'S' || s_suppkey AS sku, n_name AS brand, 1 AS schema_version {_SUPPLIER_FROM}")
def stream_outbox(spark, sf_dir):
    raw, box = scratch(spark, "landing"), scratch(spark, "outbox")
    pages = _suppliers(spark, sf_dir).select(F.lit("cars_detail").alias("spider"), "url", "html", "http_status", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("fetched_at"))
    landing.land(landing.stamped(pages), raw)
    stream_listing.publish_details(stream_listing.landed_stream(spark, raw), "cars", box, scratch(spark, "progress"), available_now=True).awaitTermination()
    body = F.from_json("body", "source_listing_key string, brand_raw string, schema_version int")
    return spark.read.parquet(box).select(body.alias("b")).select(F.col("b.source_listing_key").alias("sku"), F.col("b.brand_raw").alias("brand"), F.col("b.schema_version").alias("schema_version"))
