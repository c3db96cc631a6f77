"""Listing pages: summary rows, pagination links, and what could not be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import embedded as E
from ..functions import predicates as P
from ..functions import urls as U
from ..sources.parsed import ADDED, unread


def _opened(pages: DataFrame) -> DataFrame:
    """pages (url, html or what sources.parsed made of it, http_status, ...) that are parsed, with their search block."""
    if "html" not in pages.columns:
        return _opened_parsed(pages)
    context = E.context(F.col("html"), schemas.LISTING_CONTEXT)
    return pages.filter(P.is_parseable(F.col("http_status"))).withColumn("_search", context["appProps"]["sharedState"]["search"])


def _opened_parsed(pages: DataFrame) -> DataFrame:
    here, search = "$.appProps.sharedState.search", _at(T.DataType.fromDDL(schemas.LISTING_CONTEXT), "appProps", "sharedState", "search")
    get = lambda *path: F.try_variant_get("page_context", ".".join([here, *path]), _at(search, *path).simpleString())
    found = F.struct(get("results").alias("results"), F.struct(get("pagination", "pagination_nodes_url").alias("pagination_nodes_url")).alias("pagination"))
    return pages.filter(P.is_parseable(F.col("http_status"))).withColumn("_search", found)


def _at(kind: T.StructType, *path: str) -> T.DataType:
    for name in path:
        kind = kind[name].dataType
    return kind


#: Why a listing page gives no rows.
REASONS = ("no context script", "no context mark", "context is not JSON", "no search block", "result list has an entry that is no object")


def _observed(opened: DataFrame, on: Observation | str, reason: Column) -> DataFrame:
    """Pages and cards counted as they pass, for an observation or a stream's progress under that name."""
    # why nothing was read is looked for only where that is so
    counted = E.computed_once(opened, _unread=F.when(F.col("_search.results").isNull(), reason))
    of_cards = lambda test: F.coalesce(F.sum(F.size(F.filter("_cards", test))), F.lit(0)).alias
    return counted.observe(
        on, F.count("*").alias("pages"), of_cards(lambda c: F.lit(True))("cards"), of_cards(lambda c: P.is_ad(c["metadata"]["is_pad"]))("adverts"),
        of_cards(lambda c: E.untyped_component(c["components"]))("untyped_cards"), *E.count_by_reason(F.col("_unread"), REASONS),
    )


def page_cards(pages: DataFrame, observed: Observation | str | None = None) -> DataFrame:
    """One row per card of each page: the page's columns but what was parsed, pos, card."""
    own = [c for c in pages.columns if c not in ("html", *ADDED)]
    opened = _opened(pages).withColumn("_cards", E.cards(F.col("_search.results")))
    if observed is not None:
        opened = _observed(opened, observed, context_reason(pages))
    # outer, as Spark filters what an inner one explodes beforehand, and parses each page for that once more
    exploded = opened.select(*own, F.posexplode_outer("_cards").alias("pos", "card"))
    return exploded.filter(F.col("pos").isNotNull())


def summary_rows(pages: DataFrame, source: str, now: Column | None = None, observed: Observation | str | None = None) -> DataFrame:
    """Rows of schemas.SUMMARY: one for each card that is neither an advert nor new.

    pages has url, html, s3_key, http_status, parser_version. Adverts go before a card's
    components are read. A card with an untyped component is left out here and listed by
    listing_quarantine(); all other cards of its page stay. One scan, no shuffle. An
    observation (of a stream: a name in its progress) gets counts of the same scan: pages,
    cards, adverts, untyped_cards and pages rejected by each of REASONS.
    """
    now = F.current_timestamp() if now is None else now
    kept = page_cards(pages, observed).filter(~P.is_ad(F.col("card.metadata.is_pad")) & ~E.untyped_component(F.col("card.components")))
    part = lambda kind, ddl: F.from_json(E.component(F.col("card.components"), kind), ddl, E.STRICT)
    read = kept.select(
        "*",
        part("attributes_list", "texts array<string>")["texts"].alias("_texts"),
        part("price", f"current_price struct<value:{schemas.MONEY},currency:string>, price_complements string").alias("_price"),
        part("title", "text string")["text"].alias("_title"),
        part("location", "text string")["text"].alias("_location"),
    ).filter(~P.is_zero_km(F.col("_texts")))
    meta = "card.metadata."
    return read.select(
        F.lit(source).alias("source"),
        F.col(meta + "id").alias("source_listing_key"),
        U.normalize_url(F.col(meta + "url")).alias("url"),
        F.lit(False).alias("is_ad"),
        F.col(meta + "category_id"),
        F.col(meta + "domain_id"),
        F.col("_title").alias("title_raw"),
        F.col("_price.current_price.value").alias("price_amount"),
        F.col("_price.current_price.currency").alias("price_currency"),
        F.col("_texts").alias("attributes_raw"),
        F.col("_location").alias("location_raw"),
        E.guarded(F.col("_price.price_complements"), "initial_payment_amount").alias("financing_initial_payment"),
        now.alias("discovered_at"),
        "s3_key", "http_status", "parser_version",
    )


def pagination_links(pages: DataFrame) -> DataFrame:
    """url, link: followed links of each page, resolved, in the page's order (pos).

    Nodes that are no objects, the current page, and nodes without a string url are
    skipped; skipped_nodes() lists the first and the last kind.
    """
    return _nodes(pages).filter(_followed()).select("url", "pos", U.resolve_url("url", "_node.url").alias("link"))


def skipped_nodes(pages: DataFrame) -> DataFrame:
    """url, pos, node, reason of pagination nodes that can't be followed."""
    reason = F.when(~E.is_object(F.col("node")), "not an object").when(~_current() & ~_has_url(), "no string url")
    return _nodes(pages).withColumn("reason", reason).filter("reason is not null").select("url", "pos", "node", "reason")


def _nodes(pages: DataFrame) -> DataFrame:
    exploded = _opened(pages).select("url", F.posexplode_outer("_search.pagination.pagination_nodes_url").alias("pos", "node")).filter(F.col("pos").isNotNull())
    quoted = F.get_json_object("node", "$.url")
    # from_json also turns numbers and objects into strings; a string's JSON text has quotes
    raw = F.from_json(F.when(E.is_object(F.col("node")), F.col("node")), "map<string,variant>")
    return exploded.withColumn("_node", F.from_json(F.when(E.is_object(F.col("node")), F.col("node")), schemas.PAGE_NODE, E.STRICT)).withColumn(
        "_string_url", F.coalesce(F.schema_of_variant(F.try_element_at(raw, F.lit("url"))) == "STRING", F.lit(False)) & quoted.isNotNull()
    )


def _current() -> Column:
    return F.coalesce(F.col("_node.is_actual_page"), F.lit(False))


def _has_url() -> Column:
    return F.col("_string_url")


def _followed() -> Column:
    return E.is_object(F.col("node")) & ~_current() & _has_url()


def context_reason(pages: DataFrame) -> Column:
    """Why a page of _opened() gives no rows; null if it does."""
    search, here = F.col("_search"), "$.appProps.sharedState.search"
    if "html" in pages.columns:
        html, text = F.col("html"), E.context_text(F.col("html"))
        unreadable = unread(E.has_context_script(html), text, F.when(search.isNotNull() | F.try_parse_json(text).isNotNull(), True))
        there = search.isNotNull()
        listed = F.get_json_object(text, f"{here}.results")
    else:
        unreadable, there = F.col("page_unread"), F.try_variant_get("page_context", here, "variant").isNotNull()
        listed = F.try_variant_get("page_context", f"{here}.results", "string")
    # looked for only where nothing was read
    odd = F.when(search["results"].isNull() & listed.isNotNull(), "result list has an entry that is no object")
    return F.coalesce(unreadable, F.when(~there, "no search block"), odd)


def listing_quarantine(pages: DataFrame) -> DataFrame:
    """Rows of schemas.QUARANTINE: pages and cards that summary_rows() leaves out as unreadable.

    A page whose result list has an entry that is no object gives no cards if it is read
    from html, and is listed; of a parsed page only that entry goes.
    """
    whole = _opened(pages).select("s3_key", "url", context_reason(pages).alias("reason")).filter("reason is not null")
    part = page_cards(pages).filter(E.untyped_component(F.col("card.components"))).select(
        "s3_key", "url", F.concat(F.lit("component without a type in card "), F.col("pos").cast("string")).alias("reason")
    )
    return whole.unionByName(part)
