"""JSON embedded in pages: the rendering context, JSON-LD nodes, cards and components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Markup and names that the pages use.
CONTEXT_SCRIPT = r'(?s)<script id="__NORDIC_RENDERING_CTX__"[^>]*>(.*?)</script>'
CONTEXT_MARK = r"_n\.ctx\.r="
JSON_LD_SCRIPT = r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
CARD_ID = "POLYCARD"
GROUP_ID = "GROUP_ITEMS_INTERVENTION"

#: JSON as the standard has it.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}


def context_text(html: Column) -> Column:
    """What follows the first mark in the first context script; null without either.

    It begins with a JSON object; text may come after it, which JSON readers here ignore.
    """
    return F.get(F.split(F.regexp_extract(html, CONTEXT_SCRIPT, 1), CONTEXT_MARK, 2), 1)


def has_context_script(html: Column) -> Column:
    return F.coalesce(html.rlike(CONTEXT_SCRIPT), F.lit(False))


def context(html: Column, schema: str) -> Column:
    """The page's rendering context as far as the schema names it; null if it can't be read.

    The JSON parser knows string literals, so a brace in a string does no harm. Of
    repeated keys the last counts.
    """
    return F.from_json(context_text(html), schema, STRICT)


def json_ld_nodes(html: Column) -> Column:
    """array<string>: the JSON text of all JSON-LD nodes in document order.

    A script must be one valid JSON value as a whole, else it is skipped; a list gives
    its elements.
    """

    def of_script(script: Column) -> Column:
        # in brackets, text after the value makes the whole invalid, and a comma a second element
        value = F.from_json(F.concat(F.lit("["), script, F.lit("]")), "array<string>", STRICT)
        only = F.when(F.size(value) == 1, F.get(value, 0))
        is_list = F.ltrim(only).startswith("[")
        return F.coalesce(F.when(is_list, F.from_json(only, "array<string>", STRICT)), F.array(only))

    nodes = F.flatten(F.transform(F.regexp_extract_all(html, F.lit(JSON_LD_SCRIPT), F.lit(1)), of_script))
    return F.filter(nodes, lambda n: n.isNotNull())


def is_object(json: Column) -> Column:
    return F.coalesce(F.ltrim(json).startswith("{"), F.lit(False))


def typed_nodes(html: Column) -> Column:
    """array<struct<json, type>>: the JSON-LD nodes with their @type; null for what is no object."""
    kind = T.StructType([T.StructField("@type", T.StringType())])
    typed = lambda n: F.struct(n.alias("json"), F.from_json(F.when(is_object(n), n), kind, STRICT)["@type"].alias("type"))
    return F.transform(json_ld_nodes(html), typed)


def first_of_type(nodes: Column, type_name: str) -> Column:
    """JSON text of the first of typed_nodes() whose @type is that name; a list of types is no match."""
    return F.get(F.filter(nodes, lambda n: F.coalesce(n["type"] == type_name, F.lit(False))), 0)["json"]


def json_ld(html: Column, type_name: str) -> Column:
    """JSON text of the page's first node whose @type is that name."""
    return first_of_type(typed_nodes(html), type_name)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that filters and projections over them don't compute anew.

    Spark puts a projection's expressions again into each filter over it; what a generator
    gives it takes as it is.
    """
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def cards(results: Column) -> Column:
    """The cards of a result list and of its groups, in order; other entries are skipped."""

    def of_entry(r: Column) -> Column:
        none = F.slice(F.array(r["polycard"]), 1, 0)  # empty, of the cards' type
        grouped = F.transform(F.filter(r["items"], lambda i: i["id"] == CARD_ID), lambda i: i["polycard"])
        return F.when(r["id"] == CARD_ID, F.array(r["polycard"])).when(r["id"] == GROUP_ID, F.coalesce(grouped, none)).otherwise(none)

    return F.filter(F.flatten(F.transform(results, of_entry)), lambda c: c.isNotNull())


def component(components: Column, kind: str) -> Column:
    """JSON text of the payload of the last component of that type."""
    last = F.try_element_at(F.filter(components, lambda c: c["type"] == kind), F.lit(-1))
    return last[kind]


def component_map(components: Column) -> Column:
    """map<type, JSON text of the payload>; of one type the last component counts."""
    kinds = F.filter(F.array_distinct(F.transform(components, lambda c: c["type"])), lambda k: k.isNotNull())

    def payload(kind: Column) -> Column:
        return F.try_element_at(F.try_element_at(F.filter(components, lambda c: c["type"] == kind), F.lit(-1)), kind)

    return F.map_from_arrays(kinds, F.transform(kinds, payload))


def untyped_component(components: Column) -> Column:
    """Whether some component has no type."""
    return F.coalesce(F.exists(components, lambda c: c["type"].isNull()), F.lit(False))


def guarded(json: Column, field: str) -> Column:
    """A field of a JSON value if that is an object, else null; other shapes do no harm."""
    return F.from_json(F.when(is_object(json), json), T.StructType([T.StructField(field, T.StringType())]), STRICT)[field]


def truthy(json: Column) -> Column:
    """Whether a JSON text is there and not empty, zero, false or null."""
    bare = F.regexp_replace(json, r"\s", "")
    return F.coalesce(~bare.isin("", "{}", "[]", "null", "false", "0", '""'), F.lit(False))


def count_by_reason(reason: Column, reasons: tuple[str, ...]) -> list[Column]:
    """One count for each of the reasons, named rejected_ and its words."""
    return [F.count_if(F.coalesce(reason == r, F.lit(False))).alias("rejected_" + r.lower().replace("-", "_").replace(" ", "_")) for r in reasons]
