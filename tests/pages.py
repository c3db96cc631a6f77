"""Page builders for tests."""

import json

PAGE_COLUMNS = "url string, html string, s3_key string, http_status int, parser_version string"


def context_script(value, after=";"):
    body = value if isinstance(value, str) else json.dumps(value)
    return f'<script id="__NORDIC_RENDERING_CTX__" nonce="z">_n.ctx.r={body}{after}</script>'


def ld_script(value):
    body = value if isinstance(value, str) else json.dumps(value)
    return f'<script type="application/ld+json">{body}</script>'


def card(key, *components, **metadata):
    return {"id": "POLYCARD", "polycard": {"metadata": {"id": key, **metadata}, "components": list(components)}}


def component(kind, payload):
    return {"type": kind, kind: payload}


def listing(results, nodes=()):
    search = {"results": list(results), "pagination": {"pagination_nodes_url": list(nodes)}}
    return f"<html>{context_script({'appProps': {'sharedState': {'search': search}}})}</html>"


def detail(components, *ld):
    context = {"appProps": {"pageProps": {"initialState": {"components": components}}}}
    return "<html>" + "".join(map(ld_script, ld)) + context_script(context) + "</html>"


def frame(spark, htmls, status=200):
    rows = [(f"https://cars.example.com/list/{i}", h, f"cars/2024-02-03/{i}.html.gz", status, "1.0.0") for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, PAGE_COLUMNS)
