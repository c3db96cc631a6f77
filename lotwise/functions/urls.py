"""URLs: scheme, domain, and links relative to a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_url(url: Column) -> Column:
    """With https:// before it unless it has a scheme; null and empty stay as they are."""
    has = F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))
    return F.when(url.isNull() | (url == "") | has, url).otherwise(F.concat(F.lit("https://"), url))


def domain_of(url: Column) -> Column:
    """The authority, user info and port included; empty without a scheme."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


# Scheme, authority, path, parameters of its last segment, query and fragment of a URL without newlines.
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?((?:[^?#]*/)?[^/;?#]*)(?:;([^/?#]*))?(?:\?([^#]*))?(?:#(.*))?\z"
_BRACKETED = r"^[^\[\]]*\[(?:[0-9A-Fa-f:.]+|[vV][0-9A-Fa-f]+\..+)\](?::.*)?$"


def _let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _split(url: Column) -> Column:
    bare = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    parts = F.split(F.regexp_replace(bare, _PARTS, "$1\n$2\n$3\n$4\n$5\n$6"), "\n", -1)
    names = ("scheme", "host", "path", "params", "query", "fragment")
    return _let(parts, lambda p: F.struct(F.lower(F.get(p, F.lit(0))).alias("scheme"), *[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names) if i]))


def _well_formed(host: Column) -> Column:
    opened, closed = F.contains(host, F.lit("[")), F.contains(host, F.lit("]"))
    return (~opened & ~closed) | (opened & closed & host.rlike(_BRACKETED))


def _without_dots(base: Column, path: Column) -> Column:
    """A path from a base's, dot segments resolved (RFC 3986, 5.2.3 and 5.2.4); empty segments of a relative one go."""
    kept = F.split(F.regexp_replace(base, "[^/]+$", ""), "/", -1)
    folder = F.when(F.contains(base, F.lit("/")) | (base == ""), kept).otherwise(F.array().cast("array<string>"))
    # a base's last slash leaves an empty segment, which goes as an inner one; alone, the first, it stays
    folder = F.when((F.size(folder) > 1) & ~F.endswith(base, F.lit("/")), F.slice(folder, 1, F.size(folder) - 1)).otherwise(folder)
    below = _let(F.concat(folder, F.split(path, "/", -1)), lambda all_: F.filter(all_, lambda s, i: (s != "") | (i == 0) | (i == F.size(all_) - 1)))
    segments = F.when(F.startswith(path, F.lit("/")), F.split(path, "/", -1)).otherwise(below)

    def step(done: Column, s: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(s == "..", up).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

    def resolved(segs: Column) -> Column:
        ends = F.when(F.element_at(segs, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(F.aggregate(segs, F.array().cast("array<string>"), step), ends), "/")

    return _let(_let(segments, resolved), lambda p: F.when(p == "", F.lit("/")).otherwise(p))


def _joined(scheme: Column, host: Column, path: Column, params: Column, query: Column, fragment: Column) -> Column:
    """A URL of its parts; empty parts leave no mark."""
    marked = lambda mark, c: F.when(c != "", F.concat(F.lit(mark), c)).otherwise("")

    def with_host(p: Column) -> Column:
        rooted = F.startswith(p, F.lit("/"))
        there = F.concat(F.lit("//"), host, F.when((p != "") & ~rooted, "/").otherwise(""), p)
        return F.when(host != "", there).when(F.startswith(p, F.lit("//")) | ((scheme != "") & (rooted | (p == ""))), F.concat(F.lit("//"), p)).otherwise(p)

    whole = _let(F.concat(path, marked(";", params)), with_host)
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), whole, marked("?", query), marked("#", fragment))


def resolve_url(base: Column | str, link: Column | str) -> Column:
    """A link as seen from its page, by built-in functions: what urljoin gives for pages of http, https or no scheme.

    Null if the link is, or if an authority has brackets other than around an address before
    its port (urljoin lets more of them pass). Without
    a base the link stays as it is, and so it does if it or the base is of another scheme; an
    empty link is the base. Characters of an authority are not held to their normal forms.
    """
    base, link = (F.col(c) if isinstance(c, str) else c for c in (base, link))

    def join(u: Column) -> Column:
        b, r = u["b"], u["r"]
        same = b["scheme"].isin("", "http", "https") & ((r["scheme"] == "") | (r["scheme"] == b["scheme"]))
        own = _joined(b["scheme"], r["host"], r["path"], r["params"], r["query"], r["fragment"])
        query = F.when(r["query"] != "", r["query"]).otherwise(b["query"])
        here = _joined(b["scheme"], b["host"], b["path"], b["params"], query, r["fragment"])
        below = _joined(b["scheme"], b["host"], _without_dots(b["path"], r["path"]), r["params"], r["query"], r["fragment"])
        nowhere = (r["path"] == "") & (r["params"] == "")
        found = F.when(~same, link).when(r["host"] != "", own).when(nowhere, here).otherwise(below)
        return F.when(_well_formed(b["host"]) & _well_formed(r["host"]), found)

    whole = _let(F.struct(_split(base).alias("b"), _split(link).alias("r")), join)
    return F.when(base.isNull() | (base == ""), link).when(link == "", base).when(link.isNotNull(), whole)
