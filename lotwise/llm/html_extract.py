"""Main text of pages: page structure first, a host suffix array for what it leaves open.

Each page is read into blocks. Structure settles two kinds: what flows in the page's main
container (the <main> or <article> with most text) is main text; menus, headers, footers,
sidebars, notices, adverts, forms and reader comments, by element, role or a container's name that
says no more than that, are not. Two kinds stay open: containers inside the main one
whose class or id has such a word next to others ("social-history"), and, on pages
without a main container, all text that isn't settled.

All that is not settled main text is its page's token stream, for every page. Spark sorts the
suffixes of each host's streams by their first WINDOW tokens: the host's suffix array, as deep as
a repeat must be long. Runs of neighbours whose common prefix has that length and that lie on two
distinct pages give every substring of at least WINDOW tokens that two pages of the host share.
Ranges of the order, not hosts, are dealt to tasks, so a host may hold any share of the pages.

Every page's text is then made from its blocks and what the array found in its stream: in open
blocks, repeated runs that reach an edge of their block go, and unique runs stay. Runs inside a
block (quotations) stay too. Blocks that structure leaves out go, repeated or not.

What flows in a main container is never removed: copies of an article, and passages that
articles share, would be repeats too (see README).
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import HOT_LEAST, HOT_SHARE, materialized, partitions, scoped, sliced, table

WINDOW = 8
#: Suffixes that a Python worker makes at a time.
SUFFIXES = 1 << 15

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|title|svg)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S | re.I,
)
#: One attribute after the other, so that nothing inside a value is taken for one.
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a block, and br; all others, unknown ones too, are inline.
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head"
    " header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead"
    " title tr ul".split()
)
_OUT = frozenset("head nav footer aside form button select option menu dialog object canvas audio video datalist".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
#: Words in a class or id that say what a container is, if no other words stand next to them but neutral ones.
_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promos promotion cookie cookies consent gdpr notice notices"
    " popup modal overlay newsletter subscribe subscription signup sidebar rail menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead"
    " topbar toolbar comment comments reply replies disqus respond share sharing social related recommended recommendations widget widgets search login".split()
)
_NEUTRAL_NAMES = frozenset("area articles bar block box container element inner item items left link links list main outer page panel post posts right section site slot stories top wrap wrapper".split())
#: Elements whose class or id is read. Headings, paragraphs, quotations and inline elements carry such words as anchors and styles.
_NAMED = frozenset("article center details div dl fieldset figure ol section table ul".split())
_COMMENTS = frozenset("comment comments reply replies disqus respond".split())
#: A start tag on the left ends an open one on the right, inside the nearest container.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPES = frozenset("html body div section article main ul ol dl table td th header footer nav aside form blockquote".split())


def _attributes(attrs: str) -> dict[str, str]:
    """Attributes by lower-case name; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        found.setdefault(m[1].lower(), html.unescape(next((x for x in m.groups()[1:] if x is not None), "")))
    return found


def _state(tag: str, attrs: dict[str, str], in_main: bool) -> str:
    """What a container is: out, named (its name has a word that may say so) or open."""
    if tag in _OUT or tag in ("header", "footer") and not (in_main and tag == "header"):
        return "out"
    if tag in ("html", "body", "main"):
        return "open"
    if attrs.get("role", "").lower() in _OUT_ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return "out"
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return "out"
    state = "open"
    if tag not in _NAMED:
        return state
    for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = {w.lower() for w in _NAME.findall(token)}
        telling = words & (_COMMENTS if tag == "article" else _OUT_NAMES)
        if "header" in words and not in_main and tag != "article":
            telling.add("header")
        if telling and words <= telling | _NEUTRAL_NAMES:
            return "out"
        if telling and tag != "article":
            state = "named"
    return state


def read_blocks(page: str) -> tuple[list[tuple[str, int, str]], list[tuple[str, int]]]:
    """(state, container, text) in page order, block by block; and the containers.

    Text is decoded. The state is open, named or out. Containers are numbered from 1 on, 0
    is none: each <main> and each <article> that is in no other, as its tag and the number
    of the element that it is in. chosen() says which make the main text.
    """
    found: list[tuple[str, int, list[str]]] = []
    containers: list[tuple[str, int]] = []
    stack: list[tuple[str, str, int, int]] = []  # open tags: state and container of their text, their number
    state, inside, number, opened, at, fresh = "open", 0, 0, 0, 0, True

    def say(text: str) -> None:
        nonlocal fresh
        if not fresh and found and found[-1][:2] == (state, inside):
            found[-1][2].append(text)
        else:
            found.append((state, inside, [text]))
        fresh = False

    def back_to(depth: int) -> None:
        nonlocal state, inside, number
        del stack[depth:]
        _, state, inside, number = stack[-1] if stack else ("", "open", 0, 0)

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            say(html.unescape(page[at : m.start()]))
        at = m.end()
        if m["cdata"] is not None:
            say(m["cdata"])
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if tag in _BLOCK:
            fresh = True
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    back_to(i)
                    break
                if stack[i][0] in ("article", "main") and tag in ("p", "span", "b", "i"):
                    break  # a stray end tag doesn't end what contains it
        else:
            raw = m["attrs"] if m["tag"] else m["attrs2"]
            ends = _CLOSES.get(tag, set()) | ({"p"} if tag in _BLOCK and tag not in ("br", "button", "option", "optgroup", "select") else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    back_to(i)
                    break
                if stack[i][0] in _SCOPES:
                    break
            if tag in _VOID or raw.rstrip().endswith("/") and tag not in ("p", "div"):
                continue
            attrs = _attributes(raw) if raw and not raw.isspace() else {}
            new, new_inside = state, inside
            opened += 1
            if state != "out":
                new = _state(tag, attrs, inside > 0)
                if new == "open":
                    new = state
                main = tag == "main" or attrs.get("role", "").lower() == "main"
                if new != "out" and not inside and (main or tag == "article"):
                    containers.append(("main" if main else "article", number))
                    new, new_inside = "open", len(containers)
            stack.append((tag, new, new_inside, opened))
            state, inside, number = new, new_inside, opened
    if at < len(page):
        say(html.unescape(page[at:]))
    return [(s, c, text) for s, c, parts in found if (text := " ".join("".join(parts).split()))], containers


def chosen(found: list[tuple[str, int, str]], containers: list[tuple[str, int]]) -> set[int]:
    """The container with most text; if it is an article, with the articles beside it."""
    if not containers:
        return set()
    mass = [0] * (len(containers) + 1)
    for state, inside, text in found:
        mass[inside] += len(text) * (state == "open")
    best = max(range(1, len(mass)), key=lambda i: (mass[i], -i))
    kind = containers[best - 1]
    return {i for i, c in enumerate(containers, 1) if i == best or kind[0] == "article" and c == kind}


def split_page(page: str) -> list[tuple[bool | None, str]]:
    """(whether it is main text, None where that is open; text) for the page's blocks in order."""
    found, containers = read_blocks(page)
    best = chosen(found, containers)
    out: list[tuple[bool | None, str]] = []
    for state, inside, text in found:
        if state == "out" or best and inside not in best:
            out.append((False, text))
        else:
            out.append((True if best and state == "open" else None, text))
    return out


def _host(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def unique_runs(words: list[str], covered: list[bool]) -> list[str]:
    """A block's words without the covered runs that begin or end it."""
    first, last = 0, len(words)
    while first < last and covered[first]:
        first += 1
    while last > first and covered[last - 1]:
        last -= 1
    return words[first:last]


def _layout(url: str | None, page: str | None) -> tuple[bytes, str, int, list[str], list[str], list[int]]:
    """A page's key, host, own text's hash, stream, blocks, and where in the stream each block ends (-1: settled).

    The key is of host, own text and stream: what the array finds depends on nothing else.
    """
    found = split_page(page or "")
    open_ = any(main is None for main, _ in found)
    words, blocks, ends = [], [], []
    for main, text in found:
        if not main:
            words += text.split()
        if main is not False:
            blocks.append(text)
            ends.append(len(words) if main is None else -1)
    host = _host(url)
    own = xxhash.xxh64_digest(" ".join(text for main, text in found if main is None or main and not open_))
    key = xxhash.xxh3_128_digest(f"{own.hex()}{' '.join(words)}\n{host}")
    return key, host, int.from_bytes(own, "big", signed=True), words, blocks, ends


def streams_of(pages: DataFrame) -> DataFrame:
    """key, host, page (hash of its own text), rest (the stream's words) and n for the distinct streams of pages."""

    def read(batches):
        for batch in sliced(batches):
            keys, hosts, own, words, _, _ = zip(*map(_layout, batch.column("url").to_pylist(), batch.column("html").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(hosts, pa.string()), pa.array(own, pa.int64()), pa.array([" ".join(w) for w in words], pa.string())],
                ["key", "host", "page", "rest"],
            )

    read_ = pages.select("url", "html").mapInArrow(read, "key binary, host string, page long, rest string")
    return read_.groupBy("key", "host", "page", "rest").agg(F.count("*").alias("n"))


def suffix_array(streams: DataFrame, n: int) -> DataFrame:
    """stream, pos, host, page, tokens: the suffixes of all hosts by their first WINDOW tokens, in n ranges of that order.

    A suffix starts at each place that has WINDOW tokens; of shorter streams the whole is one.
    Equal tokens of one host are in order of page, and may go on in the next ranges.
    """

    def suffixes(batches):
        for batch in sliced(batches):
            for stream, host, page, rest in zip(*(c.to_pylist() for c in batch.columns)):
                words = rest.split(" ")
                last = max(1, len(words) - WINDOW + 1)
                for at in range(0, last, SUFFIXES):
                    starts = range(at, min(last, at + SUFFIXES))
                    size = len(starts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(stream, pa.int64()), size), pa.array(starts, pa.int32()), pa.repeat(pa.scalar(host, pa.string()), size)]
                        + [pa.repeat(pa.scalar(page, pa.int64()), size), pa.array([" ".join(words[i : i + WINDOW]) for i in starts], pa.string())],
                        ["stream", "pos", "host", "page", "tokens"],
                    )

    order = ("host", "tokens", "page", "stream")
    made = streams.filter("rest <> ''").select("stream", "host", "page", "rest").mapInArrow(suffixes, "stream long, pos int, host string, page long, tokens string")
    return made.repartitionByRange(n, *order).sortWithinPartitions(*order)


def _repeats(batches):
    """The suffixes in runs of neighbours that share their tokens, and lie on two distinct pages or more.

    Others can lie so only in the first and last run of a range, which may go on in another:
    those come with their tokens and page, and so do two pages of such a run, without a stream.
    """
    names = ["stream", "pos", "host", "tokens", "page"]
    run, low, high, held, first = None, 0, 0, [], True  # host and tokens, first and last page, suffixes while there is one page

    def rows(stream, pos, edge=None, page=None):
        n = len(pos)
        host, tokens = edge or (None, None)
        return pa.RecordBatch.from_arrays(
            [pa.array(stream, pa.int64()), pa.array(pos, pa.int32()), pa.array([host] * n, pa.string()), pa.array([tokens] * n, pa.string()), pa.array([None] * n if page is None else page, pa.int64())],
            names,
        )

    def ended(edge):
        if edge and low != high:
            yield rows([None, None], [None, None], run, [low, high])
        elif edge:
            for stream, pos in held:
                yield rows(stream, pos, run, [low] * len(pos))

    for batch in batches:
        if not batch.num_rows:
            continue
        host, tokens = batch.column("host"), batch.column("tokens")
        stream, pos, page = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("stream", "pos", "page"))
        begins = np.ones(len(page), bool)
        begins[1:] = ~pc.and_(pc.equal(host[1:], host[:-1]), pc.equal(tokens[1:], tokens[:-1])).to_numpy(zero_copy_only=False)
        if run is None:
            run, low, high = (host[0].as_py(), tokens[0].as_py()), page[0], page[0]
        begins[0] = run != (host[0].as_py(), tokens[0].as_py())
        cuts = [*np.flatnonzero(begins).tolist(), len(page)]

        def goes_on(a, b):
            nonlocal high, held
            high = page[b - 1]  # pages ascend in a run
            held.append((stream[a:b], pos[a:b]))
            if low != high:
                found, held = held, []
                return [rows(*part) for part in found]
            return []

        if cuts[0]:
            yield from goes_on(0, cuts[0])
        if len(cuts) > 1:
            yield from ended(first)
            first = False
            starts, ends = np.array(cuts[:-2], np.int64), np.array(cuts[1:-1], np.int64)
            if len(starts):
                hit = cuts[0] + np.flatnonzero(np.repeat(page[starts] != page[ends - 1], ends - starts))
                yield rows(stream[hit], pos[hit])
            at = cuts[-2]
            run, low, high, held = (host[at].as_py(), tokens[at].as_py()), page[at], page[at], []
            yield from goes_on(at, len(page))
    if run is not None:
        yield from ended(True)


def repeated(array: DataFrame) -> DataFrame:
    """stream, pos of the array's suffixes whose first WINDOW tokens are on two distinct pages of their host."""
    found = materialized(array.mapInArrow(_repeats, "stream long, pos int, host string, tokens string, page long"))
    edges = found.filter("tokens is not null").groupBy("host", "tokens").agg(F.min("page").alias("low"), F.max("page").alias("high")).filter("low <> high").select("host", "tokens")
    undecided = found.filter("tokens is not null and stream is not null").join(F.broadcast(edges), ["host", "tokens"], "left_semi")  # two runs a range at most
    return found.filter("tokens is null").unionByName(undecided.select(found.columns)).select("stream", "pos")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_outside, n_repeated for every row.

    The last two count the words outside settled main text, and those of them in a repeat that
    the host's suffix array found. Null html is empty. A null or odd url belongs to the host ''.
    Repeated rows each give a row. Pages whose open texts (or, without any, main texts) are equal
    count as one, so copies of a page and one page under several ids are no repeats. Columns may
    have any other names. The rows are read twice, and must be the same both times.
    """
    spark = pages.sparkSession

    def found() -> DataFrame:
        streams = materialized(streams_of(pages).withColumn("stream", F.monotonically_increasing_id()))
        places = repeated(suffix_array(streams, partitions(pages))).groupBy("stream").agg(F.collect_list("pos").alias("places"))  # a page's own
        return streams.select("stream", "key", "n").join(places, "stream", "left").select("key", "n", F.coalesce("places", F.array().cast("array<int>")).alias("places"))

    return with_repeats(pages, scoped(spark, found))


def with_repeats(pages: DataFrame, found: DataFrame) -> DataFrame:
    """extracted(), from the places of repeats in each distinct stream."""
    kind = pages.schema["page_id"].dataType.simpleString()
    limit = max(HOT_LEAST, (found.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE)
    dealt = found.withColumn("deals", F.ceil(F.col("n") / limit).cast("int"))

    def read(batches):
        for batch in sliced(batches):
            keys, _, _, words, blocks, ends = zip(*map(_layout, batch.column("url").to_pylist(), batch.column("html").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(keys, pa.binary()), pa.array(blocks, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32()))]
                + [pa.array([len(w) for w in words], pa.int64())],
                ["page_id", "url", "key", "blocks", "ends", "outside"],
            )

    def made(batches):
        for batch in sliced(batches):
            texts, counts = [], []
            for blocks, ends, outside, places in zip(*(batch.column(c).to_pylist() for c in ("blocks", "ends", "outside", "places"))):
                hit = np.zeros(outside + 1, np.int64)
                for at in places:
                    hit[at] += 1
                    hit[min(at + WINDOW, outside)] -= 1
                hit = np.cumsum(hit[:-1]) > 0
                counts.append(int(hit.sum()))
                words = []
                for text, end in zip(blocks, ends):
                    if end < 0:
                        words.append(text)
                    else:
                        own = text.split()
                        words += unique_runs(own, hit[end - len(own) : end].tolist())
                texts.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), batch.column("outside"), pa.array(counts, pa.int64())],
                ["page_id", "url", "text", "n_outside", "n_repeated"],
            )

    rows = pages.select("page_id", "url", "html").mapInArrow(read, f"page_id {kind}, url string, key binary, blocks array<string>, ends array<int>, outside long")
    # many copies of one page are dealt to several tasks
    hot = F.broadcast(dealt.filter("deals > 1").select("key", "deals"))
    rows = rows.join(hot, "key", "left").withColumn("deal", F.coalesce(F.expr("pmod(monotonically_increasing_id(), deals)"), F.lit(0)).cast("int"))
    dealt = dealt.select("key", "places", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"))
    missing = F.raise_error(F.lit("pages changed between two reads")).cast("array<int>")
    joined = rows.join(dealt, ["key", "deal"], "left").select("page_id", "url", "blocks", "ends", "outside", F.coalesce("places", missing).alias("places"))
    text = joined.mapInArrow(made, f"page_id {kind}, url string, text string, n_outside long, n_repeated long")
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_outside", "n_repeated")


def op1_host_suffix_html(spark, sf_dir):
    """The main text of every page, from its whole html; null html gives an empty text."""
    return extracted(table(spark, sf_dir, "pages"))
