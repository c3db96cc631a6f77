import html
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lotwise.llm import html_extract as H

T, N, O = True, False, None  # main text, not, open
PAGES = [
    ("<p>a<div class=ad>b</div><p>c", [(O, "a"), (N, "b"), (O, "c")]),
    ("<article><header><h1>T&eacute;</h1></header><p>x<br>y<b>z</b></p><div id='comments'><p>c</p></div><aside>s</aside>tail</article><p>o</p>",
     [(T, "Té"), (T, "x"), (T, "yz"), (N, "c"), (N, "s"), (T, "tail"), (N, "o")]),
    ("<article><p>1 < 2 & 3 &amp; &lt;b&gt; &am</article>", [(T, "1 < 2 & 3 & <b> &am")]),
    ("<main><p>m</main><form>q</form>", [(T, "m"), (N, "q")]),
    ("<div class='cookieConsent'>k</div><div role=main>m</div>", [(N, "k"), (T, "m")]),
    ("<script>var a='</p><article>no</article>'</script><style>x</style><!-- <article>c</article> --><article>yes</article>", [(T, "yes")]),
    ("<article>a<script>x<", [(T, "a")]),
    ("<article>a&nbsp;\t\n b<p>c</p>d<img src='x>y'>e</article>", [(T, "a b"), (T, "c"), (T, "de")]),
    ("<section class='comments'><article>mine</article></section><article>main</article>", [(N, "mine"), (T, "main")]),
    ("<body class='has-sidebar'><article class='menu'>kept</article><div hidden>h</div></body>", [(T, "kept"), (N, "h")]),
    ("<ul class=nav><li>a<li>b</ul><article><ul><li>c<li>d</ul></article>", [(N, "a"), (N, "b"), (T, "c"), (T, "d")]),
    ("<article><math><mi>x</mi><mo>+</mo></math> y<svg><text>no</text></svg></article>", [(T, "x+ y")]),
    # the container with most text, not any article
    ("<main><h1>Real</h1><p>story</main><section><article>Teaser</article></section>", [(T, "Real"), (T, "story"), (N, "Teaser")]),
    ("<main><h1>Title</h1><p>Lead<article>Body</article></main>", [(T, "Title"), (T, "Lead"), (T, "Body")]),
    ("<div><article>one two</article><article>three</article></div><section><article>no</article></section>", [(T, "one two"), (T, "three"), (N, "no")]),
    # names that say more than what is left out stay open
    ("<article>a<div class='social-history'>b</div><div class='notice-of-death'>c</div><div id='related-work'>d</div></article>", [(T, "a"), (O, "b"), (O, "c"), (O, "d")]),
    ("<article>a<div class='cookie-notice x'>b</div><div id=commentList>c</div><div class='ad-slot'>d</div></article>", [(T, "a"), (N, "b"), (N, "c"), (N, "d")]),
    # nothing inside a value is an attribute
    ("<article><p title=\"hidden gem\">a</p><div title='class=\"ad\"'>b</div><div data-class=\"ad\">c</div><div class = ad>d</div><p HIDDEN>e</p></article>", [(T, "a"), (T, "b"), (T, "c"), (N, "d"), (N, "e")]),
    # headings, paragraphs, quotations and inline elements aren't left out by name
    ("<article><h2 id='search'>Search</h2><p>x</p></article>", [(T, "Search"), (T, "x")]),
    ("<article><h2 id='comments'>Comments on the text</h2><h1 id=login>Login guide</h1></article>", [(T, "Comments on the text"), (T, "Login guide")]),
    ("<article><pre>a = 1 <span class='comment'>// code</span></pre><p class='promotion'>He got a promotion.</p></article>", [(T, "a = 1 // code"), (T, "He got a promotion.")]),
    ("<article><p class=share>His share was large</p><blockquote class='reply'>no</blockquote><li class=menu>soup</article>", [(T, "His share was large"), (T, "no"), (T, "soup")]),
    ("", []),
    ("<scr", []),
    ("<", [(O, "<")]),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_split_page(page, want):
    assert H.split_page(page) == want


def test_long_page_is_linear():
    page = "<article>" + "<p class=\"a'b\">x &amp; y<b>" * 30_000 + "<div a='" * 2000 + "<p " + "x " * 50_000
    assert H.split_page(page)[:2] == [(True, "x & y")] * 2


def brute(rows, window=H.WINDOW):
    """Every window of a host's pages, with the open or main texts of the pages it is on."""
    seen, split = defaultdict(set), []
    for page_id, url, page in rows:
        found = H.split_page(page or "")
        open_text = " ".join(t for m, t in found if m is None)
        same = open_text if any(m is None for m, _ in found) else " ".join(t for m, t in found if m)
        words = " ".join(t for m, t in found if not m).split()
        windows = [(i, (H._host(url), tuple(words[i : i + window]))) for i in range(max(1, len(words) - window + 1) if words else 0)]
        for _, w in windows:
            seen[w].add(same)
        split.append((page_id, url, found, words, windows))
    out = []
    for page_id, url, found, words, windows in split:
        covered = set()
        for i, w in windows:
            if len(seen[w]) > 1:
                covered.update(range(i, i + window))
        at, texts = 0, []
        for main, text in found:
            if main:
                texts.append(text)
                continue
            n = len(text.split())
            mine = list(range(at, at + n))
            at += n
            if main is None:
                while mine and mine[0] in covered:
                    mine.pop(0)
                while mine and mine[-1] in covered:
                    mine.pop()
                texts += [words[i] for i in mine]
        text = " ".join(texts)
        out.append((page_id, url, text, len(text)))
    return sorted(out, key=str)


def run(spark, rows, extra=()):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumns({n: F.lit("x") for n in extra})
    return sorted((tuple(r)[:4] for r in H.extracted(df).select("page_id", "url", "text", "n_chars").collect()), key=str)


def test_like_brute_force(spark):
    menu = "<div>" + " ".join(f"menu{i}" for i in range(12)) + "</div>"
    rows = [(i, f"http://a.example/{i}", f"{menu}<div>u{i} own words of page {i} and nothing else at all {i * i}</div>") for i in range(30)]
    rows += [(100 + i, "http://b.example/x", f"<div>{' '.join(f'w{i}{j}' for j in range(20))}</div>{menu if i == 0 else ''}") for i in range(3)]
    rows += [(200, "http://a.example/z", "<article><p>" + " ".join(f"menu{i}" for i in range(12)) + "</article>"), (201, None, menu), (None, "http://a.example/n", menu), (202, "http://a.example/0", None)]
    rows += [(300, "http://c.example/", "<div>" + " ".join(f"c{i}" for i in range(20)) + "</div>")] * 2  # one page twice is no repeat
    rows += [(301, "http://d.example/", "<p>short text"), (302, "http://d.example/", "<p>short text")]
    quote = " ".join(f"q{i}" for i in range(10))
    rows += [(400 + i, "http://e.example/", f"<p>before{i} {quote} after{i}<p>own{i}<div>{quote}</div>") for i in range(3)]
    rows += [(500 + i, "http://f.example/", f"<article>own{i}<div class='social-history'>life of {i}</div><div class='share-this-now'>{quote} x</div><p>{quote}</article>") for i in range(3)]
    rows += [(600 + i, "http://g.example/", f"<p>{menu}<p>" + " ".join(f"w{i}{k % 7000}" for k in range(40_000))) for i in range(2)]  # very long
    got = run(spark, rows, extra=("words", "key", "n", "text"))
    assert got == brute(rows)
    texts = {r[0]: r[2] for r in got}
    assert texts[3] == "u3 own words of page 3 and nothing else at all 9" and texts[200].startswith("menu0") and "menu0" in texts[100]
    assert texts[301] == "short text" and texts[300].startswith("c0")  # copies of a page are no repeats
    assert texts[401] == f"before1 {quote} after1 own1"  # a quotation inside a block stays
    assert len(texts[600].split()) == 40_000
    assert texts[502] == f"own2 life of 2 {quote}"  # repetition decides about what its name leaves open


def test_pages_built_from_known_text(spark):
    """Against the texts that pages are made of, without the parser: markup, references, white space and what is left out."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghij&<>é") for _ in range(rnd.randint(1, 8))) for _ in range(200)]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    code = lambda w: "".join(f"&#{ord(c)};" if rnd.random() < 0.05 else html.escape(c) for c in w)
    space = lambda: rnd.choice([" ", "\n\t ", "&nbsp;", " <!-- x --> "])
    run_of = lambda ws: space().join(f"<b>{code(w)}</b>" if rnd.random() < 0.1 else code(w) for w in ws)
    out = lambda: rnd.choice(["<nav>{}</nav>", "<div class=ad>{}</div>", "<aside>{}</aside>", "<footer>{}</footer>", "<form>{}</form>", "<div class='cookie-notice'>{}</div>", "<div id=comments><p>{}</div>", "<script>{}</script>"]).format(run_of(say(6)))
    rows, want = [], []
    for i in range(300):
        parts, texts = [], []
        for _ in range(rnd.randint(0, 8)):
            ws = say(rnd.randint(1, 20))
            parts.append(rnd.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<ul><li>{}</ul>", "<blockquote>{}</blockquote>", "<div class=text>{}</div>"]).format(run_of(ws)))
            texts.append(" ".join(ws))
            if rnd.random() < 0.3:
                parts.append(out())
        page = f"<html><head><title>t</title></head><body>{out()}<article>{''.join(parts)}</article>{out()}</body></html>"
        rows.append((i, f"http://h{i % 7}.example/{i}", page))
        want.append((i, f"http://h{i % 7}.example/{i}", " ".join(texts), len(" ".join(texts))))
    assert run(spark, rows) == sorted(want, key=str)


def test_empty_table(spark):
    assert run(spark, []) == []


def brute_counts(rows, window=H.WINDOW):
    """page_id, words outside settled main text, those of them in a window that pages with other texts have too."""
    seen, pages = defaultdict(set), []
    for page_id, url, page in rows:
        found = H.split_page(page or "")
        own = " ".join(t for m, t in found if m is None) if any(m is None for m, _ in found) else " ".join(t for m, t in found if m)
        words = " ".join(t for m, t in found if not m).split()
        windows = [(i, (H._host(url), *words[i : i + window])) for i in range(max(1, len(words) - window + 1) if words else 0)]
        for _, w in windows:
            seen[w].add(own)
        pages.append((page_id, words, windows))
    return sorted((p, len(ws), sum(any(i <= at < i + window and len(seen[w]) > 1 for i, w in windows) for at in range(len(ws)))) for p, ws, windows in pages)


def test_array_reads_pages_that_structure_settles(spark):
    """Each page's rows come through its host's array, whether or not structure leaves something open."""
    menu = " ".join(f"menu{i}" for i in range(12))
    rows = [(i, f"http://h{i % 2}.example/{i}", f"<nav>{menu}</nav><article><p>story {i // 3}</article><footer>page {i} of many</footer>") for i in range(24)]
    rows += [(100 + i, f"http://k.example/{i}", f"<nav>{menu}</nav><article>one story</article><aside>{i}</aside>") for i in range(5)]  # copies of one text
    rows += [(200 + i, f"http://s.example/{i}", f"<nav>home about</nav><article>short {i}</article>") for i in range(3)] + [(300, None, None), (301, "http://k.example/", "<article>x</article>")]
    rows += [(400, "http://h1.example/", f"<nav>{menu}</nav><article>one page many times</article>")] * 250  # dealt to several tasks
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted(tuple(r) for r in H.extracted(df).select("page_id", "n_outside", "n_repeated").collect())
    assert got == brute_counts(rows)
    counts = {p: n for p, _, n in got}
    assert counts[0] >= 12 and counts[100] == 0 and counts[200] == 2 and counts[400] == 12
    assert run(spark, rows) == brute(rows)


def test_changed_pages_are_an_error(spark):
    df = spark.createDataFrame([(1, "http://a.example/", "<article>x</article>")], "page_id long, url string, html string")
    found = spark.createDataFrame([(b"other", 1, [])], "key binary, n long, places array<int>")
    with pytest.raises(Exception, match="pages changed between two reads"):
        H.with_repeats(df, found).collect()


def test_array_in_ranges(spark):
    """The array's order, and repeats whose suffixes lie in several ranges of it."""
    streams = [(i, "h", i // 40, "a b c d e f g h") for i in range(400)] + [(1000 + i, "h", 7, f"{'z' * (i % 3)}y b c d e f g h") for i in range(90)]
    streams += [(2000, "other", 1, "a b c d e f g h"), (2001, "h", 5, "a b"), (2002, "h", 6, "a b c"), (2003, "h", 5, ""), (2004, "h", 8, "zy b c d e f g h i")]
    df = spark.createDataFrame(streams, "stream long, host string, page long, rest string").repartition(3)
    for n in (1, 2, 5, 60):
        array = H.suffix_array(df, n)
        parts = array.rdd.map(lambda r: (r.host, r.tokens, r.page, r.stream)).glom().collect()
        order = [r for part in parts for r in part]
        assert order == sorted(order) and len(order) == 495
        if n == 60:
            assert sum(any(r[1] == "a b c d e f g h" for r in part) for part in parts) > 2  # one run of equal tokens in several ranges
        got = sorted(tuple(r) for r in H.repeated(array).collect())
        pages = defaultdict(set)
        for host, tokens, page, _ in order:
            pages[host, tokens].add(page)
        assert got == sorted((r.stream, r.pos) for r in array.collect() if len(pages[r.host, r.tokens]) > 1)
        assert len(got) == 400 + 30 + 1
