from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from pricetrail.llm import oracle, queries, wrappers
from pricetrail.llm.url_rules import Rule, RuleIndex, filter_urls, site_rule, split_url, url_tokens


def test_url_query_against_sql(spark, sf):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    got = sorted(map(tuple, queries.op1_url_filters(spark, sf).collect()))
    assert got == sorted(duck.execute(oracle.ORACLE["op1_url_filters"]).fetchall())


@pytest.mark.parametrize(
    "url, parts",
    [(None, ("", "")), ("", ("", "")), ("no scheme", ("", "")), ("http://A.Example.ORG", ("a.example.org", "")),
     ("x://h/p/Q?r#s", ("h", "/p/Q")), ("x://h?r=/p", ("h", "")), ("x://h#f?/p", ("h", "")),
     ("a://b://c/d", ("b:", "//c/d")), ("://h/ü", ("h", "/ü")), ("x://ÄB/", ("Äb", "/"))],
)
def test_split_url(url, parts):
    assert split_url(url) == parts


@pytest.mark.parametrize(
    "url, rule, verdict",
    [("http://a.org/x", "org/", "allow"), ("http://example.org/es/1", "example.org/es/", "block"),
     ("http://w.example.org/en/12", "example.org/en/1", "block"), ("http://example.org/en/2", "org/", "allow"),
     ("http://notexample.org/es/", "org/", "allow"), ("http://a.com/fr/x", "com/fr/", "allow"),
     ("http://com/de/", "com/de/", "block"), ("http://a.com/FR/", None, "allow"), ("http://a.org", None, "allow"),
     ("http://xcom/fr/", None, "allow"), ("http://spam-farm.example.org/q", "org/", "allow"),
     ("http://www.Casino-win.example.net/q", None, "block"), ("http://a.net/casino-win", None, "allow"),
     (None, None, "allow")],
)
def test_rules(url, rule, verdict):
    index = RuleIndex(queries.SITE_RULES + queries.FILTERS)
    assert index.judge(url)[2:4] == (rule, verdict)


def test_the_index_finds_what_running_every_rule_finds():
    rules = [Rule("/ads/", "block"), Rule("||track.example.^", "block"), Rule("*banner*", "block"),
             Rule("||b.example.com/x/*/y/", "allow"), Rule("-promo-", "block"), site_rule("allow", "example.com/a-b/c")]
    assert Rule("*banner*", "block").tokens == [] and Rule("||b.example.com/x/*/y/", "allow").tokens == [
        "b", "example", "com", "x", "y"]
    urls = ["http://h/ads/1", "http://h/xads/1", "http://track.example./", "http://a.b.example.com/x/1/y/2",
            "http://h/bigbanners", "http://h/a-promo-b", "http://h/apromob", "http://w.example.com/a-b/cd",
            "http://h/ADS/"]
    for counts in ({}, {"example": 9, "com": 9, "ads": 1}, {"b": 5, "x": 1}):
        index = RuleIndex(rules, counts)
        every = RuleIndex(rules)
        every.always = [r for bucket in [*every.by_token.values(), every.always] for r in bucket]
        every.by_token = {}
        for url in urls:
            assert index.judge(url)[:5] == every.judge(url)[:5]
            for rule in rules:  # every token of a rule that fits is a token of the url
                import re

                if re.search(rule.pattern, "".join(split_url(url))):
                    assert set(rule.tokens) <= url_tokens(*split_url(url))


def test_odd_url_rows(spark):
    kind = "page_id LONG, url STRING, host STRING, rule STRING, token STRING"
    frame = spark.createDataFrame([(1, None, "x", "x", "x"), (1, "", "x", "x", "x"), (None, "http://a.org/", "x", "x", "x"),
                                   (2, "http://" + "a/" * 100_000, "x", "x", "x")], kind)
    got = filter_urls(frame, queries.SITE_RULES).collect()
    assert sorted((str(r.page_id), r.verdict) for r in got) == [
        ("1", "allow"), ("1", "allow"), ("2", "allow"), ("None", "allow")]
    assert filter_urls(frame.limit(0), queries.SITE_RULES).collect() == []
    assert filter_urls(frame, []).count() == 4


def page(body, head="<title>T</title><script>if (a<b) x('</p>')</script><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


AROUND = (
    '<header>Site name</header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>'
    '<div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> --><div class="ad">Buy {0}</div>'
)
AFTER = (
    "<aside>More</aside><form><p>Search</p><input></form><div id='comments'><p>First {0}!</p></div>"
    "<footer>&copy; {0}</footer>"
)


def texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, host STRING, rule STRING, text STRING")
    return {r.page_id: r.text for r in wrappers.main_text(frame).collect()}


def test_article_pages(spark):
    rows = []
    for n in range(8):
        body = "".join(f"<p>Block {n}.{k} &amp; <b>bold</b><br> text&nbsp;here</p>" for k in range(n % 4))
        article = f"<article><h1>Title  {n}</h1>{body}<aside>no</aside><ul><li>one<li>two</ul></article>"
        rows.append((n, f"http://h.org/{n}", page(AROUND.format(n) + article + AFTER.format(n)), "x", "x", "x"))
    got = texts(spark, rows)
    for n in range(8):
        blocks = [f"Title {n}", *(f"Block {n}.{k} & bold text here" for k in range(n % 4)), "one", "two"]
        assert got[n] == "\n".join(blocks)


def test_pages_without_an_article_element(spark):
    """The wrapper tells the host's own words from the text that changes."""
    rows = []
    for n in range(6):
        words = " ".join(f"word{n}{k}" for k in range(40))
        body = f"<div class='x1'><p>Welcome to our site</p></div><div class='c7'><h2>News {n}</h2><p>{words}</p><p>{words} end</p></div>"
        rows.append((n, f"https://H.org/{n}", page(f"{AROUND.format(n)}{body}<div class='x2'>All rights</div>{AFTER.format(n)}"), "", "", ""))
    got = texts(spark, rows)
    for n in range(6):
        words = " ".join(f"word{n}{k}" for k in range(40))
        assert got[n] == f"News {n}\n{words}\n{words} end"


def test_equal_pages_keep_their_article(spark):
    body = "<article><p>Same text everywhere</p></article>"
    got = texts(spark, [(n, "http://h.org/", page(AROUND.format(1) + body), "", "", "") for n in range(5)])
    assert set(got.values()) == {"Same text everywhere"}


class Blocks(HTMLParser):
    """The blocks of a page's article element, read by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skipped, self.block, self.blocks = 0, 0, [], []

    def close_block(self):
        text = " ".join("".join(self.block).split())
        self.blocks += [text] if text else []
        self.block = []

    def handle_starttag(self, tag, attrs):
        if tag not in wrappers.INLINE and tag not in wrappers.VOID:
            self.close_block()
        self.inside += tag == "article"
        self.skipped += tag in ("script", "style", "nav", "aside", "form", "header", "footer")
        self.block += [" "] if tag == "br" else []

    def handle_endtag(self, tag):
        if tag not in wrappers.INLINE and tag not in wrappers.VOID:
            self.close_block()
        self.inside -= tag == "article"
        self.skipped -= tag in ("script", "style", "nav", "aside", "form", "header", "footer")

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.block.append(data)


def test_query_on_the_table(spark, sf):
    got = {r.page_id: r for r in queries.op2_html_extraction(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        parser = Blocks()
        parser.feed(p.html)
        parser.close()
        assert got[p.page_id].text == "\n".join(parser.blocks) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None, None), (1, None, ""), (None, "http://a/", "<p>open <b>tag"), (2, "http://a/", "plain &lt;text&gt;"),
            (3, "http://a/", "</div></p><br>" * 1000 + "<p title='x>y'>q</p><p class=\"unclosed>z"), (4, "http://deep/", deep),
            (5, "http://a/", "<p>long</p>" * 20_000), (6, "http://b/", "<!-- never closed <p>x</p>"), (7, "http://c/", "<script>only")]
    got = texts(spark, [(*r, "x", "x", "x") for r in rows])
    assert got[1] == "" and got[4] == "deep" and got[5].count("long") == 20_000 and got[7] == ""
    frame = spark.createDataFrame([], "page_id LONG, url STRING, html STRING")
    assert wrappers.main_text(frame).collect() == []


def test_deep_elements_close_only_themselves(spark):
    deep = "<div>" * 70 + "<p>deep</p>" + "</div>" * 70
    body = f"<div><article><p>before</p>{deep}<p>after</p></article></div><div class='footer'><p>not this</p></div>"
    got = texts(spark, [(n, "http://h/", page(body), "", "", "") for n in range(2)])
    assert set(got.values()) == {"before\ndeep\nafter"}


def test_a_host_in_many_tasks_is_one_expression(spark):
    rows = [(n, f"http://{'h' if n % 3 else f'o{n}'}/", page(f"<article><p>text {n}</p></article>")) for n in range(120)]
    frame = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").repartition(40)
    counts = {r.host: r.pages for r in wrappers.infer_wrappers(frame).collect()}
    assert counts["h"] == 80 and len(counts) == 41 and sum(counts.values()) == 120
    assert {r.page_id: r.text for r in wrappers.main_text(frame).collect()} == {n: f"text {n}" for n in range(120)}


def test_alignment_makes_optional_and_repeated_parts():
    first = wrappers.expression(wrappers.parse("<div><h1>a</h1><p>b</p><p>c</p><ul><li>x</li></ul></div>"))
    second = wrappers.expression(wrappers.parse("<div><h1>a</h1><p>d</p><table><tr><td>1</td></tr></table></div>"))
    div = wrappers.merged(first, second, 2).kids[0]
    assert [(k.label, k.optional, k.repeated) for k in div.kids] == [
        ("h1", 0, 0), ("p", 0, 1), ("ul", 1, 0), ("table", 1, 0)]
    assert div.kids[0].kids[0].same != -1 and div.kids[1].kids[0].same == -1
    assert wrappers.Node.unpacked(div.packed()).packed() == div.packed()


def test_every_word_of_an_element_counts(spark):
    """Many words come before the one that says what the element is."""
    many = "block column layout primary region right"
    inner = "".join(f"<div class='{many} {w}'><p>not {{0}}</p></div>" for w in ("sidebar widget", "share", "social", "toolbar"))
    rows = []
    for n in range(4):
        words = " ".join(f"word{n}{k}" for k in range(40))
        rows.append((n, "http://a/", page(f"<article><p>{words}</p>{inner.format(n)}</article>"), "", "", ""))
        body = f"<div class='{many} text'><p>{words}</p></div>{inner.format(n)}"
        rows.append((10 + n, "http://b/", page(body), "", "", ""))
        main = f"<div class='{many} content grid main'><p>{words}</p></div><div class='x'><p>{words} {words} other</p></div>"
        rows.append((20 + n, "http://c/", page(main), "", "", ""))
    got = texts(spark, rows)
    assert got == {h + n: " ".join(f"word{n}{k}" for k in range(40)) for n in range(4) for h in (0, 10, 20)}


def test_furniture_below_any_depth_is_left_out(spark):
    """Unclosed elements put the page below depth 60; nested elements around and articles there count as above."""
    rows = []
    for n in range(4):
        words = " ".join(f"word{n}{k}" for k in range(40))
        around = f"<nav>go {n}</nav><div class='ad'><div><p>buy {n}</p></div></div><aside><aside>x{n}</aside></aside>"
        rows.append((n, "http://a/", page(f"<article>{'<div>' * 70}<p>{words}</p>{around}<p>end</p></article>"), "", "", ""))
        deep = f"{'<section>' * 90}{around}<main>not {n}<article><h1>T</h1>{words}{around}</article></main><form>f{n}</form>"
        rows.append((10 + n, "http://b/", page(deep), "", "", ""))
        boxed = f"{'<div>' * 3000}<div class='sidebar'><main><p>{words}</p></main>s{n}</div>{around}"
        rows.append((20 + n, "http://c/", page(boxed), "", "", ""))
    got = texts(spark, rows)
    for n in range(4):
        words = " ".join(f"word{n}{k}" for k in range(40))
        assert (got[n], got[10 + n], got[20 + n]) == (f"{words}\nend", f"T\n{words}", words)


def test_a_long_attribute_value_is_no_text(spark):
    data = "{'a': '<p>no</p>'}" * 1000
    quoted = data.replace("'", "&#39;")
    body = f'<article><div data-x="{quoted}"><p>yes</p></div><p title=\'{data.replace(chr(39), chr(34))}\'>end</p></article>'
    assert set(texts(spark, [(n, "http://h/", page(body), "", "", "") for n in range(3)]).values()) == {"yes\nend"}


@pytest.mark.parametrize("attributes", ["data-x=don't", 'size=5"', "a='b'c", 'title="a>b"', "x = 'y>z' w", "a=b'c d=\"e\""])
def test_stray_quotes_lose_no_text(attributes):
    page = f"<article><p {attributes}>First paragraph.</p><p>It's second.</p><p class=\"x\">Third \"one\".</p></article>"
    assert wrappers.extract(page, None).endswith("It's second.\nThird \"one\".")
    assert "First paragraph." in wrappers.extract(page, None)


def by_one_wrapper(pages):
    total = None
    for html in pages:
        node = wrappers.expression(wrappers.parse(html))
        total = wrappers.merged(total, node, total.pages + 1) if total else node
    rule = wrappers.verdict(total)
    return [wrappers.extract(html, rule) for html in pages]


@pytest.mark.parametrize("element", ["div class='post-ad-free'", "section id='related-work'", "div class='search-results'",
                                     "p class='promotion'", "h2 class='navigation'", "div class='navigation-theory wide'"])
@pytest.mark.parametrize("box", ["article", "div class='story-ad-free'", "div class='c7'"])
def test_a_word_of_a_name_does_not_decide_inside_an_article(element, box):
    pages, expected = [], []
    for n in range(6):
        words = " ".join(f"word{n}{k}" for k in range(40))
        body = f"<{box}><h1>T{n}</h1><p>{words}</p><{element}>own text {n}</{element.split()[0]}><p>{words}</p></{box.split()[0]}>"
        pages.append(page(AROUND.format(n) + body + AFTER.format(n)))
        expected.append(f"T{n}\n{words}\nown text {n}\n{words}")
    assert by_one_wrapper(pages) == expected


@pytest.mark.parametrize("inner", ["<div class='share-bar'>share {0}</div>", "<div class='ad'>buy {0}</div>", "<p class='ads'>buy {0}</p>",
                                   "<p class='promotion'>The same on every page</p>", "<div class='more-related-x'><a href='/'>go {0}</a></div>",
                                   "<ul class='comment-list'><li>nice {0}</li></ul>", "<span class='share-count'>{0} times</span>"])
def test_names_that_the_expression_or_all_their_words_confirm_are_left_out(inner):
    pages, expected = [], []
    for n in range(6):
        words = " ".join(f"word{n}{k}" for k in range(40))
        pages.append(page(f"<article><p>{words}</p>{inner.format(n)}<p>{words}</p></article>"))
        expected.append(f"{words}\n{words}")
    assert by_one_wrapper(pages) == expected


def size(node):
    return 1 + sum(size(k) for k in node.kids)


def hashed(n):
    """A page of 40 names that no other page has."""
    names = ["".join(chr(97 + (n * 7919 + k * 104_729 + d * (n + 3 * k)) % 26) for d in range(8)) for k in range(40)]
    return "<div class='page'>" + "".join(f"<div class='x{name} a'><p>t{n}</p></div>" for name in names) + "</div>"


def test_names_that_hardly_recur_are_one_repeated_child():
    """An expression's size, and so the time a page takes, does not grow with the pages."""
    sizes, total = [], None
    for n in range(400):
        node = wrappers.expression(wrappers.parse(hashed(n)))
        total = wrappers.merged(total, node, total.pages + 1) if total else node
        sizes.append(size(total))
    assert max(sizes[200:]) <= max(sizes[:100]) * 1.1 and total.pages == 400
    rule = wrappers.verdict(total)
    assert wrappers.extract(hashed(7), rule) == "\n".join(["t7"] * 40)


def test_a_name_on_some_pages_stays_apart_whenever_it_begins():
    total = None
    for n in range(300):
        more = f"<div class='late'><p>text {n}</p></div>" if n >= 200 and n % 4 == 0 else ""
        node = wrappers.expression(wrappers.parse(f"<div class='first'><p>a{n}</p></div>{more}<div class='x{chr(97 + n % 26) * (n + 1)}'>z</div>"))
        total = wrappers.merged(total, node, total.pages + 1) if total else node
    own = Counter()
    for k in total.kids:
        own[k.label] += k.pages
    assert own["div.first"] == 300 and own["div.late"] == 25 and own["div"] > 250


def test_many_different_children_keep_their_order():
    names = [f"{a}{b}q" for a in "cdefg" for b in "hijklmnopqrstuvwxyz"]
    nodes = [wrappers.expression(wrappers.parse("".join(f"<div class='{x}'>{n}</div>" for x in names if x != skip)))
             for n, skip in enumerate(("chq", "dkq", "gzq"))]
    total = wrappers.merged(wrappers.merged(nodes[0], nodes[1], 2), nodes[2], 3)
    assert [k.label for k in total.kids] == [f"div.{x}" for x in names]
    assert [k.label for k in total.kids if k.optional] == ["div.chq", "div.dkq", "div.gzq"]


@given(st.text("abcd", max_size=30), st.text("abcd", max_size=30))
def test_matches_are_a_common_subsequence(a, b):
    found = wrappers.matches(list(a), list(b))
    assert all(a[x] == b[y] for x, y in found)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:], strict=False))
    assert bool(found) == bool(set(a) & set(b))
    assert len(wrappers.matches(list(a), list(a))) == len(a)
