import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from webloom.functions import html as H
from webloom.functions import jsvars
from webloom.functions.dom import parse
from webloom.functions.extract import MISS, Page, join, json_arrow, normalise_path, resolve_url
from webloom.functions.jsvars import js_variables
from webloom.functions.selectors import SelectorError, compile_selector

PRODUCT = """<script type="application/ld+json">{"@context":"https://schema.org","@type":"Product","name":"Lamp",
"offers":{"@type":"Offer","price":"29.99"}}</script>"""


@pytest.mark.parametrize(
    "html, path, want",
    [
        ('<div class="price">$29.99</div>', "div@text", "$29.99"),
        ('<div class="price">$29.99</div>', "div.price@text", "$29.99"),
        ('<a href="https://example.com">Link</a>', "a@href", "https://example.com"),
        ('<button data-product-id="12345">Buy</button>', "button@data-product-id", "12345"),
        ('<script type="application/ld+json">{"@type":"JobPosting","title":"Engineer"}</script>', 'script[type="application/ld+json"]@text.title', "Engineer"),
        ("<article><header><h1>Title</h1></header></article>", "article header h1@text", "Title"),
        ('<i data-x=\'[{"id":1},{"id":2},{"no":3}]\'></i>', "i@data-x[*].id", [1, 2]),
        ('<i data-x=\'[{"id":1}]\'></i>', "i@data-x[0].id", 1),
        ("<script>var jobs = [{id: 7}];</script>", "script@$jobs[0].id", 7),
        ("<script>var jobs = [{id: 7}, {id: 8}];</script>", "@$jobs[*].id", [7, 8]),
        ('<div data-json=\'[{"a":{"b":2}}]\'></div>', "div@data-json[*].a.b", [2]),
        ("<p>x</p>", "q@text", MISS),
        ("<p>x</p>", "p@href", MISS),
        ("<p>x</p>", "p", MISS),
        ("<p>x</p>", "p[@text", MISS),
        ("<p>not json</p>", "p@text.a", MISS),
    ],
)
def test_path(html, path, want):
    assert Page(html).path(path) == want


def test_element_and_accessors():
    p = Page('<div class="a b"><span>Text</span></div><a href="https://test.com" class="link" title="Test Link">Test</a>')
    assert p.element("div") == {"text": "Text", "html": "<span>Text</span>", "attr": {"class": "a b"}}
    assert p.element("a")["attr"]["title"] == "Test Link"
    assert p.element("a @href") == {"text": None, "html": None, "attr": {}}
    assert p.element("a[") is None and p.element("nope") is None
    assert p.attribute("a.link", "href") == "https://test.com" and p.attribute("a", "id") == ""
    assert p.css("span", "parent.attr:class") == "a b"
    assert p.css("div", "children.0.html") == "<span>Text</span>"
    assert p.css("div", "children.3.text") is None
    assert p.css("a", "html") == '<a href="https://test.com" class="link" title="Test Link">Test</a>'
    assert p.css("a", "whatever") == "Test"


def test_selectors():
    root = parse('<ul id=l><li class="x y">1<li data-k="ab-cd">2<li>3</ul><p lang="en-US">q<p>r')
    pick = lambda s: [e.text().strip() for e in compile_selector(s).select(root)]
    assert pick("li:first-child") == ["1"] and pick("li:last-child") == ["3"]
    assert pick("li:nth-child(odd)") == ["1", "3"] and pick("li:nth-child(2)") == ["2"] and pick("li:nth-last-child(-n+2)") == ["2", "3"]
    assert pick("li.x.y") == ["1"] and pick("#l > li + li") == ["2", "3"] and pick("li.x ~ li") == ["2", "3"]
    assert pick('[data-k^="ab"]') == ["2"] and pick("[data-k$=cd]") == ["2"] and pick('[data-k*="b-c"]') == ["2"] and pick("[data-k|=ab]") == ["2"]
    assert pick("[lang|=en]") == ["q"] and pick('[lang="EN-us" i]') == ["q"]
    assert pick("li:not(.x), p") == ["2", "3", "q", "r"] and pick("ul:has(.x) li:is(.x)") == ["1"]
    assert pick("body *:root") == [] and pick("li:only-child") == []
    for bad in ("", "a[", "a >", ":nope", "..a", "a,,b", "p::text"):
        with pytest.raises(SelectorError):
            compile_selector(bad)


def test_tree():
    assert parse("<p>a<p>b").inner_html() == "<html><head></head><body><p>a</p><p>b</p></body></html>"
    assert parse("<table><tr><td>1<td>2</table>x").inner_html() == "<html><head></head><body><table><tbody><tr><td>1</td><td>2</td></tr></tbody></table>x</body></html>"
    assert parse("<title>a &amp; <b></title>&lt;p&gt;").inner_html() == "<html><head><title>a &amp; &lt;b&gt;</title></head><body>&lt;p&gt;</body></html>"
    assert parse('<script>if (a < b) "</p>"</script>').inner_html() == '<html><head><script>if (a < b) "</p>"</script></head><body></body></html>'
    assert parse("").inner_html() == "<html><head></head><body></body></html>"
    assert parse("<p a='1\"' b=x>&nbsp;").inner_html().count('a="1&quot;" b="x">&nbsp;') == 1


@given(st.text(alphabet="<>/ap \"'=!-tdr&;", max_size=80))
def test_any_text_parses(s):
    once = parse(s).inner_html()
    assert once.startswith("<html>") and parse(s).text() is not None


def test_js():
    assert js_variables('var a = 1, b = "x"; let c = [1, , {k: true, "q": null}]; const d = -2.5; e = `t`;') == {"a": 1, "b": "x", "c": [1, None, {"k": True, "q": None}], "d": -2.5, "e": "t"}
    assert js_variables(r"""var j = JSON.parse('[{"id":1}]'), h = JSON.parse('\x7B\x22a\x22:1\x7D'), u = JSON.parse("{\"b\":2}");""") == {"j": [{"id": 1}], "h": {"a": 1}, "u": {"b": 2}}
    assert js_variables("var a = {k: f()}; var b = {...x, y, z: 1}; var c = 1 + 2; var d = 3") == {"b": {"z": 1}, "d": 3}
    assert js_variables("var a = 1; function f() { var b = 2; c = 3 }") == {"a": 1}
    assert js_variables("var a = 1; var b = 'open") == {} and js_variables("var a = 1; }") == {}
    assert js_variables("// var x = 1;\n/* var y = 2 */ var z = 3") == {"z": 3}
    assert js_variables("window.__DATA__ = {a: 1};") == {} and js_variables("window.__DATA__ = {a: 1};", True) == {"__DATA__": {"a": 1}}
    assert js_variables("var r = /['\"]/.test(x); var a = 1;\nvar b = 2\nc = 3; if (x) { d = 4 }") == {"a": 1, "b": 2, "c": 3}
    assert js_variables("var a = 0x10, t = `a${b}`, n = 1; a = 5;") == {"a": 5, "n": 1}


def test_structured_data():
    p = Page(PRODUCT + '<script type="application/ld+json">{"@graph":[{"@type":["Person","https://schema.org/Author"],"name":"A"},{"@type":"Product","name":"B"}]}</script><script type="application/ld+json">{broken</script>')
    assert [x["name"] for x in p.jsonld["Product"]] == ["Lamp", "B"]
    assert p.jsonld["Person"] == p.jsonld["Author"] and "Offer" not in p.jsonld
    m = Page('<div itemscope itemtype="https://schema.org/Product"><b itemprop="name"> L </b><meta itemprop="sku" content="9"><div itemprop="offers" itemscope itemtype="http://schema.org/Offer"><a itemprop="url" href="/x">y</a></div></div>')
    assert m.microdata == {"Product": [{"name": "L", "sku": "9", "offers": "y", "url": "/x"}], "Offer": [{"url": "/x"}]}
    both = Page(PRODUCT + '<div itemscope itemtype="http://schema.org/Product"><b itemprop="name">M</b></div>')
    assert [x["name"] for x in both.schema["Product"]] == ["Lamp", "M"]
    loose = Page('<script type="application/ld+json">{"@type":["Product","X"],"name":"Q", /* c */ "u":"http://a",}</script>').jsonld_loose()
    assert loose == {"Product": {"@type": ["Product", "X"], "name": "Q", "u": "http://a"}}
    o = Page('<meta property="og:title" content="a"><meta property="og:title" content="b"><meta name="Robots" content="NOINDEX, follow"><meta name="twitter:card" content="s"><link rel="canonical" href="/c">')
    assert o.opengraph == {"title": "b"} and o.opengraph_loose() == {"title": "b", "twitter": {"card": "s"}}
    assert o.meta == {"Robots": "NOINDEX, follow", "twitter:card": "s"} and o.meta_basic() == {"robots": "NOINDEX, follow", "canonical": "/c"}
    assert o.robots_meta("noindex") and not o.robots_meta("nofollow") and o.canonical("https://e.org/a/b") == "https://e.org/c"
    h = Page('<script id="__NEXT_DATA__" type="application/json">{"p":1}</script><script>window.__NUXT__ = {q: 2};</script>')
    assert h.hydration == {"__NEXT_DATA__": {"p": 1}, "__NUXT__": {"q": 2}}


def test_links():
    p = Page('<a href="page.html">1</a><a href="/root">2</a><a href="https://o.com/x#f">3</a><a href="#top">4</a><a href="mailto:a@b.c">5</a><a href=" page.html ">6</a><a href="JavaScript:x()">7</a><a href="ftp://a/b">8</a><a rel="NoFollow x" href="é">9</a>')
    base = "https://base.com/dir/"
    assert p.links(base=base) == ["https://base.com/dir/page.html", "https://base.com/root", "https://o.com/x#f", "https://base.com/dir/page.html", "https://base.com/dir/%C3%A9"]
    assert p.link_records(base) == [{"url": u, "nofollow": n} for u, n in (("https://base.com/dir/page.html", False), ("https://base.com/root", False), ("https://o.com/x", False), ("ftp://a/b", False), ("https://base.com/dir/é", True))]
    assert resolve_url("https://a.com/x/y?q", "../z/./w?p#f") == "https://a.com/z/w?p#f" and resolve_url("http://a.com", "//b.com/c") == "http://b.com/c"
    assert normalise_path("/a/../../b/") == "/b/" and join("http://a.com/x", "?q=1") == "http://a.com/x?q=1"


@given(st.lists(st.sampled_from(["a", "b", "..", ".", ""]), max_size=6))
def test_resolution_is_idempotent(parts):
    once = normalise_path("/" + "/".join(parts))
    assert normalise_path(once) == once


def test_tables():
    t = "<table><thead><tr><th>A</th><th>B</th></tr></thead><tr><td>1</td><td>2 \n x</td><td>3</td></tr><tr><th>h</th><td>4</td></tr></table>"
    assert Page(t).table("table") == (["A", "B", "column3"], [["1", "2 x", "3"], ["4"]])
    assert Page("<table><tr><td>x</td><td>y</td></tr><tr><td>1</td><td>2</td></tr></table>").table("table") == (["x", "y"], [["x", "y"], ["1", "2"]])
    assert Page("<table><tr><th>x</th></tr><tr><td>1</td></tr></table>").table("table") == (["x"], [["1"]])
    assert Page("<ul><li>a<ul><li>b</li></ul></li></ul>").table("ul") == (["item"], [["ab"], ["b"]])
    w = Page('<table><tr><th>N</th></tr><tr><td>5<sup class="reference">[1]</sup><sup id="cite_ref-2">[2]</sup><sup>th</sup></td></tr></table>')
    assert w.table("table", citations=False)[1] == [["5th"]] and w.table("table")[1] == [["5[1][2]th"]]
    for bad in (0, 2):
        with pytest.raises(ValueError):
            w.table("table", bad)


def test_info():
    html = f"""<html><head><title>My Page</title><meta name="description" content="d"><meta name="robots" content="r"><meta property="og:title" content="og">{PRODUCT}
<script>var jobs = [{{"id":1}},{{"id":2}}]; var s = "x";</script></head><body><a href="/1">1</a><a href="/2">2</a><a>3</a><table></table><p>{'Some long text, really. ' * 20}</p></body></html>"""
    i = Page(html).info()
    assert list(i) == ["meta", "og", "readability", "schema", "js", "links", "tables"]
    assert i["meta"]["description"] == "d" and i["og"]["title"] == "og" and i["links"] == 2 and i["tables"] == 1
    assert i["js"][0] == {"name": "jobs", "type": "array", "size": 19, "items": 2} and i["js"][1]["type"] == "string"
    assert [(s["type"], s["count"]) for s in i["schema"]] == [("Product", 1)]
    assert i["readability"]["title"] == "My Page" and len(i["readability"]["excerpt"]) == 150 and i["readability"]["length"] > 400
    assert Page("<p>x").info()["js"] == []


def test_readability_prefers_the_article():
    body = "A sentence with commas, of some length, that goes on. " * 12
    r = Page(f"<title>T</title><nav><a href=/>Home and other things, many</a></nav><div class=sidebar><p>{'ad, ' * 30}</p></div><article><p>{body}</p><p>{body}</p></article><footer><p>foot, foot, foot, foot, foot</p></footer>").readability
    assert r["title"] == "T" and r["text_content"].startswith("A sentence") and "foot" not in r["text_content"] and r["excerpt"].endswith("...")


def test_specs():
    p = Page(PRODUCT + '<p class="x" data-j=\'{"items":[{"id":1},{"id":"b"}]}\'>v</p><meta property="og:t" content="o">')
    assert p.extract({"source": "jsonld", "path": ["Product", "name"]}) == "Lamp"
    assert p.extract({"source": "jsonld", "path": ["Product", "offers", "price"]}) == "29.99"
    assert p.extract({"source": "css", "selector": "p.x", "accessor": "text"}) == "v"
    assert p.extract({"source": "meta", "path": ["no"], "alternatives": [{"source": "og", "path": ["t"]}]}) == "o"
    spec = {"source": "css", "selector": "p", "accessor": "attr:data-j", "json_path": "->'items'", "expand_array": True, "array_field": "id"}
    assert p.expanded(spec) == ["1", "b"] and p.extract(spec) is None
    assert p.extract({**spec, "expand_array": False, "is_json_cast": True, "json_path": "->'items'->[1]->>'id'"}) == '"b"'
    assert json_arrow({"a": [{"b": 2}]}, "->'a'->[0]->>\"b\"") == 2 and json_arrow({"a": 1}, "->c") is MISS


def test_columns(spark):
    rows = [("<p id=a>x</p><a href='/y?z#f'>t</a>", "https://e.org/d/"), (None, "https://e.org"), ("", "https://e.org")]
    df = spark.createDataFrame(rows, "html string, url string")
    got = df.select(
        H.jq("html", "p").alias("p"), H.jq("html", "p", "id").alias("id"), H.jq("html", "q", "id").alias("q"), H.css_select("html", "p", "html").alias("css"), H.htmlpath("html", "p@text").alias("path"),
        H.page_info("html", "url").alias("info"), H.links("html", "url").alias("links"), H.link_records("html", "url").alias("records"), H.schema("html").alias("schema"), H.html_table("html").alias("table"), H.readability("html").alias("r"),
    ).collect()
    a, b, c = got
    assert a.p.text == "x" and a.p.attr == {"id": "a"} and a.id == "a" and a.q == "" and a.css == '<p id="a">x</p>' and a.path == '"x"'
    assert a.links == ["https://e.org/y?z#f"] and a.records[0].url == "https://e.org/y?z" and a.schema == {} and a.table is None
    assert json.loads(a.info)["links"] == 1
    assert all(v is None for v in b)
    assert c.p is None and c.id == "" and c.css == "" and c.path == "null" and c.info == "{}"
    s = df.select(H.html_struct("html", F_lit("text/html; charset=utf-8")).alias("h")).collect()
    assert s[0].h.schema == {} and s[0].h.js is None and s[1].h.document == "" and s[2].h.schema is None
    m = df.select(H.html_extract("html", [{"alias": "t", "source": "css", "selector": "a", "accessor": "text"}]).alias("m"), H.page_fields("html", "url", {"n": ("count", "a[href]"), "t": ("text", "p")}).alias("f")).first()
    assert m.m == {"t": "t"} and m.f.n == "1" and m.f.t == "x"


def F_lit(v):
    from pyspark.sql import functions as F

    return F.lit(v)


def test_a_script_is_read_once_for_all_functions(monkeypatch):
    from webloom.functions import extract

    read = []
    monkeypatch.setattr(extract, "tokens", lambda s: read.append(s) or jsvars.tokens(s))
    p = Page('<script>var a = [1, {"k": 2}]; window.__STATE__ = {"s": 3}; window.__DATA__ = 4;</script><script type="application/ld+json">{"@type":"T"}</script>')
    assert p.js() == {"a": [1, {"k": 2}]} and p.js(True) == {"a": [1, {"k": 2}], "__STATE__": {"s": 3}, "__DATA__": 4}
    assert p.hydration == {"__DATA__": 4}
    assert p.path("@$a[0]") == 1 and p.path("@$a[1].k") == 2 and p.path("@$nope") is MISS
    assert len(read) == 1


def test_elements_are_in_document_order_and_selected_by_tag():
    p = Page("</p><table><td>1<tr><th>2</table><h1>a<h2>b<title>t</title><ul><li>x<p>y<li>z</ul>")
    assert [id(e) for e in p.elements] == [id(e) for e in p.root.walk()]
    for s in ("li", "td, th", "tr td", ".none", "*", "ul > li:last-child", "[href]"):
        assert [id(e) for e in p.all(s)] == [id(e) for e in compile_selector(s).select(p.root)]


def test_pages_that_go_leave_nothing_to_the_collector(monkeypatch):
    import gc

    from webloom.functions.dom import Element

    monkeypatch.setattr(H, "KEPT", 3000)
    H._parsed.clear()
    monkeypatch.setattr(H, "_size", 0)
    gc.collect()
    before = sum(isinstance(o, Element) for o in gc.get_objects())
    with H.uncollected():
        assert not gc.isenabled()
        for i in range(200):
            assert H.page(f"<p>{i}<ul>" + "<li>x" * 20).texts("li") == ["x"] * 20
    assert sum(isinstance(o, Element) for o in gc.get_objects()) - before < 30 * 40
    assert gc.isenabled()
