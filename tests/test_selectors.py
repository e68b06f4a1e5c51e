"""Selectors against hand-made pages, each outlet's layout, and the table function."""

import pytest
from pyspark.sql import functions as F

from feedwright.functions.selectors import LISTS, Automaton, Compound, Layout, Rule, link_rows, with_list_links


def picked(selector, page, **how):
    return [x["href"] for x in Layout([Rule(tuple([selector] if isinstance(selector, str) else selector), **how)]).links(page)[1]]


PAGE = """<body><nav><a href="/n">n</a></nav><main id="m"><div class="a b"><p><a href="/1" class="x">one <b>bold</b></a></p></div>
<div class="a"><a href="/2">two</a><br><img src=i><a href='/3' class='x y'>three</a></div><section><div><div class="a b"><a href="/4">4</a></div></div></section></main><a href="/1">again</a></body>"""


@pytest.mark.parametrize(("selector", "want"), [
    ("a", ["/n", "/1", "/2", "/3", "/4"]), ("main a", ["/1", "/2", "/3", "/4"]), (".a.b a", ["/1", "/4"]), (".a > a", ["/2", "/3", "/4"]), ("#m > .a > a", ["/2", "/3"]),
    ("main > div.a > p > a.x", ["/1"]), ("section div div a", ["/4"]), ("section > div > a", []), ("a.x, nav a", ["/n", "/1", "/3"]), ("a[href='/2'], a[class~=y]", ["/2", "/3"]),
    ("a[href^='/'][class$='y']", ["/3"]), ("a[class*='x'] , section a", ["/1", "/3", "/4"]), ("* > p > *", ["/1"]), ("main>section>div>div.b>a[href]", ["/4"]),
])
def test_selectors(selector, want):
    assert picked(selector, PAGE) == want


def test_several_selectors_keep_their_order_and_text_is_joined():
    layout = Layout([Rule(("section a", ".x"))])
    assert [(x["href"], " ".join(x["text"])) for x in layout.links(PAGE)[1]] == [("/4", "4"), ("/1", "one bold"), ("/3", "three")]


def test_outside_up_href_and_limit():
    assert picked("a", PAGE, outside=("nav", "section")) == ["/1", "/2", "/3"]
    assert picked("b", PAGE, up=True) == ["/1"]
    assert picked("a", PAGE, href=r"/[2-9]", limit=2) == ["/2", "/3"]


def test_cards_take_their_first_link_by_the_best_selector():
    page = '<div class=c><a href="/t">t</a><h3><a href="/h">h</a></h3><h3 class=top><a href="/best">b</a></h3></div><div class=c><p>none</p></div><div class=c><a href="/only">o</a></div>'
    assert picked(("h3.top a", "h3 a", "a"), page, card=".c") == ["/best", "/only"]


@pytest.mark.parametrize("bad", ["", "> a", "a >", "a > > b", "a[", "a:hover", "a,,b"])
def test_bad_selectors_are_told(bad):
    with pytest.raises(ValueError, match="no selector"):
        Automaton([bad])


def test_broken_and_deep_pages():
    assert picked("a", "<a href='/1'>x<div></a></div><a href='/2'") == ["/1"]
    deep = "<div>" * 20_000 + "<a href='/x'>x</a>"
    assert picked("div > div a", deep) == ["/x"]
    assert picked("a", "") == [] and Compound.parse("a").fits("a", {}, set())


LINKS = ("https://mawbima.lk/2024/01/02/one", "/articles/108-2/news/x/108-2-7")
SHAPES = {
    "sundaytimes": '<div class="entry loop-default border_bottom_30"><h2 class="entry_title"><a href="{0}">t</a></h2><a href="/no">n</a></div>', "dailynews": '<div><ul><li><article><div><div><h2><a href="{0}">t</a></h2></div></div></article></li></ul></div>',
    "ceylontoday": '<div class="td_module_wrap x tdb_module_loop"><h3 class="entry-title"><a href="{0}">t</a></h3></div>', "dailymirror": '<a href="{0}/108-5"><h3>t</h3></a>', "ftlk": '<div class="lineg"><a href="{0}"><h3 class="newsch">t</h3></a></div>',
    "economynext": '<div class="story-grid-single-story"><a href="/no">n</a><h3 class="recent-top-header"><a href="{0}">t</a></h3></div>', "morning": '<a href="{0}"><h2 class="font-heading hidden">t</h2></a>', "sundayobserver": '<a href="{0}"><h2 class="font-heading hidden">t</h2></a>',
    "divaina": '<div><div><h2><a href="{0}">t</a></h2></div></div>', "lankadeepa": '<section><div><article><a href="{0}"><h2>t</h2></a></article></div></section>', "aruna": '<main><a href="{0}">t</a></main>', "mawbima": '<div class="td-ss-main-content"><a href="{0}">t</a></div>',
    "virakesari": '<section class="group-news"><div class="three-grid"><a class="news-item" href="{0}">t</a></div></section>', "thinakaran": '<ul class="penci-wrapper-data"><article><h2 class="penci-entry-title"><a href="{0}">t</a></h2></article></ul>',
    "thamilan": '<a href="{0}"><h2 class="hidden font-heading">t</h2></a>', "island": '<ul class="mvp-blog-story-list"><li><a href="{0}">t</a></li></ul>', "dinamina": '<ul><li><article><h2><a href="{0}">t</a></h2></article></li></ul>',
}


@pytest.mark.parametrize("outlet", sorted(LISTS))
def test_each_layout_finds_its_links_and_no_others(outlet):
    page = '<html><body><header><a href="/top">x</a></header><nav><a href="/nav">x</a></nav>' + "".join(SHAPES[outlet].format(x) for x in (LINKS[0], LINKS[0] + "b")) + '<footer><a href="/foot">x</a></footer></body></html>'
    rule, found = Layout(LISTS[outlet]).links(page)
    tail = "/108-5" if outlet == "dailymirror" else ""
    assert rule == 0 and [x["href"] for x in found] == [LINKS[0] + tail, LINKS[0] + "b" + tail] and {" ".join(x["text"]) for x in found} == {"t"}


def test_fallbacks():
    plain = '<body><nav><a href="/articles/0">n</a></nav><div><a href="/articles/1">a</a></div><a href="https://economynext.com/x-12/">e</a></body>'
    assert [x["href"] for x in Layout(LISTS["thamilan"]).links(plain)[1]] == ["/articles/1"]
    assert Layout(LISTS["economynext"]).links(plain)[1][0]["href"] == "https://economynext.com/x-12/"
    assert Layout(LISTS["ceylontoday"]).links(plain) == (0, [])


def test_table_function(spark):
    pages = spark.createDataFrame([(1, PAGE, "q"), (2, None, "q"), (3, "", "q"), (4, PAGE, "unknown"), (5, PAGE, None)], "id int, html string, layout string")
    rules = {"q": (Rule((".missing",)), Rule(("section a", "b"), up=False), Rule(("a",)))}
    got = with_list_links(pages, "html", F.col("layout"), rules).orderBy("id", "pos").collect()
    assert [(r.id, r.rule, r.pos, r.href, r.text) for r in got] == [(1, 1, 0, "/4", "4")]
    spark.udtf.register("listed_links", link_rows(rules))
    pages.createOrReplaceTempView("some_pages")
    assert spark.sql("SELECT id, href FROM some_pages, LATERAL listed_links(html, layout)").collect() == [(1, "/4")]
