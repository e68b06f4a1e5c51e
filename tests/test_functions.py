import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedwright.functions import dates, html, text


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def check(spark, column, cases):
    assert dict(zip([c for c, _ in cases], values(spark, column, [c for c, _ in cases]))) == dict(cases)


def test_normalize_link(spark):
    check(spark, text.normalize_link, [
        ("", ""), (None, ""), (" ", ":///"), ("HTTPS://WWW.Ex.com/A/b/?q=1#f", "https://www.ex.com/A/b"), ("https://x.com", "https://x.com/"),
        ("https://x.com///", "https://x.com/"), ("  https://x.com/a/  ", "https://x.com/a"), ("/rel/path/", ":///rel/path"), ("//cdn.x/Y", "://cdn.x/Y"),
        ("x.com/a", "://x.com/a"), ("https://U:P@X.com:8080/a", "https://u:p@x.com:8080/a"), ("https://x.com/a;p=1", "https://x.com/a"),
        ("https://x.com/a;p/b;q", "https://x.com/a;p/b"), ("https://x.com/a b", "https://x.com/a b"), ("https://x.com/a\tb", "https://x.com/ab"),
        ("https://x.com/අ/", "https://x.com/අ"), ("https://x.com/%E0%B6%85/", "https://x.com/%E0%B6%85"), ("mailto:a@b", "mailto://a@b"),
        ("https://x.com/?id=1", "https://x.com/"), ("https://x.com/?id=2", "https://x.com/")])


def test_ids_and_sections(spark):
    check(spark, text.story_id, [("https://x/a/108-346962", 346962), ("https://x/a/107-346962/", 346962), ("https://x/foo-123", 123), ("https://x/foo", 0), ("", 0), (None, 0)])
    check(spark, text.article_id, [("https://x/article/42/t", 42), ("https://x/a", 0)])
    check(spark, text.post_id, [("https://x/a-77/", 77), ("https://x/a-77/b", 0)])
    check(spark, lambda c: text.dated_path_section(c, ("local", "sports")), [
        ("https://x/2026/06/04/local/123/x/", "local"), ("https://x/2026/6/4/Featured/1/", "features"), ("https://x/2026/06/04/only-slug/", None), ("https://x/about/", None)])
    check(spark, lambda c: text.needle_section(c, (("/business/", "b"), ("/opinion/", "o"))), [("https://x/opinion/business/", "b"), ("https://x/opinion/1", "o"), ("https://x/", None)])


def test_text_pieces(spark):
    check(spark, lambda c: text.title_key(c, "Some Outlet"), [(" Rates rise | Some Outlet ", "rates rise"), ("Rates - some outlet", "rates"), (None, "")])
    check(spark, text.feed_link, [("https://x/a?b#c", "https://x/a/"), ("https://x/a//", "https://x/a/"), (" ", ""), (None, "")])
    check(spark, lambda c: text.truncate(c, 3, "..."), [("abcd", "abc..."), ("abc", "abc"), (None, None)])
    check(spark, text.collapse_space, [("  a  \n b ", "a b")])
    check(spark, lambda c: text.default_text(c, "(no title)"), [("  ", "(no title)"), (None, "(no title)"), (" a ", "a")])
    check(spark, lambda c: text.absolute_link(c, "https://x.example/"), [("/a", "https://x.example/a"), ("//y/a", "https://y/a"), ("http://z", "http://z")])
    check(spark, text.ascii_only, [("aé日b", "ab")])
    check(spark, lambda c: text.redirect_target(c, "outlet.example"), [
        ("https://n.example/articles/CAEiK2h0dHBzOi8vd3d3Lm91dGxldC5leGFtcGxlLzIwMjYvMDYvMDQvYS8", "https://www.outlet.example/2026/06/04/a/"),
        ("https://n.example/articles/!!!?x", "https://n.example/articles/!!!?x"), ("https://n.example/b", "https://n.example/b")])


def test_content_hash(spark):
    df = spark.createDataFrame([("T", "S"), ("(no title)", None)], "t string, s string").select(text.content_hash(F.col("t"), F.col("s")).alias("h"))
    assert [r.h for r in df.collect()] == ["68344aed23f4feb9cc461caf01d554532303470c3c534d7482bb9e41a545f631", "1fe0f892263b4a6d833d86d2c77fcf893958faaa794c74a3cc2414fc9104afa9"]


def at(*args):
    return dt.datetime(*args)


def test_published(spark):
    d, day = at(2026, 6, 10, 20, 43, 22), at(2026, 6, 10)
    check(spark, dates.parse_published, [
        ("2026-06-10T20:43:22+05:30", d), ("2026-06-10T20:43:22Z", None), ("2026-06-10T20:43:22-05:00", None), ("2026-06-10T20:43:22.123456", d),
        ("2026-06-10 8:3:2", at(2026, 6, 10, 8, 3, 2)), ("2026-06-10", day), ("2026-6-1", at(2026, 6, 1)), ("10 June 2026", None), ("Unknown", None), (None, None)])


def test_generic_dates(spark):
    d = at(2026, 1, 30)
    check(spark, dates.parse_generic, [
        ("January 30, 2026", d), (" January 30, 2026 ", d), ("30 January 2026", d), ("2026-01-30", d), ("30-01-2026", d), ("01/30/2026", d), ("january 9, 2026", at(2026, 1, 9)),
        ("January  30, 2026", d), ("2026-1-3", at(2026, 1, 3)), ("03/04/2026", at(2026, 3, 4)), ("30/01/2026", None), ("Jan 30, 2026", None), ("2026-02-30", None)])


def test_other_dates(spark):
    check(spark, dates.parse_weekday_time, [("Monday, 24 November 2025 06:10", at(2025, 11, 24, 6, 10)), ("Sunday, 24 November 2025 06:10", at(2025, 11, 24, 6, 10))])
    check(spark, dates.parse_weekday_forms, [("Monday, 19 Jan 2026", at(2026, 1, 19)), ("2026-01-19T12:00:00", at(2026, 1, 19, 12))])
    check(spark, dates.parse_bar_date, [("09 Feb, 2026 | 01:03 PM", at(2026, 2, 9, 13, 3)), ("09 Feb, 2026 01:03 PM", None)])
    check(spark, dates.parse_after_comma, [("6:23 pm,Thursday July 17, 2025", at(2025, 7, 17))])
    check(spark, dates.parse_list_date, [("23 November 2025 06:10", at(2025, 11, 23, 6, 10)), ("Nov 3, 2025", at(2025, 11, 3)), ("3  Nov\t2025", at(2025, 11, 3))])
    check(spark, dates.parse_iso_wall_clock, [("2025-07-18T02:03:00+05:30", at(2025, 7, 18, 2, 3)), ("2025-07-18 junk", at(2025, 7, 18)), ("N/A", None)])
    check(spark, dates.parse_iso_variants, [("2025-07-18T02:03:00+00:00Z", at(2025, 7, 18, 2, 3)), ("2025-07-18T02:03:00.5Z", at(2025, 7, 18, 2, 3))])
    check(spark, dates.parse_rfc822, [("Tue, 10 Jun 2025 20:43:22 +0530", at(2025, 6, 10, 20, 43, 22)), ("10 Jun 2025 20:43:22 GMT", at(2025, 6, 10, 20, 43, 22))])
    check(spark, dates.date_in_url, [("https://x/250713/news/a", at(2025, 7, 13)), ("https://x/news", None)])
    check(spark, dates.find_date, [("posted 9 Feb 2026 by", at(2026, 2, 9)), ("on 12 March 2026", at(2026, 3, 12)), ("x 2026-1-2 y", at(2026, 1, 2)), ("none", None)])


def test_relative_dates(spark):
    as_of = F.lit("2026-03-01 12:00:00").cast("timestamp")
    now = at(2026, 3, 1, 12)
    day = dt.timedelta(days=1)
    check(spark, lambda c: dates.relative_date(c, as_of), [("a day ago", now - day), ("2 weeks ago", now - 14 * day), ("3 months ago", now - 90 * day), ("2 years ago", now - 730 * day),
                                                       ("a year ago", now - 365 * day), ("An hour ago", now - day / 24), ("January 30, 2026", at(2026, 1, 30)), ("soon", None)])
    check(spark, lambda c: dates.search_relative_date(c, as_of), [("updated 5 hours ago", now - 5 * day / 24), ("no", None)])
    check(spark, lambda c: dates.sinhala_relative_date(c, as_of), [("මිනිත්තු 13කට පෙර", now - 13 * day / 1440), ("පැය 2", now - day / 12), ("දින 3", now - 3 * day), ("සති 1", now - 7 * day), ("මාස 2", now - 60 * day), ("දින", None)])


def test_ranges_and_first_date(spark):
    low, high = F.lit("2026-01-01").cast("date"), F.lit("2026-01-31").cast("date")
    df = spark.createDataFrame([(at(2026, 1, 31, 23),), (at(2026, 2, 1),), (None,)], "d timestamp")
    assert [tuple(r) for r in df.select(dates.in_range(F.col("d"), low, high), dates.in_range(F.col("d"), low, high, True)).collect()] == [(True, True), (False, False), (False, True)]
    got = df.select(*dates.first_date((F.col("d"), "page"), (F.lit("2026-05-05").cast("timestamp"), "list"))).collect()
    assert [r[1] for r in got] == ["page", "page", "list"]


PAGE = """<html><head><title>T &amp; x</title><meta property="og:title" content="OG"><meta property="og:image" content="/i/og.jpg">
<meta name="description" content="D"><script type="application/ld+json">{"datePublished": "2026-01-02"}</script><script>var t="</p>";</script></head>
<body><nav><a href="/n?x">n</a></nav><!-- <p>no</p> --><article class="entry-content"><h1>Head <b>line</b></h1><p>First paragraph of the body, long enough to count as text.<p>Second one, in bold <b>and</b> plain, with more words than the first had.</p>
<img src="/img/a.png"><a href="/a/1?q#f">one</a><a href="/a/1">again</a><a href="/a/2">two</a></article><footer><p>foot</p></footer></body></html>"""


def test_html(spark):
    df = spark.createDataFrame([(PAGE,), ("",), (None,), ("<p>open <b>tags",)], "h string")
    h = F.col("h")
    r = df.select(html.title_of(h).alias("t"), html.paragraphs_in(h).alias("p"), html.body_text(h, least=20).alias("b"), html.content_links(h).alias("l"), html.json_ld_date(h).alias("j"),
                  html.image_of(h, "https://x.example").alias("i"), html.visible_text(h).alias("v"), html.page_heading(h).alias("g")).collect()
    assert r[0].t == "OG" and r[0].g == "Head line" and r[0].j == "2026-01-02" and r[0].i == "https://x.example/i/og.jpg"
    assert r[0].l == ["/a/1", "/a/2"] and [p[:6] for p in r[0].p] == ["First ", "Second"] and r[0].b.count("\n\n") == 1 and "var t" not in r[0].v
    assert r[1].t == "" and r[1].p == [] and r[3].p == ["open tags"]


def test_html_predicates(spark):
    check(spark, html.valid_image_url, [("https://x/a.jpg", True), ("https://x/photo/1", True), ("/a.jpg", False), ("N/A", False), (None, False)])
    check(spark, html.plausible_image, [("https://x/a.jpg", True), ("data:image/png;base64,xx", False), ("https://x/logo.png", False), ("x.png", False), (None, False)])
    check(spark, html.is_block_page, [("x" * 600, False), ("x" * 499, True), ("Just A Moment" + "x" * 600, True), (None, True), ("", True)])
    check(spark, lambda c: html.valid_body(c, "json"), [("[]", True), (" {", True), ("x", False), (None, False)])
    check(spark, lambda c: html.valid_body(c, "xml"), [("<?xml " + "x" * 600, True), ("x" * 600, False), ("<rss>", False)])
    check(spark, html.first_image_src, [("<img alt=1 src='a.jpg'>", "a.jpg"), ("<img class=x data-src=\"b.jpg\">", "b.jpg"), ("", "")])
    check(spark, html.without_boilerplate, [("Body. The post X appeared first on Y", "Body."), ("Body. FOLLOW US ON z", "Body."), ("Body", "Body")])
    check(spark, html.until_promo, [("a<a class=b href=\"https://whatsapp.com/channel/1\">z", "a"), ("abc", "abc")])


@pytest.mark.parametrize("n,batch", [(1, 1), (25, 1), (26, 2)])
def test_batches(spark, n, batch):
    assert spark.range(1).select(text.batch_number(F.lit(n))).first()[0] == batch


def test_article_links_and_cards(spark):
    check(spark, lambda c: text.is_article_link(c, "dated"), [("https://x/2026/06/04/a/", True), ("https://epaper.x/2026/06/04/a/", False), ("https://x/a", False), (None, False)])
    check(spark, text.looks_like_article, [("https://x.lk/local/a-long-story", True), ("https://x.lk/category/a-long-story/", False), ("https://x.lk/short", False), ("#top", False), (None, False)])
    check(spark, text.without_slash, [("https://x/a//", "https://x/a"), ("https://x/a", "https://x/a")])
    check(spark, lambda c: html.page_ready(c, ("<article",)), [("<article" + "x" * 600, True), ("x" * 600, False), ("<article", False), (None, False)])
    page = "<div class='card big'><a href='/1'><img src='a.png'></a><h3>One <b>1</b></h3><span class='date'>2 days ago</span></div><p>no</p><div class='card'><a href='/2'>Two</a></div>"
    df = spark.createDataFrame([(page,), ("",), (None,)], "h string")
    got = [r[0] for r in df.select(html.list_cards(F.col("h"), "card", "date")).collect()]
    assert [tuple(c) for c in got[0]] == [(0, "One 1", "/1", "2 days ago", "a.png"), (1, "Two", "/2", "", "")] and got[1] == [] and got[2] is None


def test_references_end_with_a_semicolon(spark):
    page = "<title>a &amp b</title><script type='application/ld+json'>{\"datePublished\": \"a & b &amp;\"}</script><article><h1>cut &amp</h1><p>x &amp; y &lt; &#39;z&#39 &bogus; &copy=1</p></article>"
    df = spark.createDataFrame([(page,), ("<!-- & open <p>x",), (None,)], "h string")
    r = df.select(html.title_of(F.col("h")).alias("t"), html.paragraphs_in(F.col("h")).alias("p"), html.json_ld_date(F.col("h")).alias("j")).collect()
    assert r[0].t == "cut &amp" and r[0].p == ["x & y < 'z&#39 &bogus; &copy=1"] and r[0].j == "a & b &amp;" and r[2].t == ""
    cards = spark.createDataFrame([("<div class='card'><a href='/1?a=1&amp;b=2&c=3'>One &amp</a></div>",)], "h string").select(html.list_cards(F.col("h"), "card", "date")).first()[0]
    assert [tuple(c)[1:3] for c in cards] == [("One &amp", "/1?a=1&b=2&c=3")]


def test_links_of_a_year(spark):
    check(spark, lambda c: text.is_article_link(c, "of_year", ()), [("https://x/en/2093/", True), ("https://x/2026/06/04/a/", True), ("https://x/en/2093", False), ("https://x/1999/", False), (None, False)])
