"""Feeds read as XML, and what is left out."""

from pyspark.sql import functions as F

from feedwright.sources import readers

GOOD = """<item><title><![CDATA[A &amp; B]]></title><link> https://x.example/1/?u=2&amp;v=3 </link><description>short <b>bold &amp; x</b> end</description><content:encoded><![CDATA[<p>Long &lt;t&gt; text</p><img src="in.jpg">]]></content:encoded>
<pubDate>Tue, 02 Jan 2024 08:05:09 +0530</pubDate><dc:creator><![CDATA[By me]]></dc:creator><category><![CDATA[c1]]></category><category domain="z">c2</category><guid isPermaLink='false'>g1</guid>{more}</item>"""
THUMB = '<media:thumbnail url="t.jpg" /><media:content url="a.jpg"><media:title>x</media:title></media:content><enclosure type="image/png" url="e.png"/>'


def feed(*items):
    return "<?xml version='1.0'?><rss><channel><title>feed</title>" + "\n".join(items) + "</channel></rss>"


def rows(spark, *bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "batch int, body string")


def test_items_have_their_fields(spark):
    df = rows(spark, feed(GOOD.format(more=THUMB), GOOD.format(more='<media:content url="a.jpg"/>'), GOOD.format(more='<enclosure url="e.png" type="image/png"/>'), GOOD.format(more='<enclosure url="e.mp3" type="audio/x"/>')))
    got = readers.rss_items(df).orderBy("pos").collect()
    assert [r.image_url for r in got] == ["t.jpg", "a.jpg", "e.png", "in.jpg"] and [r.pos for r in got] == [0, 1, 2, 3]
    r = got[0]
    assert (r.title, r.link, r.date, r.author, r.rss_categories, r.guid) == ("A & B", "https://x.example/1/", "2024-01-02 08:05:09", "By me", ["c1", "c2"], "g1")
    assert r.summary.startswith("Long") and r.description.split() == ["short", "bold", "&", "x", "end"]


def test_bad_items_go_to_the_rejects(spark):
    bad = ["<item><title>a &nbsp; b</title><link>https://x.example/2</link></item>", "<item><title>x</title><link>https://x.example/3<b></link></item>", "<item><title>none</title></item>", "<item/>"]
    df = rows(spark, feed(GOOD.format(more=""), *bad[:3]), None, "", "no feed", feed())
    assert [r.pos for r in readers.rss_items(df).collect()] == [0]
    got = sorted((r.batch, r.pos, r.reason) for r in readers.rss_rejects(df).collect())
    assert got == [(0, 1, "malformed"), (0, 2, "malformed"), (0, 3, "no link")]
    assert {r.record for r in readers.rss_rejects(df).collect()} == set(bad[:3])


def test_files_are_read_by_item(spark, tmp_path):
    (tmp_path / "one.xml").write_text(feed(*(GOOD.replace("/1/", f"/{i}/").format(more="") for i in range(50))))
    (tmp_path / "two.xml").write_text(feed(GOOD.format(more=""), "<item><title>&bad;</title></item>"))
    (tmp_path / "none.xml").write_text("<rss><channel></channel></rss>")
    items = readers.read_rss(spark, str(tmp_path))
    got = readers.rss_items(items).where("data_file = 'one.xml'").orderBy("pos").collect()
    assert [r.link for r in got] == [f"https://x.example/{i}/" for i in range(50)] and [r.pos for r in got] == list(range(50))
    assert items.where("data_file = 'none.xml'").count() == 0
    assert [(r.data_file, r.reason) for r in readers.rss_rejects(items.drop("pos")).collect()] == [("two.xml", "malformed")]


def test_batch_rejects(spark):
    df = rows(spark, '[{"link": "a"}, 7, "x", {"link": "b", "rss_categories": 1}, null]', '{"link": "a"}', "[broken", None)
    got = sorted((r.batch, r.pos if r.pos is not None else -1, r.reason) for r in readers.batch_rejects(df).collect())
    assert got == [(0, 1, "no object"), (0, 2, "no object"), (0, 3, "malformed"), (0, 4, "no object"), (1, -1, "no array"), (2, -1, "no array"), (3, -1, "no array")]
    assert readers.articles_in(df).where(F.col("batch") == 0).count() == 2
