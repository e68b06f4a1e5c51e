import json

import pytest
from pyspark.sql import functions as F

from feedwright.sources import readers, registry, sinks
from feedwright.streaming import stream


def test_json_batches(spark, tmp_path):
    files = {
        "a.json": json.dumps([{"title": "t1", "link": "l1", "rss_categories": ["x", "y"]}, 7, None, "s", [1], {"link": "l2", "summary": "é\n"}]),
        "b.json": '{"title": "an object"}', "c.json": "not json [", "d.json": "[]", "e.json": "", "f.json": '[{"link": "l3"}, {"link": ',
    }
    for name, body in files.items():
        (tmp_path / name).write_text(body)
    got = readers.read_batches(spark, str(tmp_path)).orderBy("data_file", "pos").collect()
    assert [(r.data_file, r.link) for r in got] == [("a.json", "l1"), ("a.json", "l2")]
    assert got[0].rss_categories == ["x", "y"] and got[1].summary == "é\n" and got[0].section is None


def test_checkpoints(spark, tmp_path):
    (tmp_path / "a_checkpoint.json").write_text(json.dumps({"last_scraped_link": "g", "sections": {"s/1": {"last_scraped_link": "l", "last_scraped_title": ""}}}))
    (tmp_path / "b_checkpoint.json").write_text("[]")
    got = readers.read_checkpoints(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].last_scraped_link == "g" and got[0].sections["s/1"].last_scraped_link == "l"


RSS = """<?xml version="1.0"?><rss><channel><title>c</title>
<item><title><![CDATA[One & two]]></title><link>https://x/1?utm=1</link><pubDate>Tue, 10 Jun 2025 20:43:22 +0530</pubDate><description>short &amp; sweet</description>
<content:encoded><![CDATA[<p>Body <b>text</b></p><img src="https://x/i.jpg"> The post One appeared first on X]]></content:encoded><dc:creator>Ann</dc:creator><category>a</category><category><![CDATA[b]]></category><guid>g1</guid></item>
<item><title>No link</title></item><item><title>Two</title><link>https://x/2/</link><enclosure url="https://x/e.png" type="image/png"/></item></channel></rss>"""


def test_rss(spark):
    df = spark.createDataFrame([("o", f"<html><body>{RSS}</body></html>"), ("p", "no feed"), ("q", None)], "outlet_id string, body string")
    rows = readers.rss_items(df.withColumn("body", readers.recovered_rss(F.col("body"))), as_of=F.lit("2026-01-01").cast("timestamp")).orderBy("pos").collect()
    assert [(r.pos, r.title, r.link, r.date) for r in rows] == [(0, "One & two", "https://x/1/", "2025-06-10 20:43:22"), (2, "Two", "https://x/2/", "2026-01-01 00:00:00")]
    assert rows[0].author == "Ann" and rows[0].rss_categories == ["a", "b"] and rows[0].image_url == "https://x/i.jpg" and rows[0].description == "short & sweet"
    assert rows[0].summary.startswith("Body") and "appeared" not in rows[0].summary and rows[1].image_url == "https://x/e.png" and rows[1].date_source == "RSS: missing"


def test_posts_and_preferred_source(spark):
    body = json.dumps([{"id": 1, "title": {"rendered": "A &amp; B"}, "link": "https://x/a", "date": "2026-01-02T03:04:05", "excerpt": {"rendered": "<p>ex</p>"}, "content": {"rendered": "<p>co</p>"}}, {"id": 2, "title": "bad"}])
    df = spark.createDataFrame([("o", body), ("p", "{}")], "outlet_id string, body string")
    posts = readers.post_items(df)
    r = posts.collect()
    assert [(x.title, x.summary, x.description, x.date) for x in r if x.outlet_id == "o"] == [("A & B", "co", "ex", "2026-01-02 03:04:05")]
    rss = spark.createDataFrame([("z", 0, "https://z")], "outlet_id string, pos int, link string")
    both = readers.preferred_source(rss, posts.unionByName(rss.withColumn("link", F.lit("worse")), allowMissingColumns=True)).collect()
    assert sorted((x.outlet_id, x.link) for x in both) == [("o", "https://x/a/"), ("z", "https://z")]


def test_grids(spark):
    g = readers.date_grid(spark, "2026-01-31", "2026-02-01", ["news", "sports"], "https://x/")
    assert [r.url for r in g.orderBy("date_ord", "cat_ord").collect()] == ["https://x/260131/news", "https://x/260131/sports", "https://x/260201/news", "https://x/260201/sports"]
    f = spark.createDataFrame([("https://x/c/",)], "url string")
    pages = lambda style: [r.page_url for r in readers.page_urls(f, 2, style).orderBy("page").collect()]
    assert pages("path") == ["https://x/c/", "https://x/c/page/2/"] and pages("query")[1] == "https://x/c?page=2" and pages("offset")[1] == "https://x/c/30"


def test_registry(spark):
    assert [r.id for r in registry.resolve_targets(spark, ["island", "nowhere", "aruna"]).orderBy("target_ord").collect()] == ["island", "aruna"]
    assert registry.resolve_targets(spark, runs_on="local").count() == 8 and registry.outlets(spark).where("language = 'Tamil'").count() == 3
    names = spark.createDataFrame([("a.json",), ("a_checkpoint.json",), ("a.txt",), ("discarded_links.json",)], "n string")
    assert [r.n for r in names.where(registry.is_batch_name(F.col("n"))).collect()] == ["a.json"]
    old = registry.outlets(spark).where("id <> 'island'")
    assert registry.seed(old, registry.outlets(spark)).count() == 17


def test_merge_and_upsert(spark):
    new = spark.createDataFrame([(0, "https://x/n"), (1, "https://x/b/")], "pos int, link string")
    old = spark.createDataFrame([(0, "https://x/b?q"), (1, "https://x/c"), (2, "https://x/d")], "pos int, link string")
    got = sinks.merged_archive(new, old, limit=3).orderBy("pos").collect()
    assert [r.link for r in got] == ["https://x/n", "https://x/b/", "https://x/c"] and [r.pos for r in got] == [0, 1, 2]
    cur = spark.createDataFrame([("a", 1), ("b", 1)], "url string, v int")
    add = spark.createDataFrame([("b", 2), ("b", 3), ("c", 1)], "url string, v int")
    once = sinks.upserted(cur, add, "url", ["v"])
    want = [("a", 1), ("b", 3), ("c", 1)]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, sinks.upserted(once, add, "url", ["v"]).collect())) == want


def test_runs_close_as_failed(spark):
    now = F.lit("2026-01-01").cast("timestamp")
    run = sinks.close_run(sinks.open_run(spark, "r", now), now, 5, 3, "boom").first()
    assert (run.status, run.articles_in, run.articles_out, run.error_message) == ("failed", 5, 3, "boom")


def test_first_seen_stream(spark, tmp_path):
    (tmp_path / "1.json").write_text("".join(json.dumps({"link": x, "at": f"2026-01-01T0{i}:00:00"}) + "\n" for i, x in enumerate(["https://x/a", "https://x/a?z", "https://x/b"])))
    rows = stream.first_seen(spark.readStream.schema("link string, at timestamp").json(str(tmp_path)), "link", "at")
    q = rows.writeStream.format("memory").queryName("first_seen_test").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.norm for r in spark.sql("SELECT norm FROM first_seen_test").collect()) == ["https://x/a", "https://x/b"]


@pytest.mark.parametrize("name", ["stream_upsert", "fold_emit", "html_text_blocks", "pages_per_host"])
def test_registered_queries_run(spark, name):
    import __spark_entry__ as entry

    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_registered_queries_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry
    from feedwright.plans import catalog

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    for name, sql in catalog.ORACLES.items():
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        names = sorted(df.columns)
        rel = c.sql(sql)
        assert sorted(rel.columns) == names, name
        plain = lambda rows: sorted(repr([str(v) for v in r]) for r in rows)
        want = plain(c.execute(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
        got = plain(tuple(r) for r in df.select(*names).collect())
        assert [x.lower() for x in got] == [x.lower() for x in want], name
