"""Incremental runs at their edges, writes under failure, layouts."""

import pytest
from pyspark.sql import functions as F

from feedwright.functions import html, text
from feedwright.operators import state, stories
from feedwright.plans.jobs import incremental_run, run_dates, run_or_keep
from feedwright.sources import readers, registry, sinks

FEED = "outlet_id string, section string, section_ord int, pos int, link string, title string, valid boolean"


def feed(spark, outlet, rows):
    return spark.createDataFrame([(outlet, "all", 0, i, link, title, True) for i, (link, title) in enumerate(rows)], FEED)


def test_a_title_stops_links_off_the_domain(spark):
    f = feed(spark, "economynext", [("https://a.example/1", "A"), ("https://b.example/2", "B story - EconomyNext"), ("https://c.example/3", "C")])
    cp = spark.createDataFrame([("economynext", "all", "https://economynext.com/b", "b story")], "outlet_id string, section string, link string, title string")
    none = spark.createDataFrame([], "link string, title string")
    got = incremental_run(registry.BY_ID["economynext"], f, cp, none)
    assert [r.title for r in got.emitted.collect()] == ["A"]
    known = spark.createDataFrame([("https://elsewhere.example/x", "A")], "link string, title string")
    assert incremental_run(registry.BY_ID["economynext"], f, cp.limit(0), known).emitted.count() == 0


def test_links_without_a_number_are_different_articles(spark):
    f = feed(spark, "dailymirror", [(f"https://www.dailymirror.lk/news/{x}", x) for x in "abc"])
    cp = spark.createDataFrame([("dailymirror", "all", "https://www.dailymirror.lk/top/108-7")], "outlet_id string, section string, link string")
    got = incremental_run(registry.BY_ID["dailymirror"], f, cp, spark.createDataFrame([], "link string"))
    assert got.emitted.count() == 3 and [r.link for r in got.checkpoints.collect()] == ["https://www.dailymirror.lk/news/a"]


def test_empty_lists_and_sections_without_news_keep_their_checkpoints(spark):
    o = registry.BY_ID["aruna"]
    cp = spark.createDataFrame([("aruna", "all", "https://www.aruna.lk/x/?old=1")], "outlet_id string, section string, link string")
    known = spark.createDataFrame([], "link string")
    kept = run_or_keep(o, feed(spark, "aruna", []), cp, known)
    assert not kept.write and kept.emitted.count() == 0 and [r.link for r in kept.checkpoints.collect()] == ["https://www.aruna.lk/x/?old=1"]
    caught = run_or_keep(o, feed(spark, "aruna", [("https://www.aruna.lk/x", "t")]), cp, known)
    assert caught.write and caught.emitted.count() == 0 and [r.link for r in caught.checkpoints.collect()] == ["https://www.aruna.lk/x/?old=1"]


def test_writes_are_tried_again():
    waited, left = [], [2]

    def flaky():
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("busy")
        return "done"

    assert sinks.retried(flaky, sleep=waited.append) == "done" and waited == [2, 4]
    left[0] = 9
    with pytest.raises(OSError):
        sinks.retried(flaky, sleep=waited.append)


def test_files_that_are_there_are_read(spark, tmp_path):
    (tmp_path / "aruna_latest_news.json").write_text('[{"title": "t", "link": "l"}, 7]')
    (tmp_path / "island_latest_news_checkpoint.json").write_text("[]")
    got = readers.read_outlets(spark, f"file://{tmp_path}", registry.OUTLETS).collect()
    assert [(r.outlet_id, r.outlet_ord, r.pos, r.title) for r in got] == [("aruna", 10, 0, "t")]
    assert readers.read_outlets(spark, f"file://{tmp_path}/none", registry.OUTLETS).count() == 0
    with pytest.warns(UserWarning, match="nowhere"):
        assert [r.id for r in registry.resolve_targets(spark, ["Observer", "nowhere", "ft.py"]).orderBy("target_ord").collect()] == ["sundayobserver", "ftlk"]


def test_links_claims_and_sections(spark):
    cases = {"": "https://x.example/a/b?q=1", "c": "https://x.example/a/c", "../c/./d": "https://x.example/c/d", "..": "https://x.example/", "#f": "https://x.example/a/b#f", "?z": "https://x.example/a/b?z",
             "mailto:x": "mailto:x", "/r": "https://x.example/r", "//h/p": "https://h/p", "c?a=/../b": "https://x.example/a/c?a=/../b"}
    df = spark.createDataFrame([(k,) for k in cases], "href string")
    got = {r.href: r.j for r in df.withColumn("j", text.joined_link(F.col("href"), "https://x.example/a/b?q=1")).collect()}
    assert got | {"": cases[""]} == cases
    said = spark.createDataFrame([(1, "He said so. Nothing here. Up 5 percent!"), (2, "He said SO."), (3, None)], "id long, text string")
    assert sorted((r.claim, r.first_id, r.n) for r in stories.distinct_claims(stories.claims(said)).collect()) == [("He said so.", 1, 2), ("Up 5 percent!", 1, 1)]
    s = spark.createDataFrame([("a", None, "https://x/en/1", "t", "u"), ("b", None, "https://x/en/2", "t", "u"), ("b", "local", "", "t", "u")], "outlet_id string, section string, link string, title string, updated_at string")
    got = state.migrate_by_url(s, text.needle_section(F.col("link"), (("/en/", "english"),)))
    assert sorted((r.outlet_id, r.section or "") for r in got.collect()) == [("a", ""), ("a", "english"), ("b", ""), ("b", "local")]


def test_every_outlet_has_a_layout_and_dates_run_alone():
    assert set(html.LAYOUTS) == set(registry.BY_ID)
    out = run_dates(registry.OUTLETS, lambda o, a, b: 3 if o.id == "aruna" else 0, "2024-01-01", "2024-01-02", ["aruna", "island"])
    assert [(o.outlet_id, o.error) for o in out] == [("aruna", "exit code 3"), ("island", None)]
