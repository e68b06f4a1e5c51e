import random

import pytest
from pyspark.sql import functions as F

from feedwright.operators import bronze, feeds, state, stories
from feedwright.operators.graph import components, contracted
from feedwright.plans.jobs import incremental_run
from feedwright.sources.registry import BY_ID, OUTLETS

FEED = "outlet_id string, section string, section_ord int, pos int, norm string, boundary boolean, valid boolean"


def random_feed(seed):
    r = random.Random(seed)
    return [(f"o{o}", f"s{s}", s, p, f"l{r.randint(0, 25)}", r.random() < 0.08, r.random() > 0.1) for o in range(25) for s in range(4) for p in range(12)]


def fold_by_hand(rows, limit):
    out = []
    for outlet in sorted({x[0] for x in rows}):
        seen = set()
        for section in range(4):
            n = 0
            for row in sorted(x for x in rows if x[0] == outlet and x[2] == section):
                if n >= limit or row[5]:
                    break
                if row[4] in seen or not row[6]:
                    continue
                seen.add(row[4])
                n += 1
                out.append((outlet, section, row[3], row[4]))
    return sorted(out)


@pytest.mark.parametrize("seed,limit", [(1, 3), (2, 5), (3, 1)])
def test_fold_equals_the_loop(spark, seed, limit):
    rows = random_feed(seed)
    got = sorted(tuple(r) for r in feeds.emit_fold(spark.createDataFrame(rows, FEED).repartition(3), limit).collect())
    assert got == fold_by_hand(rows, limit)
    assert len({(o, n) for o, _, _, n in got}) == len(got)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_consecutive_outside_equals_the_loop(spark, k):
    r = random.Random(k)
    rows = [(o, p, r.choice([True, False, None]), r.random() < 0.03) for o in range(40) for p in range(15)]
    want = []
    for o in range(40):
        run = 0
        for _, p, inside, hard in (x for x in rows if x[0] == o):
            if inside:
                run = 0
                want.append((o, p))
            else:
                run += 1
            if run >= k or hard:
                break
    df = spark.createDataFrame(rows, "o int, p int, inside boolean, hard boolean")
    got = feeds.consecutive_outside_stop(df, ["o"], "p", F.col("inside"), k, F.col("hard")).select("o", "p").collect()
    assert sorted(map(tuple, got)) == want


def test_neutral_rows_don_t_count(spark):
    df = spark.createDataFrame([(0, 0, True), (0, 1, False), (0, 2, None), (0, 3, False), (0, 4, True)], "o int, p int, i boolean")
    stop = lambda neutral: [r.p for r in feeds.consecutive_outside_stop(df, ["o"], "p", F.col("i"), 3, neutral=neutral).collect()]
    assert stop(None) == [0] and sorted(stop(F.col("i").isNull())) == [0, 4]


def test_prefix_global_stop_and_orientation(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 1, 6), ("a", 2, 7), ("b", 0, 9), ("b", 1, 3)], "s string, pos int, id int")
    assert sorted(r.id for r in feeds.until_boundary(df, F.col("id") == 6, ["s"]).collect()) == [3, 5, 9]
    assert sorted(r.id for r in feeds.until_global_boundary(df, F.col("id") == 9, ["s", "pos"]).collect()) == [5, 6, 7]
    assert [r.id for r in feeds.newest_first(df, ["s"], "id").where("s = 'a'").orderBy("pos").collect()] == [7, 6, 5]
    assert sorted(r.id for r in feeds.recent_ids(df, "id", 3).collect()) == [6, 7, 9]


def test_promos_leave_every_section(spark):
    rows = [("x", p, f"x{p}") for p in range(12)] + [("y", 0, "x3"), ("y", 1, "x11"), ("z", 11, "x4")]
    df = spark.createDataFrame(rows, "section string, pos int, norm string")
    assert [tuple(r) for r in feeds.promo_links(df).collect()] == [("x3", 2)]
    assert feeds.without_promos(df).where("norm = 'x3'").count() == 0


def as_dict(df):
    return {(r.outlet_id, r.section): r.link for r in df.collect()}


STATE = "outlet_id string, section string, link string, title string, updated_at string"


def test_state_operators(spark):
    s = spark.createDataFrame([("a", None, "http://x/g", "", ""), ("a", "s1", "http://x/g/", "", ""), ("a", "s2", "http://x/g?y", "", ""), ("a", "s3", "http://x/o", "", ""),
                               ("b", None, "http://x/b", "", ""), ("b", "s1", "", "", "")], STATE)
    assert set(as_dict(state.clear_global_bleed(s))) == {("a", None), ("a", "s3"), ("b", None), ("b", "s1")}
    keys = spark.createDataFrame([("a", "s9"), ("b", "s1"), ("b", "s2")], "outlet_id string, section string")
    moved = as_dict(state.migrate_global(s, keys))
    assert moved[("b", "s1")] == moved[("b", "s2")] == "http://x/b" and ("a", "s9") not in moved
    new = spark.createDataFrame([("a", "s3", "http://x/n", "t"), ("a", "s1", "", "t"), ("b", None, "http://x/c", "t")], "outlet_id string, section string, link string, title string")
    merged = as_dict(state.merge_updates(s, new, F.lit("now")))
    assert merged[("a", "s3")] == "http://x/n" and merged[("a", "s1")] == "http://x/g/" and merged[("b", None)] == "http://x/c"
    assert set(as_dict(state.prune_sections(s, keys))) == {("a", None), ("b", None), ("b", "s1")}
    assert {r.outlet_id: r.bootstrap for r in state.is_bootstrap(s).collect()} == {"a": False, "b": True}
    assert sorted(map(tuple, state.missing_sections(keys, new).collect())) == [("a", "s9"), ("b", "s1"), ("b", "s2")]


def test_sync_global_order(spark):
    s = spark.createDataFrame([("a", "s1", "http://x/article/5", "", ""), ("a", "s2", "http://x/article/9", "", ""), ("b", "s1", "http://x/2026/1/9/a/", "", ""), ("b", "s2", "http://x/2025/12/30/a/", "", ""),
                               ("c", "s2", "http://x/2", "", ""), ("c", "s1", "http://x/1", "", "")], STATE)
    got = {r.outlet_id: r.link for r in state.sync_global(s, ("s2",)).collect()}
    assert got == {"a": "http://x/article/9", "b": "http://x/2026/1/9/a/", "c": "http://x/2"}
    assert {r.outlet_id: r.link for r in state.sync_global(s).collect()}["c"] == "http://x/1"


def test_seed_titles_and_known(spark):
    keys = spark.createDataFrame([("a", "s1"), ("a", "s2")], "outlet_id string, section string")
    s = spark.createDataFrame([("a", "s1", "http://x/old", "", "")], STATE)
    heads = spark.createDataFrame([("a", "s1", "http://x/h1"), ("a", "s2", "http://x/h2")], "outlet_id string, section string, link string")
    assert as_dict(state.seed_from_heads(keys, s, heads)) == {("a", "s1"): "http://x/old", ("a", "s2"): "http://x/h2"}
    side = lambda *rows: spark.createDataFrame(list(rows), "norm string, title string")
    links = spark.createDataFrame([("n1",), ("n2",), ("n3",)], "norm string")
    got = {r.norm: r.title for r in state.checkpoint_title(links, side(("n1", "new")), side(("n1", "own"), ("n2", "own")), side(("n3", ""))).collect()}
    assert got == {"n1": "new", "n2": "own", "n3": ""}
    link = lambda *rows: spark.createDataFrame([(r,) for r in rows], "link string")
    assert sorted(r.norm for r in state.known_links(link("http://x/a/", None), link("http://x/a?y"), link("http://x/b")).collect()) == ["http://x/a", "http://x/b"]


def test_advance_rules(spark):
    feed = spark.createDataFrame([("a", "s1", 0, "h1"), ("a", "s1", 1, "b1"), ("a", "s2", 0, "h2"), ("a", "s3", 0, "h3"), ("a", "s4", 0, "h4")], "outlet_id string, section string, pos int, link string")
    emitted = feed.where("link IN ('h1', 'h2')")
    old = spark.createDataFrame([("a", "s3", "old3"), ("a", "s1", "old1"), ("a", "s9", "old9")], "outlet_id string, section string, checkpoint string")
    go = lambda rule: {k[1]: v for k, v in as_dict(feeds.advance_checkpoint(feed, emitted, old, F.col("link") == "b1", ["outlet_id", "section"], rule)).items()}
    assert go("boundary") == {"s1": "b1", "s2": "h2", "s3": "old3", "s4": "h4", "s9": "old9"}
    assert go("first_new") == {"s1": "h1", "s2": "h2", "s3": "old3", "s9": "old9"}
    assert go("head") == {"s1": "h1", "s2": "h2", "s3": "h3", "s4": "h4", "s9": "old9"}


def test_bronze_rows_and_audit(spark):
    a = spark.createDataFrame([("o", "http://x/a?b", " ", None, " d ", "2026-01-02", "", "RSS"), ("o", " ", "t", "s", None, None, None, None), ("o", "", "t", "s", None, None, None, None), ("p", "HTTP://X/a", "t", "s", "", "Unknown", " i ", None)],
                              "outlet_id string, link string, title string, summary string, description string, date string, image_url string, date_source string").withColumn("outlet_ord", F.expr("if(outlet_id = 'o', 0, 1)")).withColumn("pos", F.lit(0))
    rows = bronze.bronze_rows(a, F.lit("2026-01-05").cast("timestamp"), "run")
    got = {(r.outlet_id, r.url): r for r in rows.collect()}
    first = got[("o", "http://x/a")]
    assert (first.title, first.summary, first.description, first.image_url) == ("(no title)", "d", "d", None) and str(first.published_at) == "2026-01-02 00:00:00"
    assert set(got) == {("o", "http://x/a"), ("o", ":///"), ("p", "http://x/a")} and got[("p", "http://x/a")].published_at is None
    assert [r.outlet_id for r in bronze.first_url_wins(rows).where("url = 'http://x/a'").collect()] == ["o"]
    audit = {r.check_name: r.violations for r in bronze.constraint_audit("bronze", rows, ["title"], ["url"], {"outlet_id": ["o"]}, {"outlet_id": (spark.createDataFrame([("o",)], "id string"), "id")}).collect()}
    assert audit == {"not_null:title": 0, "unique:url": 1, "check:outlet_id": 1, "foreign_key:outlet_id": 1}


def test_hints_feed_rows_and_content(spark):
    links = spark.createDataFrame([("n1", 0, "", None, None, None), ("n2", 7, "own", "d", None, None), ("n3", 0, "t", None, None, None)], "norm string, story_id long, title string, description string, image_url string, at timestamp")
    hints = spark.createDataFrame([("n1", 0, 0, "h", "short", "i", None), ("n1", 0, 1, "h2", "longer text", "i2", None), ("zz", 7, 2, "h3", "x", "i3", None)],
                                  "norm string, story_id long, hint_ord int, title string, list_description string, list_image string, at timestamp")
    got = {r.norm: r for r in bronze.with_hints(links, hints).collect()}
    assert (got["n1"].title, got["n1"].description, got["n2"].title, got["n2"].image_url, got["n3"].date_source) == ("h2", "longer text", "own", "i3", "Incremental scrape")
    feed = spark.createDataFrame([(0, "http://x/a/", "t", "s", "d", "i")], "pos int, link string, title string, summary string, date string, image_url string")
    met = {r.norm: r.refetch for r in bronze.with_feed_rows(spark.createDataFrame([("http://x/a",), ("http://x/b",)], "norm string"), feed).collect()}
    assert met == {"http://x/a": True, "http://x/b": True}
    df = spark.createDataFrame([(" ", "", "x"), ("", " ", None), ("t", None, None)], "t string, s string, d string")
    assert [r[0] for r in df.select(bronze.has_content(F.col("t"), F.col("s"), F.col("d"))).collect()] == [True, False, True]


def test_stories(spark):
    a = spark.createDataFrame([(1, "en", 0, "Rates rise again in June", "x"), (2, "en", 40, "Rates rise again June", "y"), (3, "en", 200, "Rates rise again in June", "z"), (4, "ta", 1, "Rates rise again in June", "z"), (5, "en", 3, "", "x"), (6, "en", 4, "", "y")],
                              "id long, language string, at long, title string, source string")
    pairs = stories.similar_titles(a)
    assert [(r.a, r.b) for r in pairs.collect()] == [(1, 2)]
    merged = {r.story_id: r for r in stories.merged_stories(stories.story_groups(a, pairs).withColumn("base_importance", F.lit(2))).collect()}
    assert merged[1].importance == 3 and merged[1].sources == ["x", "y"] and merged[3].importance == 2
    top = stories.top_stories(spark.createDataFrame([(i, "en", 1) for i in range(9)], "story_id long, language string, importance long"))
    assert sorted(r.story_id for r in top.collect()) == list(range(7))


def test_contracted_edges_don_t_repeat_a_group(spark):
    edges = [(n, hub) for n in range(50, 250) for hub in range(n % 3, 40, 3)] + [(300, 301), (301, 301)]
    few = contracted(spark.createDataFrame(edges, "a long, b long"))
    assert few.count() < 250 + 40 and few.where("a <= b").isEmpty()
    whole = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert whole == {n: n % 3 if n < 40 else next(b for a, b in edges if a == n) for n in [*range(40), *range(50, 250)]} | {300: 300, 301: 300}


def test_components_repeat_no_row_for_a_hub(spark, monkeypatch):
    from feedwright.operators import graph

    plans = []
    written = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, tag: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), written(df, tag))[1])
    edges = [(0, b) for b in range(1, 400)] + [(b, b + 1) for b in range(1000, 1040)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {b: 0 for b in range(400)} | {b: 1000 for b in range(1000, 1041)}
    assert len(plans) > 4 and not [p for p in plans if "Generate" in p]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 50), (50, 70), (70, 70)] + [(200, x) for x in range(300, 360)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(31)) and got[100] == got[70] == 50 and all(got[x] == 200 for x in range(300, 360))


@pytest.mark.parametrize("outlet", [o.id for o in OUTLETS])
def test_every_outlet_runs_and_reruns_without_news(spark, outlet):
    o = BY_ID[outlet]
    rows = [(o.id, f"s{s}", s, p, f"{o.homepage_url}/article/{1000 - 50 * s - p}/1-{1000 - 50 * s - p}", f"title {s} {p}", p != 2) for s in range(2) for p in range(20)]
    feed = spark.createDataFrame(rows, "outlet_id string, section string, section_ord int, pos int, link string, title string, valid boolean")
    none = spark.createDataFrame([], "outlet_id string, section string, link string")
    known = spark.createDataFrame([], "link string")
    first = incremental_run(o, feed, none, known)
    emitted = first.emitted.collect()
    assert len(emitted) == (15 if o.capped == "run" else 30) and all(r.valid for r in emitted)
    if o.key != "composite":
        again = incremental_run(o, feed, first.checkpoints, spark.createDataFrame([(r.link,) for r in emitted], "link string"))
        left = {r.link for r in again.emitted.collect()} & {r.link for r in emitted}
        assert not left
    assert len(incremental_run(o, feed, none, known, bootstrap=True).emitted.collect()) == (5 if o.capped == "run" else 10)


def test_outlets_fail_alone():
    from feedwright.plans.jobs import run_outlets, summary

    def run(o):
        if o.id == "aruna":
            raise ValueError("no page")
        return 3

    out = run_outlets(OUTLETS, run, "lankadeepa")
    ok, failed, code = summary(out)
    assert failed == ["aruna"] and code == 1 and len(ok) == 7 and run_outlets(OUTLETS, run, "nowhere") == []
