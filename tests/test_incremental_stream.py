"""Runs as a stream against runs as batches; the fold against a plain loop."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedwright.operators import feeds
from feedwright.plans.jobs import incremental_run
from feedwright.sources import registry
from feedwright.streaming import incremental, stream

LISTS = "outlet_id string, run long, section string, section_ord int, pos int, link string, title string, valid boolean"
OUTLETS = [registry.BY_ID[o] for o in ("aruna", "sundaytimes", "economynext")]


@pytest.fixture(scope="module", autouse=True)
def store(spark):
    names = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled")
    was = {name: spark.conf.get(name) for name in names}
    incremental.stateful(spark)
    yield
    for name, value in was.items():
        spark.conf.set(name, value)


def lists_of(run, rng):
    """Newest-first lists of each outlet; a later run has newer links on top, and some sections share links."""
    out = []
    for o in OUTLETS:
        for so, section in enumerate(("a", "b", None)):
            newest = 100 + 9 * run + int(rng.integers(0, 7))
            for pos, n in enumerate(range(newest, newest - 20, -1)):
                n += 500 * so * (n % 3 > 0)  # a third of the links stand in all sections
                link = {"dailymirror": f"https://www.dailymirror.lk/news/story-{n}/108-{n}", "virakesari": f"https://www.virakesari.lk/article/{n}", "economynext": f"https://economynext.com/s-{n}" if n % 4 else f"https://else.example/{n}?r={run}"}.get(o.id, f"{o.homepage_url}/{n}/?r={run}")
                out.append((o.id, run, section, so, pos + 100 * so * (o.capped == "run"), link if n % 19 else None, f"Title {n}", [True, True, True, False, None][n % 5]))
    return out


def by_batches(spark, runs, outlet, checkpoints, known):
    emitted = []
    for rows in runs:
        feed = spark.createDataFrame([r for r in rows if r[0] == outlet.id], LISTS)
        cp = spark.createDataFrame(checkpoints, "outlet_id string, section string, link string, title string")
        got = incremental_run(outlet, feed.drop("run"), cp, spark.createDataFrame(known, "link string, title string"))
        new = got.emitted.select("section", "pos", "link", "title").collect()
        emitted += [(outlet.id, rows[0][1], *r) for r in new]
        known = known + [(r.link, r.title) for r in new]
        titles = {r[5]: r[6] for r in rows} | {c[2]: c[3] for c in checkpoints}
        checkpoints = [(r.outlet_id, r.section, r.link, titles.get(r.link)) for r in got.checkpoints.collect()]
    return emitted


def test_three_runs_emit_what_three_batches_do(spark, tmp_path):
    rng = np.random.Generator(np.random.PCG64(12))
    runs = [lists_of(r, rng) for r in range(3)]
    known = [("https://www.aruna.lk/98/", "Title 98"), ("https://www.sundaytimes.lk/101", "Title 101")]
    checkpoints = [("aruna", "a", "https://www.aruna.lk/95", "Title 95"), ("economynext", "a", "https://old.example/7", "title 96 - EconomyNext")]
    start = incremental.initial_state(OUTLETS, spark.createDataFrame(checkpoints, "outlet_id string, section string, link string, title string"),
                                      spark.createDataFrame([(o, *k) for o, k in zip(("aruna", "sundaytimes"), known, strict=True)], "outlet_id string, link string, title string"))
    got = []
    (tmp_path / "in").mkdir()
    for i, rows in enumerate(runs):  # a micro-batch each; the last one also comes as two files
        for k, part in enumerate((rows,) if i < 2 else (rows[::2], rows[1::2])):
            lines = [json.dumps(dict(zip([c.split()[0] for c in LISTS.split(", ")], r, strict=True))) for r in part]
            (tmp_path / f"in/{i}-{k}.json").write_text("\n".join(lines))
        lists = spark.readStream.schema(LISTS).json(f"{tmp_path}/in")
        out = incremental.incremental_stream(lists, OUTLETS, start)
        query = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
        stream.run_once(spark, query)
    got = sorted(map(repr, map(tuple, spark.read.parquet(f"{tmp_path}/out").select("outlet_id", "run", "section", "pos", "link", "title").collect())))
    want = []
    for o in OUTLETS:
        want += by_batches(spark, runs, o, [c for c in checkpoints if c[0] == o.id], [known[0]] if o.id == "aruna" else [known[1]] if o.id == "sundaytimes" else [])
    assert got == sorted(map(repr, want)) and len({w[1] for w in want}) == 3


def plain_fold(rows, limit):
    out, seen, at, n, stop = [], set(), None, 0, False
    for so, pos, norm, boundary, valid in sorted(rows, key=lambda r: (r[0], r[1])):
        if so != at:
            at, n, stop = so, 0, False
        if stop or n >= limit:
            continue
        if boundary:
            stop = True
        elif valid and norm is not None and norm not in seen:
            seen.add(norm)
            out.append((so, pos, norm))
            n += 1
    return out


def test_fold_equals_the_loop_on_bounded_rows(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    rows, limit = [], 3
    for outlet in range(40):
        for so in range(5):
            for pos in range(int(rng.integers(0, 120))):
                rows.append((None if outlet == 7 else outlet, so, pos, None if rng.random() < 0.05 else f"l{rng.integers(0, 40)}", [None, True, False][int(rng.choice(3, p=[0.3, 0.01, 0.69]))], [None, True, False][int(rng.choice(3, p=[0.1, 0.8, 0.1]))]))
    df = spark.createDataFrame(rows, "outlet_id int, section_ord int, pos int, norm string, boundary boolean, valid boolean").repartition(5)
    got = {}
    for r in feeds.emit_fold(df, limit).collect():
        got.setdefault(r.outlet_id, []).append((r.section_ord, r.pos, r.norm))
    outlets = {r[0] for r in rows}
    assert {o: sorted(got.get(o, [])) for o in outlets} == {o: plain_fold([r[1:] for r in rows if r[0] == o], limit) for o in outlets}
    most = feeds.fold_candidates(df, limit).groupBy("outlet_id").count().agg(F.max("count")).first()[0]
    assert most <= limit * 5 * 6 / 2


def test_null_sections_meet_their_boundaries(spark):
    feed = spark.createDataFrame([(None, 0), (None, 1), (None, 2), ("s", 0), ("s", 1)], "section string, pos int")
    got = feeds.until_boundary(feed, (F.col("pos") == 1), ["section"]).collect()
    assert sorted((str(r.section), r.pos) for r in got) == [("None", 0), ("s", 0)]


def test_numbers_below_the_checkpoints_stop_a_list_and_no_number_never_does():
    row = lambda n: incremental._Row("a", 0, 0, f"l{n}", "t", True, str(n) if n else "l0", n, None)
    at = {"a": incremental.Checkpoint("l7", "7", 7, None)}
    got, changed = incremental.one_run([row(9), row(0), row(8), row(6), row(10)], at, lambda norm: norm == "l0", incremental.Rules(True, False, "head"), 15)
    assert [r.number for r in got] == [9, 0, 8] and changed["a"].number == 9


def test_forgotten_links_are_new_again():
    """A link is known only while it was emitted and not forgotten; checkpoints do not expire."""
    row = lambda n, **k: incremental._Row("a", 0, n, f"l{n}", "t", True, f"l{n}", None, None, **k)
    rules = incremental.Rules(True, False, "head")
    first, changed = incremental.one_run([row(0), row(1)], {}, lambda _: False, rules, 15)
    assert [r.link for r in first] == ["l0", "l1"] and changed["a"].link == "l0"
    again, _ = incremental.one_run([row(0), row(1)], changed, lambda _: False, rules, 15)
    assert again == []


def test_state_is_asked_for_by_parts_not_by_links():
    """Runs of many links and sections call the store at most once for each part and way."""
    class Store(dict):
        calls = 0

        def getValue(self, key):
            Store.calls += 1
            return self.get(key)

        containsKey = getValue

        def updateValue(self, key, value):
            Store.calls += 1
            self[key] = value

        def iterator(self):
            return iter(self.items())

    class Now:
        def __init__(self, at):
            self.at = at

        def getCurrentProcessingTimeInMs(self):
            return self.at

    import pandas as pd

    runs = incremental.OutletRuns({"o": incremental.Rules(True, False, "first_new")}, 15, 90)
    runs.checkpoints, runs.known = Store(), Store()

    def emitted(run, newest, day):
        rows = [(run, s, so, pos, f"{s}/{newest - pos}", None, True, f"{s}/{newest - pos}", None, None) for so, s in enumerate([None, *(f"s{i}" for i in range(299))]) for pos in range(20)]
        frame = pd.DataFrame(rows, columns=["run", "section", "section_ord", "pos", "link", "title", "valid", "norm", "number", "said"])
        return len(pd.concat(runs.handleInputRows(("o",), iter([frame[:2500], frame[2500:]]), Now(day * 86_400_000))))

    assert [emitted(0, 100, 0), emitted(1, 103, 1), emitted(2, 103, 2)] == [300 * 15, 300 * 3, 0]
    assert Store.calls <= 3 * 4 * incremental.PARTS
    runs.checkpoints.clear()
    assert emitted(3, 103, 91) == 0 and emitted(4, 103, 200) == 300 * 15  # listed on day 91, forgotten by day 200
