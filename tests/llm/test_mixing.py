import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedwright.llm.mixing import mix_sources, mixed_documents, mixture


def corpus(n=400, seed=1):
    r = random.Random(seed)
    rows = [(i, "w " * r.randint(0, 60), r.choices(["hot", "b", "c", None, "rare"], [60, 20, 10, 8, 2])[0]) for i in range(n)]
    return rows + [(n, None, "void"), (n + 1, "", "void"), (5, rows[5][1], rows[5][2])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"tokens": F.lit("clash"), "whole": F.lit(9), "row": F.lit(0), "place": F.lit(1)}
    )


def tokens_of(rows):
    out = Counter()
    for _, t, s in rows:
        out[s] += len((t or "").split())
    return out


def test_repeat_limit_is_met_and_every_document_is_used(spark):
    rows = corpus()
    total = tokens_of(rows)
    used = mix_sources(frame(spark, rows), max_repeats=1.5, block_tokens=1000).collect()
    assert {r.doc_id for r in used} == {r[0] for r in rows}
    spent = Counter()
    for r in used:
        spent[r.source] += r.n_tokens
    repeats = {s: spent[s] / total[s] for s in total if total[s]}
    assert min(repeats.values()) >= 1 and max(repeats.values()) <= 1.5 + 60 / total["rare"]
    assert repeats["hot"] == 1 and repeats["rare"] >= 1.5 - 60 / total["rare"]


def brute_force_exponent(total, test):
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        z = sum((t / sum(total.values())) ** mid for t in total.values())
        w = {s: (t / sum(total.values())) ** mid / z for s, t in total.items()}
        low, high = (low, mid) if test(w) else (mid, high)
    return high


@pytest.mark.parametrize("kind", ["repeats", "entropy", "budget"])
def test_exponent_equals_plain_bisection(spark, kind):
    rows = [r for r in corpus() if r[2] != "void"]
    total = tokens_of(rows)
    df = frame(spark, rows).select("source", F.size(F.filter(F.split("text", " "), lambda x: x != "")).cast("long").alias("tokens"))
    if kind == "repeats":
        got = mixture(df, max_repeats=1.5)
        want = brute_force_exponent(total, lambda w: max(max(total[s] / w[s] for s in w) * w[s] / total[s] for s in w) <= 1.5)
    elif kind == "entropy":
        got = mixture(df, entropy=0.8)
        want = brute_force_exponent(total, lambda w: -sum(x * math.log(x) for x in w.values()) <= 0.8 * math.log(len(w)))
    else:
        got = mixture(df, budget=float(sum(total.values())), max_repeats=2.0)
        want = brute_force_exponent(total, lambda w: max(sum(total.values()) * w[s] / total[s] for s in w) <= 2.0)
    assert abs(got.exponent - want) < 1e-8


def test_a_pass_of_the_bisection_is_one_small_plan(spark):
    told = spark._jsparkSession.sharedState().statusStore()
    seen = lambda: (spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(), told.executionsCount())[1]
    df = spark.createDataFrame([("a", 5), ("b", 900), ("c", 40)], "source string, tokens long")
    before = seen()
    assert 0 < mixture(df).exponent < 1
    assert seen() - before <= 8 + 6


def test_blocks_hold_the_sources_by_weight(spark):
    rows = [(i, "w " * 10, "a" if i % 4 else "b") for i in range(4000)]
    used = mix_sources(frame(spark, rows), budget=40000.0, max_repeats=1.0, block_tokens=4000).collect()
    blocks = defaultdict(Counter)
    for r in used:
        blocks[r.block][r.source] += r.n_tokens
    assert sorted(blocks) == list(range(10)) and all(b == {"a": 3000, "b": 1000} for b in blocks.values())


def test_documents_come_as_often_as_the_plan_says(spark):
    rows = corpus()
    df = frame(spark, rows)
    want = Counter(r.doc_id for r in mix_sources(df).collect())
    got = mixed_documents(df)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == want


def test_empty_table_and_no_tokens(spark):
    assert mix_sources(frame(spark, [])).count() == 0
    assert mixed_documents(frame(spark, [])).count() == 0
    assert [tuple(r) for r in mix_sources(frame(spark, [(1, None, None)])).drop("place").collect()] == [(1, None, 0, 0, 0)]


def test_rows_equal_plain_permutations(spark):
    """Every use, its block and its order, from the mixture's weights and the places alone."""
    rows = [r for r in corpus() if r[2] != "void"]
    df = frame(spark, rows)
    got = mix_sources(df, max_repeats=1.5, block_tokens=700).collect()
    mixed = mixture(df.select("source", F.size(F.filter(F.split("text", " "), lambda x: x != "")).cast("long").alias("tokens")), max_repeats=1.5)
    told = {r.source: r for r in mixed.sources.collect()}
    place = {(r.doc_id, r.epoch): r.place % 2**64 for r in got}
    want = Counter()
    for s, t in told.items():
        own = [(i, len((x or "").split())) for i, x, of in rows if of == s]
        for epoch in range(t.whole + (t.rest > 0)):
            ahead = 0
            known = [d for d in own if (d[0], epoch) in place]
            for i, n in sorted(known, key=lambda d: (place[d[0], epoch], d[0])):
                if epoch < t.whole or ahead < t.rest:
                    want[i, epoch, int((epoch * t.tokens + ahead) / (t.weight * 700)), n] += 1
                ahead += n
            assert epoch >= t.whole or len(known) == len(own)
            assert epoch < t.whole or ahead >= t.rest
    assert Counter((r.doc_id, r.epoch, r.block, r.n_tokens) for r in got) == want


def test_documents_come_in_the_order_of_the_mixture(spark):
    rows = [(i, "w " * 10, "big" if i % 5 else "small") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4, "source")
    out = [r.source for r in mixed_documents(df, max_repeats=1.5).collect()]
    share = out.count("small") / len(out)
    for at in range(0, len(out) - 400, 400):
        assert abs(out[at : at + 400].count("small") / 400 - share) < 0.1


def test_documents_keep_columns_and_rows(spark):
    df = frame(spark, corpus(40)).drop("tokens")
    out = mixed_documents(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {r.doc_id for r in df.collect()}
    assert mixed_documents(df.limit(0)).count() == 0


def odd_corpus():
    """Rows without id, rows of one id, and rows repeated whole, all of many texts and lengths."""
    r = random.Random(3)
    rows = [(None, "w " * r.randint(1, 30), "a") for _ in range(120)] + [(7, "w " * r.randint(1, 30), "b") for _ in range(60)]
    return rows + [(8, "w w w", "b")] * 70 + [(None, "w w", "c")] * 25 + [(i, "x " * r.randint(0, 9), r.choice("abc")) for i in range(40)] + [(9, "long " * 50_000, "a")]


def test_result_does_not_depend_on_the_partitioning(spark, monkeypatch):
    from feedwright.llm import mixing

    rows, seen, documents = odd_corpus(), set(), set()
    for parts, copies in ((1, 10_000), (5, 1)):
        monkeypatch.setattr(mixing, "TASK_COPIES", copies)
        random.Random(parts).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        used = [tuple(r) for r in mix_sources(df, block_tokens=500).select("doc_id", "source", "epoch", "block", "place", "n_tokens").collect()]
        seen.add(tuple(sorted(used, key=repr)))
        out = Counter(tuple(r) for r in mixed_documents(df).collect())
        documents.add(tuple(sorted(out.items(), key=repr)))
        assert Counter((d, n) for d, *_, n in used) == sum((Counter({(d, len(t.split())): n}) for (d, t, _), n in out.items()), Counter())
    assert len(seen) == 1 and len(documents) == 1


def test_rows_without_id_do_not_crowd_a_place(spark):
    df = spark.createDataFrame([(None, f"text {i}", "a") for i in range(800)], "doc_id long, text string, source string")
    used = mix_sources(df).where("epoch = 0")
    assert used.select("place").distinct().count() == 800
    assert used.groupBy(F.shiftrightunsigned("place", 56)).count().agg(F.max("count")).first()[0] < 100
