import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedwright.llm import common
from feedwright.llm.labelled import fold, labelled_documents, labelled_sample
from feedwright.llm.quality import bradley_terry, features, lexical, score_quality
from feedwright.llm.toxicity import Hits, LabelModel, different, logistic, score_toxicity, spanning_forest


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable"), kind="stable") + 1
    n = y.sum()
    return (order[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def corpus(n, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["ba", "do", "ki", "lu", "me", "no"]) for _ in range(r.randint(1, 4)))
    rows = []
    for i in range(n):
        words, toxic, good = [word() for _ in range(r.randint(20, 80))], int(r.random() < 0.2), int(r.random() < 0.7)
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(["scum", "zorgaft", "zorgein", "zorgung"]))
        if not good:
            words = r.choice([[w + "***" for w in words], words[:1] * 60, [w.upper() + "!!" for w in words]])
        rows.append((i, " ".join(words), toxic, good))
    return rows


@pytest.mark.parametrize("score,column,other,least", [(score_toxicity, "toxic", "quality", 0.95), (score_quality, "quality", "toxic", 0.95)])
def test_held_out_accuracy_and_edge_cases(spark, score, column, other, least):
    rows = corpus(1500, 3)
    docs = spark.createDataFrame([(i, t, 5, "clash") for i, t, *_ in rows] + [(5000, None, 0, ""), (5001, "", 0, ""), (None, "x", 0, ""), (7, rows[7][1], 1, "")],
                                 "doc_id long, text string, score int, y string")
    names = ["doc_id", "toxic", "quality"]
    labels = spark.createDataFrame([(i, t, q) for i, _, t, q in rows[:1200]] + [(1, None, None), (5000, None, 1)], "doc_id long, toxic int, quality int").select(*names)
    got = score(docs, labels, fold("doc_id", 3) != 1).collect()
    assert len(got) == 1504 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    y = np.array([dict(toxic=t, quality=q)[column] for _, _, t, q in rows[1200:]])
    assert auc(y, np.array([by_id[i].score for i, *_ in rows[1200:]])) >= least
    assert by_id[5000].score == by_id[5001].score
    assert len({r.score for r in got if r.doc_id == 7}) == 1


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_without_labels_and_without_rows(spark, score):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert score(docs, labels, F.lit(True)).count() == 2
    assert score(docs.limit(0), labels, F.lit(True)).count() == 0


def test_label_model_finds_the_good_voters_and_the_copies():
    r = np.random.default_rng(1)
    y = r.random(4000) < 0.3
    good = [np.where(r.random(4000) < 0.9, y, ~y) for _ in range(8)]
    noise = [r.random(4000) < 0.5 for _ in range(2)]
    copies = [good[0] ^ (r.random(4000) < 0.02) for _ in range(2)]
    votes = np.stack([np.where(v, 1, 2) for v in (*good, *noise, *copies)], 1)
    model = LabelModel.fit(votes)
    p = model.posterior(votes)
    assert ((p > 0.5) == y).mean() > 0.93
    assert model.weight[0] < model.weight[1] and abs(model.chance[8, 0, 1] - model.chance[8, 1, 1]) < 0.1


def test_near_copies_count_once():
    a = np.arange(16, dtype=np.uint64)
    b = a.copy()
    b[:4] += np.uint64(100)
    assert different(np.stack([a, b, a + np.uint64(1000)])).tolist() == [True, False, True]


def test_labels_both_ways_are_left_out(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 1), (2, None), (3, 0), (None, 1), (4, 7)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", F.lit(True), 100)
    assert sorted(map(tuple, got.collect())) == [(0, "text 0", 1), (3, "text 3", 0)]


def test_bradley_terry_reaches_the_likeliest_weights():
    r = np.random.default_rng(2)
    x = np.c_[r.normal(size=(60, 4)), r.random((60, 1)) < 0.3]
    better, worse = r.integers(0, 60, 400), r.integers(0, 60, 400)
    flip = r.random(400) > 1 / (1 + np.exp(-(x[better] - x[worse]) @ [1, -2, 0, 0.5, 1]))
    better, worse = np.where(flip, worse, better), np.where(flip, better, worse)
    got = bradley_terry(x, better, worse, 1e-3, 3000)
    d, w = x[better] - x[worse], np.zeros(5)
    for _ in range(50):  # Newton's method on the differences
        p = 1 / (1 + np.exp(-d @ w))
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / 400 + 1e-3 * np.eye(5), d.T @ (1 - p) / 400 - 1e-3 * w)
    assert np.abs(got - w).max() < 1e-3


def test_sparse_logistic_reaches_the_likeliest_weights():
    r = np.random.default_rng(3)
    rows = [np.flatnonzero(r.random(6) < 0.3) for _ in range(300)]
    dense = (r.random((300, 2)) < 0.5).astype(float)
    x = np.c_[[[i in row for i in range(6)] for row in rows], dense, np.ones(300)].astype(float)
    y = 1 / (1 + np.exp(-x @ r.normal(size=9)))
    got = logistic(Hits.of(rows, 6), dense, y, np.full(8, 0.5), 4000)
    w, ridge = np.zeros(9), np.r_[np.full(8, 0.5), 0] / 300
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / 300 + np.diag(ridge), x.T @ (p - y) / 300 + ridge * w)
    assert np.abs(got - w).max() < 1e-3


def plain_em(votes, parent, p, prior, steps):
    """The label model row by row: each voter's vote given the class and its parent's vote."""
    n, m = votes.shape
    for _ in range(steps):
        chance, factor = np.zeros((m, 2, 3)), np.zeros((m, 2, 3, 3))
        for j in range(m):
            for y in (0, 1):
                weight = p if y else 1 - p
                for v in range(3):
                    chance[j, y, v] = (weight[votes[:, j] == v].sum() + 0.5) / (weight.sum() + 1.5)
                for u in range(3):
                    above = np.array([(votes[i, parent[j]] if parent[j] >= 0 else 0) == u for i in range(n)])
                    for v in range(3):
                        factor[j, y, u, v] = (weight[above & (votes[:, j] == v)].sum() + 2 * chance[j, y, v]) / (weight[above].sum() + 2)
        new = np.zeros(n)
        for i in range(n):
            like = [1 - prior, prior]
            for j in range(m):
                u = votes[i, parent[j]] if parent[j] >= 0 else 0
                like = [like[y] * factor[j, y, u, votes[i, j]] for y in (0, 1)]
            new[i] = like[1] / sum(like)
        p = new
    return p


def test_label_model_equals_plain_expectation_maximisation():
    r = np.random.default_rng(4)
    y = r.random(300) < 0.4
    voters = [np.where(r.random(300) < 0.8, np.where(y, 1, 2), np.where(y, 2, 1)) for _ in range(5)]
    voters += [np.where(r.random(300) < 0.95, voters[0], 0), np.where(y & (r.random(300) < 0.5), 1, 0)]
    votes = np.stack(voters, 1)
    model = LabelModel.fit(votes, 0.4, steps=4)
    assert model.parent[5] == 0 and (model.parent[:5] == -1).all()
    signed = np.where(votes == 2, -1, votes)
    start = np.clip(0.5 + 0.45 * np.sign(signed @ model.weight), 0.05, 0.95)
    assert np.abs(model.posterior(votes) - plain_em(votes, model.parent, start, 0.4, 4)).max() < 1e-9


def test_forest_takes_the_strongest_dependences():
    beyond = np.zeros((5, 5))
    for a, b, w in [(0, 1, 0.5), (1, 2, 0.4), (0, 2, 0.3), (3, 4, 0.2)]:
        beyond[a, b] = beyond[b, a] = w
    assert spanning_forest(beyond).tolist() == [-1, 0, 1, -1, 3]


def test_lexical_shares(spark):
    import pyarrow as pa

    x = lexical(pa.array(["a b a", None, "", "abcde", "abcd" * 50_000]))
    assert x.shape == (5, 1024) and not x[1:3].any()
    assert np.allclose(np.sort(x[0, :512] ** 2)[-2:], [1 / 3, 2 / 3]) and np.allclose((x[3:] ** 2).sum(1), 2)


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_a_very_long_text_and_ties(spark, score):
    rows = corpus(300, 5)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows] + [(1000, "word scum " * 300_000), (1001, "word scum " * 300_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, q) for i, _, t, q in rows], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r.score for r in score(docs, labels, F.lit(True)).collect()}
    assert len(got) == 302 and got[1000] == got[1001]


def test_quality_learns_from_every_labelled_document(spark, monkeypatch):
    """More labelled documents than the old bound, in parts, and each of them is in a pair."""
    from feedwright.llm import quality

    monkeypatch.setattr(quality, "PART_ROWS", 2500)
    rows = [(i, f"plain words number {i % 7}" if i % 2 else f"other words number {i % 7}", i % 2) for i in range(10_000)]
    docs, labels = (spark.createDataFrame([(r[0], r[k]) for r in rows], t).repartition(3) for k, t in ((1, "doc_id long, text string"), (2, "doc_id long, y int")))
    learnt = labelled_documents(docs, labels, "y", F.lit(True))
    assert learnt.count() == 10_000
    paired = []
    for y in ([0] * 9 + [1], [1] * 50 + [0] * 3, [0, 1]):
        better, worse = quality.pairs_of(np.array(y))
        paired.append(set(better) | set(worse) == set(range(len(y))))
    assert all(paired)
    model = quality.train(learnt, 0.3)
    assert model.weights.any() and [round(float(s), 3) >= 0.3 for s in model.score(quality.features(pa.array([rows[1][1], rows[2][1]])), quality.lexical(pa.array([rows[1][1], rows[2][1]])))] == [True, False]


def test_quality_joins_labels_by_features_and_shuffles_no_text(spark, monkeypatch):
    """Labels meet features in their part; labels without a document leave no part without a class."""
    from feedwright.llm import quality

    plans, made = [], quality.materialize
    monkeypatch.setattr(quality, "PART_ROWS", 8)
    monkeypatch.setattr(quality, "PART_LEAST", 1)
    monkeypatch.setattr(quality, "materialize", lambda df, tag: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), made(df, tag))[1])
    packed, pack = [], quality._packed
    monkeypatch.setattr(quality, "_packed", lambda *a: packed.append(pack(*a)) or packed[0])
    monkeypatch.setattr(quality, "discard", lambda df: None)
    docs = spark.createDataFrame([(i, f"{'plain' if i % 2 else 'other'} words number {i % 7}") for i in range(60)] + [(7, "a second text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(i, 1) for i in range(1000, 1100)] + [(5, 0)], "doc_id long, quality int")
    scores = {r.doc_id: r.predicted for r in score_quality(docs, labels, F.lit(True)).where("doc_id >= 40").collect()}
    assert scores == {i: i % 2 for i in range(40, 60)}
    ys = [np.frombuffer(r.y, np.int8) for r in packed[0].collect()]
    assert sum(len(y) for y in ys) == 40 and sum(int(y.sum()) for y in ys) == 20  # 5 is labelled both ways, 7 has two texts
    assert all(0 < y.sum() < len(y) for y in ys)
    assert max(p.count("Join ") for p in plans) == 1 and any("FlatMapCoGroups" in p for p in plans)  # the one is the filter's


def test_long_rows_come_in_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["b"])

    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"))
    labels = spark.range(4).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert score_quality(docs.where("doc_id < 4"), labels, F.lit(True)).count() == 4
    told = [r.b for r in docs.mapInArrow(sizes, "b long").collect()]  # 30 MB
    assert max(told) < 1.1 * common.BATCH_BYTES and sum(told) > 30_000_000


def test_features_of_many_texts_take_bounded_memory():
    batch = pa.RecordBatch.from_arrays([pa.array(["some plain words. " * 100] * 2000)], ["text"])  # 3.6 MB
    tracemalloc.start()
    for part in common.text_slices(iter([batch]), "text", common.SMALL_SLICE_BYTES):
        features(part.column(0))
        lexical(part.column(0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
