import random
import re
from fractions import Fraction

import numpy as np
import pytest

from feedwright.llm import jaccard_join as jj
from feedwright.llm.jaccard_join import documents_without_near_copies, jaccard_join


def brute_force(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    n = len(rows)
    near = [[j for j in range(n) if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in near[i]:
                if label[j] < label[i]:
                    label[i], changed = label[j], True
    low = {}
    for i in range(n):
        low[label[i]] = min(low.get(label[i], rows[i][0]), rows[i][0])
    return {rows[i][0]: (low[label[i]], len(near[i])) for i in range(n)}


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh é") for _ in range(r.randint(1, 6))).replace(" ", "z")
    rows = [None, "", " \n", "a b", "a  b", "a b c d e", "a b c d"]
    for _ in range(25):
        base = [word() for _ in range(r.choice([6, 30, 120, 400]))]
        for _ in range(r.randint(1, 6)):
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 5])):
                w[r.randrange(len(w))] = word()
            rows.append(" ".join(w))
    r.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(i, t, 1, "x", b"y") for i, t in rows], "doc_id long, text string, n long, h1 string, labels binary")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(df.repartition(3)).collect()}
    assert got == brute_force(rows)


def test_blocks_give_the_same(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(jj, "BLOCK_DOCUMENTS", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(df).collect()}
    assert got == brute_force(rows)


def test_shortened_paths_find_what_long_ones_miss(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(df, recall=2.0).collect()}
    assert got == brute_force(rows)


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x"), (None, "x")], "doc_id long, text string")
    got = sorted((r.doc_id or 9, r.class_id, r.n_links, r.kept) for r in jaccard_join(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 2, 1, True), (9, 2, 1, False)]
    assert sorted(r.text for r in documents_without_near_copies(df).collect()) == ["a b c d e f", "x"]


def test_rows_of_one_id_with_different_texts(spark):
    one, two = " ".join("abcdefgh"), " ".join("pqrstuvw")
    rows = [(0, one, "l"), (1, one, "m"), (1, two, "n"), (None, "y", "o"), (None, "y", "p"), (None, None, "q"), (4, "", "r"), (4, "   ", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, own string").repartition(3)
    got = sorted((r.doc_id if r.doc_id is not None else 9, r.class_id if r.class_id is not None else 9, r.n_links, r.kept) for r in jaccard_join(df).collect())
    # Which of the two rows of id 4 stays is settled by a hash.
    assert [g[:3] for g in got] == [(0, 0, 1), (1, 0, 1), (1, 1, 0), (4, 4, 2), (4, 4, 2), (9, 4, 2), (9, 9, 1), (9, 9, 1)]
    assert sum(k for *_, k in got if _[0] == 4) == 1
    left = documents_without_near_copies(df)
    assert left.columns == df.columns
    left = left.collect()
    assert sorted((r.doc_id if r.doc_id is not None else 9, (r.text or "").strip()) for r in left) == [(0, one), (1, two), (4, ""), (9, "y")]
    assert documents_without_near_copies(df.limit(0)).count() == 0


def test_a_crowd_is_cut_by_sizes(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_DOCUMENTS", 3)
    r = random.Random(8)
    base = [str(r.randint(0, 10**6)) for _ in range(300)]
    rows = [(i, " ".join(base[: 300 - 8 * i])) for i in range(28)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(df).collect()}
    assert got == brute_force(rows)


def test_a_very_long_text(spark):
    r = random.Random(5)
    base = [str(r.randint(0, 10**6)) for _ in range(120_000)]
    rows = [(0, " ".join(base)), (1, " ".join(base[:60_000] + ["new"] + base[60_000:])), (2, " ".join(base[:80_000]))]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: (0, 1), 1: (0, 1), 2: (2, 0)}


def test_empty_table(spark):
    assert jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9])
def test_collision_rate_of_signatures(similarity):
    r = np.random.default_rng(4)
    multiply, flip = jj._functions(160)
    rate = []
    for _ in range(60):
        union = r.integers(0, 2**63, 300).astype(np.uint64)
        shared, rest = int(300 * similarity), 300 - int(300 * similarity)
        a, b = union[: shared + rest // 2], np.concatenate([union[:shared], union[shared + rest // 2 :]])
        rate.append((jj.signature(a, multiply, flip) == jj.signature(b, multiply, flip)).mean())
    assert abs(np.mean(rate) - similarity) < 0.02


def test_both_ways_of_intersecting_agree():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 300, 80).astype(np.uint64)) for _ in range(30)]
    wanted = np.ones((30, 30), bool)
    dense = jj.intersections(sets, sets, wanted)
    assert all(dense[i, j] == len(np.intersect1d(sets[i], sets[j])) == jj._merged(sets[i], sets[j]) for i in range(30) for j in range(30))
    assert jj.chance(0.8, jj.deepest(0.8, 20, 0.97), 20) >= 0.97
    assert Fraction("0.8") == Fraction(4, 5)
