import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from feedwright.llm.substring_dedup import substring_dedup


def brute_force(texts, window):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: r.choice(["alpha", "béta", "γ", "d", "ee", "fff", "ж", " x"]) + str(r.randint(0, 40))
    phrases = [[word() for _ in range(r.randint(5, 120))] for _ in range(6)]
    texts = [None, "", " \t\n", "solo", "x " * 200, "x " * 34, "a b " * 60]
    for _ in range(n):
        words = []
        for _ in range(r.randint(0, 6)):
            p = r.choice(phrases)
            a = r.randint(0, len(p) - 1)
            words += r.choice([p, p[a:], p[:a], [word() for _ in range(r.randint(1, 50))]])
        texts.append(r.choice(["", "\n"]) + "".join(w + r.choice([" ", "\n", "\t ", "  "]) for w in words))
    return texts + texts[10:14]


@pytest.mark.parametrize("window,anchor", [(35, 12), (8, 3)])
def test_equals_brute_force(spark, window, anchor):
    texts = corpus(window)
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(texts)], "doc_id long, text string, words string, n long")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df.repartition(5), window, anchor).collect()}
    assert got == dict(enumerate(brute_force(texts, window)))


def test_bloom_filter_too_small_changes_nothing(spark):
    texts = corpus(5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r[1:4] for r in substring_dedup(df, 8, 3, max_filter_bits=1).collect()}
    assert got == dict(enumerate(brute_force(texts, 8)))


@pytest.mark.parametrize("how", [{"hash_bits": 2}, {"hot_places": 2}, {"hot_places": 3, "hash_bits": 4, "max_filter_bits": 1}])
def test_words_decide_and_frequent_anchors_change_nothing(spark, how):
    """With window hashes of two bits nearly all is compiled: only the automaton's matches tell what recurs."""
    texts = corpus(11)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r[1:4] for r in substring_dedup(df, 8, 3, **how).collect()}
    assert got == dict(enumerate(brute_force(texts, 8)))


def test_a_shard_without_matches_covers_nothing(monkeypatch):
    from feedwright.llm import substring_dedup as sd

    one, two = b" ".join(b"w%d" % i for i in range(9)), b" ".join(b"v%d" % i for i in range(9))
    many = np.array([False, False, False])
    assert [g.sum() for g in sd.covered_words([one, two, one], many, 8, 1)] == [9, 0, 9]
    assert [g.sum() for g in sd.covered_words([one, two], many[:2], 8, 1)] == [0, 0]
    assert [g.sum() for g in sd.covered_words([one], np.array([True]), 8)] == [9]


def test_a_very_long_text(spark):
    r = random.Random(2)
    long = " ".join(str(r.randint(0, 10**6)) for _ in range(150_000))
    texts = [long + " " + long[:5000], "x " + long[300_000:300_400], "head"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r[1:4] for r in substring_dedup(df).collect()}
    assert got == dict(enumerate(brute_force(texts, 35)))


def test_null_ids_and_repeated_rows(spark):
    long = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(None, "a b"), (1, long), (1, long)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in substring_dedup(df).collect())
    assert got == [(-1, 0), (1, 50), (1, 50)]


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
