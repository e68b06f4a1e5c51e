import math
import random

import pytest

from feedwright.llm.topk_search import quantised, top_k


def brute_force(rows, k, is_query):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if is_query(q):
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def corpus(seed, n=300):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(8)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(15)]  # ties
    return rows + [(900, None), (901, [1.0, None] + [0.0] * 6), (902, [float("nan")] * 8), (903, [float("inf")] + [0.0] * 7), (None, [0.1] * 8), (910, [0.5, -0.5]), (920, [0.25, 0.75]), (930, []), (940, [0.0] * 8)]


@pytest.mark.parametrize("pivots,query_block,candidate_block", [(32, 2048, 8192), (1, 7, 50), (4, 3, 10_000)])
def test_equals_brute_force(spark, pivots, query_block, candidate_block):
    rows = corpus(pivots)
    df = spark.createDataFrame([(i, v, "clash", 0) for i, v in rows], "vec_id long, embedding array<double>, v string, dim int")
    v = quantised(df, "vec_id", "embedding")
    got = top_k(v.where("vec_id % 10 = 0"), v, 10, pivots, query_block, candidate_block).collect()
    assert sorted(map(tuple, got)) == brute_force(rows, 10, lambda q: q % 10 == 0)


def test_repeated_query_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    v = quantised(df, "vec_id", "embedding")
    assert [tuple(r) for r in top_k(v.where("vec_id = 0"), v).collect()] == [(0, 1, 1, 1024 * 512)]
    assert top_k(v.limit(0), v).count() == 0 and top_k(v.limit(0), v.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    r = random.Random(6)
    rows = [(0, [10**9 + 1, 3]), (1, [10**9 + 1, 5]), (2, [10**9 + 1, 6]), (3, [-(10**9), 7])]
    rows += [(i, [r.choice([10**6, 10**9]) * r.randint(-9, 9) + r.randint(0, 3) for _ in range(2)]) for i in range(4, 200)]
    rows += [(200, [2**62, 2**62]), (201, [2**62 - 1, 2**62]), (202, [-(2**62), -(2**62)])]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = sorted(map(tuple, top_k(v.where("vec_id % 5 = 0"), v, 7, 16, 8, 32).collect()))
    want = []
    for q, a in rows:
        if q % 5 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)
            want += [(q, n + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, i) in enumerate(found[:7])]
    assert got == sorted(want)


def test_bounds_leave_most_candidates_out_where_vectors_lie_in_groups(spark):
    r = random.Random(7)
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(40)]
    centres = [[x / math.sqrt(sum(y * y for y in c)) for x in c] for c in centres]
    rows = [(i, [x + r.gauss(0, 0.03) for x in centres[i % 40]]) for i in range(2000)]
    v = quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    report = {}
    got = top_k(v.where("vec_id % 100 = 0"), v, 10, 64, 8, 256, report).collect()
    assert sorted(map(tuple, got)) == brute_force(rows, 10, lambda q: q % 100 == 0)
    assert report["pairs"] == 20 * 2000 and report["evaluated"] < 0.2 * report["pairs"]
