import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedwright.llm import divergence
from feedwright.llm.divergence import scaled, source_divergence

SCHEMA = "lang string, source string, text string"


def plain(rows, min_docs):
    """The contract, by Python's own integers."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in count}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (g, s), c in count.items() if g == lang}
        whole = sum(groups.values(), Counter())

        def p(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        of, q = {s: p(c) for s, c in groups.items()}, p(whole)
        for s in groups:
            pairs = [(sum(f(of[s][t], of[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(of[s][t], q[t]), t) for t in kept if groups[s][t] and of[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, i, v, r) for r, (v, i) in enumerate(items, 1) if part == "pair" or r <= 10}
    return out


def run(df, **kw):
    rows = [tuple(r) for r in source_divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.Generator(np.random.PCG64(5))
    words = ["Été", "été", "the", "THE", "Of", "x_y", "don't", "naïve", "中文", "a1b", "Ärger", "ärger", *(f"w{chr(97 + i)}" for i in range(20))]
    out = []
    for _ in range(150):
        k = int(rng.integers(0, 40))
        out.append((str(rng.choice(["en", "de"])), f"s{rng.integers(0, 5)}", " ".join(rng.choice(words, k))))
    hot = [("en", "s0", "hot words here the of")] * 90
    odd = [(None, None, None), ("", "s1", ""), ("zz", None, "only one"), ("zz", "q", None), ("en", "silent", "123 --- 456"), ("en", "s1", "w" * 300_000), ("en", "s9", "the " * 5000)]
    return out + hot + odd


def test_equals_plain_version(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert run(df, min_docs=3) == plain(rows, 3)
    assert run(df) == plain(rows, 10)


def test_small_tiles_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "COUNT_BYTES", 500)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert run(df, min_docs=3, terms_per_block=4, groups_per_tile=2) == plain(rows, 3)


def test_empty_table_and_other_columns(spark, rows):
    assert run(spark.createDataFrame([], SCHEMA)) == set()
    df = spark.createDataFrame(rows, SCHEMA)
    named = df.withColumns({c: F.lit("x") for c in ("term", "n", "docs", "block", "side", "a", "b", "v", "s", "part", "item", "value", "rank")})
    assert run(named, min_docs=3) == plain(rows, 3)


def test_repeated_rows_count_each(spark):
    rows = [("en", "a", "one two")] * 10 + [("en", "b", "two two")]
    assert run(spark.createDataFrame(rows, SCHEMA)) == plain(rows, 10)


def test_scaling_is_exact():
    for c, n in [(1, 3), (10**16 + 7, 10**17 + 9), (5 * 10**17, 8 * 10**17 + 1), (2 * 10**18 + 3, 9 * 10**18 + 1), (7, 7)]:
        assert scaled(np.array([c]), np.array([n])).tolist() == [1 + 10**9 * c // n]
