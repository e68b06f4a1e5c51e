import hashlib
import random
from collections import defaultdict

import pytest

from feedwright.llm.exact_dedup import exact_dedup


def brute_force(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        keep = max((x for x in groups[t or ""] if x is not None), default=None)
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(map(repr, out))


def corpus(seed):
    r = random.Random(seed)
    texts = [None, "", " ", "a", "A", "a ", "é", "é", "x" * 200_000] + [f"t{r.randint(0, 150)}" for _ in range(300)] + ["hot"] * 200
    r.shuffle(texts)
    rows = list(enumerate(texts))
    return rows + rows[5:8] + [(None, "alone"), (None, "a")]


@pytest.mark.parametrize("bits", [1 << 27, 1])
def test_equals_brute_force(spark, bits):
    rows = corpus(1)
    df = spark.createDataFrame([(i, t, 1, b"x", "s") for i, t in rows], "doc_id long, text string, n long, fp binary, salt string").repartition(4)
    got = exact_dedup(df, max_filter_bits=bits)
    assert sorted(repr(tuple(r)) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == brute_force(rows)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
