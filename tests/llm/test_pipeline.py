from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from feedwright.llm.common import materialize, table  # noqa: E402
from tests.llm.test_jaccard_join import brute_force as near_brute_force  # noqa: E402
from tests.llm.test_line_dedup import brute_force as lines_brute_force  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SF), name))
    return docs


def test_columns(steps):
    assert all(sorted(d.columns) == sorted(steps[0].columns) for d in steps[:-1])


def test_toxicity_keeps_clean_documents(spark, steps):
    kept = {r.doc_id for r in steps[1].collect()}
    clean = {r.doc_id for r in table(spark, SF, "labels").where("toxic = 0").collect()}
    assert clean <= kept and {tuple(r) for r in steps[1].collect()} <= {tuple(r) for r in steps[0].collect()}


def test_lines_equal_brute_force(steps):
    want = lines_brute_force(sorted((r.doc_id, r.text) for r in steps[1].collect()))
    assert {r.doc_id: r.text for r in steps[2].collect()} == {k: v[0] for k, v in want.items()}
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_copies_equal_brute_force(steps):
    want = near_brute_force(sorted((r.doc_id, r.text) for r in steps[2].collect()))
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(k for k, (label, _) in want.items() if label == k)


def test_mixing_uses_every_document(steps):
    before = {r.doc_id: tuple(r) for r in steps[3].collect()}
    after = Counter(tuple(r) for r in steps[4].collect())
    assert set(after) == set(before.values()) and max(after.values()) <= 2


def test_tokens_equal_the_library(spark, steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in steps[4].collect())
    assert Counter((r.doc_id, r.n_tokens) for r in steps[5].collect()) == want
    assert corpus_pipeline.run(spark, SF).count() == steps[5].count()
