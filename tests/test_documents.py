"""Checkpoint documents against state rows; outlets side by side."""

import time

import pytest
from pyspark.sql import functions as F

from feedwright.operators import documents, state
from feedwright.plans.jobs import run_concurrently, summary
from feedwright.sources import registry

STATE = "outlet_id string, section string, link string, title string, updated_at string"
ROWS = [
    ("a", None, "https://x/g", "G", "2024-01-02"), ("a", "s", "", None, "2024-01-01"), ("a", "t", None, None, "2024-01-01"),
    ("b", None, "https://x/g", "G", "2024-01-01"), ("b", "s", "https://X/g/", "G", "2024-01-01"), ("b", "t", "https://x/g?q", "G", "2024-01-01"), ("b", "u", "https://x/u", "U", "2024-01-03"),
    ("c", "s", "https://x/s", "S", "2024-01-01"), ("d", None, "https://x/d", "D", "2024-01-01"), ("e", None, None, None, None), ("f", None, "https://x/f", "F", "2024-01-01"), ("f", "s", "https://x/f", "F", "2024-01-01"),
]
KEYS = ("s", "t")


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, STATE)


def plain(df):
    return sorted((r.outlet_id, str(r.section), r.link or "") for r in df.collect() if r.section is None or r.link)


def test_documents_do_what_rows_do(spark, rows):
    docs = documents.documents_of(rows)
    assert docs.count() == 6 and plain(state.state_rows(docs)) == sorted([*plain(rows), ("c", "None", "")])
    outlets = rows.select("outlet_id").distinct()
    keys = outlets.crossJoin(spark.createDataFrame([("s",), ("t",)], "section string"))
    own = ("c", "None", "")  # a document has a place for its own link even where no row had one
    for of_docs, of_rows in ((documents.migrated(docs, F.array(*map(F.lit, KEYS))), state.migrate_global(rows, keys)), (documents.cleared(docs), state.clear_global_bleed(rows)), (documents.pruned(docs, F.array(*map(F.lit, KEYS))), state.prune_sections(rows, keys))):
        assert plain(state.state_rows(of_docs)) == sorted([*plain(of_rows), own])
    boots = {r.outlet_id: r.bootstrap for r in documents.bootstraps(docs, F.array(*map(F.lit, KEYS))).collect()}
    assert boots == {r.outlet_id: r.bootstrap for r in state.is_bootstrap(rows).collect()} == {"a": True, "b": False, "c": False, "d": True, "e": True, "f": False}


def test_merging_keeps_what_is_not_given(spark, rows):
    new = documents.documents_of(spark.createDataFrame([("a", "s", "https://x/new", "N", "2024-05-01"), ("a", None, "", None, "2024-05-01"), ("c", "s", "", None, "2024-05-01"), ("z", None, "https://x/z", "Z", "2024-05-01")], STATE))
    got = {r.outlet_id: r for r in documents.merged(documents.documents_of(rows), new).collect()}
    assert got["a"].last_scraped_link == "https://x/g" and got["a"].sections["s"].last_scraped_link == "https://x/new" and got["a"].updated_at == "2024-05-01"
    assert got["c"].sections["s"].last_scraped_link == "https://x/s" and got["c"].updated_at == "2024-01-01"
    assert got["z"].last_scraped_link == "https://x/z" and got["b"].sections["u"].last_scraped_title == "U" and len(got) == 7


def test_documents_are_written_one_by_one(spark, rows, tmp_path):
    docs = documents.documents_of(rows)
    documents.write_documents(docs, str(tmp_path))
    assert plain(state.state_rows(documents.read_documents(spark, str(tmp_path)))) == plain(state.state_rows(docs))
    was = {f: f.stat().st_mtime_ns for f in tmp_path.glob("outlet_id=*/*.txt")}
    assert len(was) == 6
    documents.write_documents(docs.where("outlet_id = 'a'").withColumn("last_scraped_link", F.lit("https://x/h")), str(tmp_path))
    assert sum(f.exists() and f.stat().st_mtime_ns == t for f, t in was.items()) == 5
    assert {r.outlet_id: r.last_scraped_link for r in documents.read_documents(spark, str(tmp_path)).collect()}["a"] == "https://x/h"


def test_one_outlet_hangs_one_fails_and_the_others_finish(spark):
    hang = F.udf(lambda x: time.sleep(120) or x, "long")

    def run(outlet):
        if outlet.id == "aruna":
            return spark.range(1).select(hang("id")).agg(F.sum("<lambda>(id)")).first()[0]
        if outlet.id == "island":
            raise OSError("no page")
        return spark.range(len(outlet.id)).count()

    began = time.monotonic()
    outcomes = run_concurrently(spark, registry.OUTLETS, run, timeout=8)
    assert time.monotonic() - began < 60 and [o.outlet_id for o in outcomes] == [o.id for o in registry.OUTLETS]
    ok, failed, code = summary(outcomes)
    assert len(ok) == 15 and sorted(failed) == ["aruna", "island"] and code == 1
    assert all(o.count == len(o.outlet_id) for o in outcomes if o.error is None)
    assert next(o.error for o in outcomes if o.outlet_id == "aruna").startswith("TimeoutError")
