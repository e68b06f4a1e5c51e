"""Keyed tables under competition, replay and failure; archives; counts of a write."""

import threading

import pytest
from pyspark.sql import functions as F

from feedwright.sources import sinks
from feedwright.sources.keyed import KeyedTable
from feedwright.streaming import stream

SCHEMA = "url string, v int"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, f"file://{tmp_path}/t", SCHEMA, "url", ("v",), buckets=4)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def held(table):
    return sorted(map(tuple, table.read().collect()))


def files(tmp_path):
    return {str(f.relative_to(tmp_path)) for f in (tmp_path / "t").rglob("*.parquet")}


def test_last_row_stands_whatever_the_sequence(spark, table):
    assert held(table) == []
    table.upsert(rows(spark, ("a", 2), ("a", 1), ("b", 1), (None, 9)), "one", 0)
    table.upsert(rows(spark, ("a", 1), ("b", 3), ("c", None)), "two", 0)
    assert held(table) == [("a", 2), ("b", 3), ("c", None)]


def test_a_writer_that_began_before_another_loses_nothing(spark, table, monkeypatch):
    """A prepares its batch, B commits between, then A commits: both are there."""
    other, inner = KeyedTable(spark, table.path, SCHEMA, "url", ("v",), buckets=4), table._write

    def late(rows_, writer):
        other.upsert(rows(spark, ("b", 1), ("x", 5)), "B", 0)
        inner(rows_, writer)

    monkeypatch.setattr(table, "_write", late)
    table.upsert(rows(spark, ("a", 1), ("x", 3)), "A", 0)
    assert held(other) == [("a", 1), ("b", 1), ("x", 5)]


def test_writers_side_by_side(spark, table):
    failed = []

    def work(name):
        try:
            for n in range(4):
                table.upsert(rows(spark, *((f"{name}{n}-{i}", n) for i in range(20)), ("shared", n * 10 + ord(name))), name, n)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(name,)) for name in "ABC"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    got = dict(held(table))
    assert len(got) == 3 * 4 * 20 + 1 and got["shared"] == 30 + ord("C")


def test_a_batch_touches_its_own_buckets_and_replay_changes_nothing(spark, table, tmp_path):
    table.upsert(rows(spark, *((f"k{i}", 0) for i in range(40))), "w", 0)
    before = files(tmp_path)
    table.upsert(rows(spark, ("k1", 7)), "w", 1)
    after = files(tmp_path)
    assert before < after and len(after - before) == 1
    want = held(table)
    table.upsert(rows(spark, ("k1", 7)), "w", 1)
    assert held(table) == want and before < files(tmp_path) and len(files(tmp_path)) == len(after)


def test_compaction_keeps_every_row(spark, table, tmp_path, monkeypatch):
    for n in range(3):
        table.upsert(rows(spark, ("hot", n), *((f"k{n}-{i}", n) for i in range(10))), "w", n)
    want = held(table)
    monkeypatch.setattr(KeyedTable, "_at", _failing_delete(KeyedTable._at))
    with pytest.raises(OSError):
        table.compact(least=2)
    monkeypatch.undo()
    assert held(table) == want  # stored twice, read once
    assert table.compact(least=2) and held(table) == want
    assert all(len(names) == 1 for names in table.folders().values())
    table.upsert(rows(spark, ("hot", 1), ("hot2", 1)), "w", 1)  # replayed late, with an older row
    assert dict(held(table))["hot"] == 2
    assert table.compact(least=99) == []


def _failing_delete(at):
    class Fs:
        def __init__(self, fs):
            self.fs = fs

        def delete(self, *_):
            raise OSError("lost")

        def __getattr__(self, name):
            return getattr(self.fs, name)

    return lambda self, name: (lambda path, fs: (path, Fs(fs)))(*at(self, name))


def test_an_order_is_required(spark, tmp_path):
    with pytest.raises(ValueError, match="order"):
        KeyedTable(spark, str(tmp_path), SCHEMA, "url", ())
    with pytest.raises(ValueError, match="order"):
        sinks.last_by_key(rows(spark, ("a", 1)), "url", ())


def test_stream_replay_changes_nothing(spark, tmp_path):
    from feedwright.functions.text import normalize_link

    source, schema = tmp_path / "in", "url string, v int, at timestamp"
    source.mkdir()
    (source / "1.json").write_text('{"url": "https://X/a?1", "v": 1, "at": "2026-01-01T00:00:00"}\n{"url": "https://x/a", "v": 2, "at": "2026-01-01T01:00:00"}\n')
    table, seen = KeyedTable(spark, f"file://{tmp_path}/t", schema, "url", ("v",)), []

    def run(progress):
        feed = spark.readStream.schema(schema).json(str(source)).withColumn("url", normalize_link(F.col("url")))
        stream.run_once(spark, stream.upsert_batches(feed, table, progress, str(tmp_path / progress), after=lambda b, i: seen.append(i)))
        return sorted((r.url, r.v) for r in table.read().collect())

    assert run("p") == [("https://x/a", 2)]
    assert run("p") == [("https://x/a", 2)] and seen == [0]
    (source / "2.json").write_text('{"url": "https://x/b", "v": 5, "at": "2026-01-02T00:00:00"}\n')
    assert run("p") == [("https://x/a", 2), ("https://x/b", 5)]
    was = files(tmp_path)
    assert run("other") == [("https://x/a", 2), ("https://x/b", 5)] and was < files(tmp_path)


def test_delta_and_archive(spark, tmp_path):
    schema = "outlet_id string, pos int, link string"
    for batch in ([("o", 0, "https://x/a"), ("o", 1, "https://x/b"), ("p", 0, "https://y/1")], [("o", 0, "https://x/c"), ("o", 1, "https://x/a/")]):
        sinks.write_delta_and_archive(spark.createDataFrame(batch, schema), f"file://{tmp_path}", limit=3)

    def links(target, outlet):
        return [r.link for r in spark.read.schema(schema).parquet(f"{tmp_path}/{target}").where(F.col("outlet_id") == outlet).orderBy("pos").collect()]

    assert links("delta", "o") == ["https://x/c", "https://x/a/"] and links("delta", "p") == ["https://y/1"]
    assert links("archive", "o") == ["https://x/c", "https://x/a/", "https://x/b"] and links("archive", "p") == ["https://y/1"]


def test_counts_come_with_the_write(spark, tmp_path):
    articles = spark.createDataFrame([(f"u{i % 4}", i) for i in range(10)], SCHEMA)
    keep = lambda rows_: rows_.where("url <> 'u3'").dropDuplicates(["url"])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "audit")
    assert sinks.written_and_counted(articles, keep, lambda r: r.write.parquet(f"{tmp_path}/out")) == (10, 3)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3 and sinks.audit_counts(articles, keep) == (10, 3)
    assert tracker.getJobIdsForGroup("audit")
    spark.sparkContext.setJobGroup("", "")
