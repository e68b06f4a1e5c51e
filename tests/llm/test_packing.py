import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedwright.llm import chunks
from feedwright.llm.chunks import ChunkEncoder
from feedwright.llm.packing import LENGTH, Packer, Shard, Statistics, _read, pack_documents
from feedwright.llm.queries import QUERIES, tokenizer_path

PATH = tokenizer_path()
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def ids_of(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, 1]


def held(pieces, length=LENGTH):
    """Sequences are gapless and full, or as long as a power of two; the share of padding is none."""
    of = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        of.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in of.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or at < length and at & (at - 1) == 0
    return of


def whole(pieces):
    """The ids of each document, put together again: id -> list of rows' ids (rows may share an id)."""
    out = {}
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.doc_tokens, p.start)):
        out.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, np.frombuffer(p.ids, np.uint32).tolist()))
    return out


def test_chunks_equal_the_library(reference, monkeypatch):
    texts = ["", None, " ", "a  \n b", "x \n  b　\n c", "  x \x1c\n y", " <|endoftext|> x<|endoftext|>", "don't we'll\t\tgo\r\n  \r\n", "Ünïcode ßtraße 中文 字 🙂 1234", "a" * 5000, "word " * 3000 + "\n\n", "\n\n lead", "tail \n \n"]
    encoder = ChunkEncoder(_read(PATH))
    import pyarrow as pa

    for joined in (1, 3, 512):
        monkeypatch.setattr(chunks, "JOINED", joined)
        ids, at = encoder.encode_column(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [ids_of(reference, t)[:-1] for t in texts]
    assert encoder.encode_column(pa.array([], pa.string()))[1].tolist() == [0]


def test_bm25_scores_equal_the_formula():
    rng = np.random.Generator(np.random.PCG64(3))
    docs = [rng.integers(0, 50, rng.integers(1, 60)).astype(np.uint32) for _ in range(40)]
    df = np.array([sum(t in d for d in docs) for t in range(50)])
    mean = np.mean([len(d) for d in docs])
    stats = Statistics(40, mean, np.maximum(np.log((40 - df + 0.5) / (df + 0.5)), 0))
    shard = Shard(np.concatenate(docs), np.append(0, np.cumsum([len(d) for d in docs])), stats)
    for s in range(40):
        want = [sum(stats.idf[t] * 2.2 * n / (n + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in set(docs[s].tolist()) if (n := int((d == t).sum()))) for d in docs]
        assert np.allclose(shard.scores(shard.tokens(s)), want)


def test_a_window_is_filled_by_the_best_neighbours():
    base = np.arange(100, 130, dtype=np.uint32)
    other = np.arange(300, 330, dtype=np.uint32)
    docs = [base, other, np.append(base[:20], other[:10]), base[:29], other[5:], *[np.arange(1000 + 30 * i, 1030 + 30 * i, dtype=np.uint32) for i in range(15)]]
    offsets = np.append(0, np.cumsum([len(d) for d in docs]))
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=2000)
    stats = Statistics(len(docs), offsets[-1] / len(docs), np.maximum(np.log((len(docs) - df + 0.5) / (df + 0.5)), 0))
    packer = Packer(64, 1)
    packer.add([(i, len(d), 0) for i, d in enumerate(docs)], docs, stats)
    packer.end()
    first = sorted((p[6], p[0], p[2]) for p in packer.closed if p[5] == 1)
    assert first == [(0, 0, 30), (30, 3, 29), (59, 2, 5)]  # the nearest, then the next, cut; its rest is the next seed
    assert sorted((p[6], p[0], p[1]) for p in packer.closed if p[5] == 3)[0] == (0, 2, 5)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.Generator(np.random.PCG64(9))
    words = np.array([f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ren", "tos") for c in ("", "s", "en", "ly")])
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 300)))) for _ in range(120)] + ["copy of one text " * 30] * 60
    odd = [(None, None), (None, "no id"), (7, "same id, other text"), (7, "same id, other text"), (500, ""), (501, "a" * 40_000), (502, "long " * 9000), (503, "<|endoftext|>")]
    return [*enumerate(texts), *odd]


@pytest.mark.parametrize(("length", "shard"), [(LENGTH, 512), (64, 16), (1, 8)])
def test_every_id_is_in_one_piece(spark, reference, rows, length, shard, monkeypatch):
    from feedwright.llm import packing

    monkeypatch.setattr(packing, "TASK_TOKENS", 20_000)
    some = rows if length > 1 else rows[150:160]
    df = spark.createDataFrame(some, SCHEMA).withColumns({c: F.lit("x") for c in ("key", "tail", "window", "ids", "length", "near1")}).repartition(4)
    pieces = pack_documents(df, PATH, length, shard_docs=shard).collect()
    held(pieces, length)
    got = {}
    for (doc_id, n), parts in whole(pieces).items():
        starts = {}
        for start, ids in parts:
            starts.setdefault(start, []).append(ids)
        # Rows of one id and size: as many ids at each place as there are rows.
        got[doc_id, n] = sorted(t for start, many in starts.items() for ids in many for t in zip(range(start, start + len(ids)), ids, strict=True))
    want = {}
    for doc_id, text in some:
        ids = ids_of(reference, text)
        want.setdefault((doc_id, len(ids)), []).extend(enumerate(ids))
    assert got == {k: sorted(v) for k, v in want.items()}


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_query_on_whole_documents(spark, reference):
    docs = {r.doc_id: ids_of(reference, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op13_packing"](spark, "/root/testdata/sf0.001").collect()
    place = {d: 0 for d in docs}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == place[r.doc_id] and r.doc_tokens == len(docs[r.doc_id])
        part = docs[r.doc_id][r.start : r.start + r.length]
        place[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert place == {d: len(i) for d, i in docs.items()}


def test_like_documents_share_windows(spark):
    """Documents of ten subjects: more of a window's pairs share their subject than chance's tenth."""
    rng = np.random.Generator(np.random.PCG64(4))
    letters = np.array(list("bcdfghjklmnpqrstvwz"))
    subjects = [np.array(["".join(rng.choice(letters, 5)) for _ in range(60)]) for _ in range(10)]
    rows = [(i, " ".join(rng.choice(subjects[i % 10], 100))) for i in range(400)]
    pieces = pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH).collect()
    held(pieces)
    of = {}
    for p in pieces:
        of.setdefault(p.sequence_id, set()).add(p.doc_id)
    pairs = [(a, b) for docs in of.values() for a in docs for b in docs if a < b]
    assert np.mean([a % 10 == b % 10 for a, b in pairs]) > 0.6
