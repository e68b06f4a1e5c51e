"""Documents packed into training sequences beside documents of like words.

Documents are tokenised and cut into whole windows and a tail.  Tails are dealt
by range of a weighted min-hash of their tokens, so that like ones meet; each
run of SHARD_DOCS tails becomes a shard of a BM25 index.  A seed's unused
neighbours, the best first, fill its window; the last one is cut where the
window ends, and its rest is the next seed.  What a shard leaves open the next
one fills; what a task leaves open at its end is cut into powers of two, so
nothing is padded.

The terms of the index are token ids, so its document frequencies, counted over
all tails, are a table of the vocabulary's size, whatever the corpus holds.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.chunks import ChunkEncoder
from feedwright.llm.common import materialize, text_slices

#: Tokens of a sequence.
LENGTH = 2048
#: The id that ends a document.
END_ID = 1
#: Tails of one shard of the index.
SHARD_DOCS = 512
#: Tail tokens that a packing task gets, about.
TASK_TOKENS = 4_000_000
#: BM25's saturation and weight of lengths.
K1, B = 1.2, 0.75
ENCODE_BYTES = 4_000_000

_ENCODED = "key long, doc_id long, doc_tokens long, start long, length long, sequence_id long, window binary, tail binary"
_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_encoders: dict[int, ChunkEncoder] = {}


def _encoder(spec: str) -> ChunkEncoder:
    key = hash(spec)
    if key not in _encoders:
        _encoders.clear()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are what runs side by side
        _encoders[key] = ChunkEncoder(spec)
    return _encoders[key]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _binary(data: np.ndarray, edges: np.ndarray, valid: np.ndarray) -> pa.Array:
    """The ids between following edges as bytes; null where not valid (those are empty)."""
    offsets = (edges * 4).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(valid), [pa.py_buffer(np.packbits(valid, bitorder="little")), pa.py_buffer(offsets), pa.py_buffer(data)])


def windows_and_tails(df: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document's ids, the ending one included: whole windows, each a sequence of its own, and
    a shorter tail if one is left.  Ids are little-endian unsigned 32-bit integers; `key` tells rows apart."""
    spec = df.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, done = _encoder(spec.value), TaskContext.get().partitionId() << 32
        for part in text_slices(batches, "text", ENCODE_BYTES):
            ids, ends = encoder.encode_column(part.column("text"))
            n = part.num_rows
            ids, sizes = np.insert(ids, ends[1:], end_id), np.diff(ends) + 1
            pieces = -(-sizes // length)
            row = np.repeat(np.arange(n), pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
            cut = np.minimum(sizes[row] - start, length)
            whole = cut == length
            number = np.where(whole, 2 * (done + np.cumsum(whole)), -1)
            done += int(whole.sum())
            columns = [part.column(c).take(pa.array(row)) for c in ("key", "doc_id")] + [pa.array(x) for x in (sizes[row], start, cut)]
            columns.append(pa.array(number, mask=~whole))
            for kind in (whole, ~whole):
                taken = ids[np.repeat(kind, cut)]
                columns.append(_binary(taken, np.append(0, np.cumsum(np.where(kind, cut, 0))), kind))
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _ENCODED.split(", ")])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", F.monotonically_increasing_id())
    return rows.mapInArrow(run, _ENCODED)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column and n + 1 offsets."""
    blobs = column.to_pylist()
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    return np.frombuffer(b"".join(blobs), np.uint32), np.append(0, np.cumsum(sizes))


def _distinct(ids: np.ndarray, offsets: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token, count), sorted by both."""
    key, n = np.unique(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) * vocabulary + ids, return_counts=True)
    return key // vocabulary, key % vocabulary, n


@dataclass(frozen=True)
class Statistics:
    """Of all tails: how many there are, their mean length, and each token's weight by document frequency."""

    docs: int
    mean: float
    idf: np.ndarray

    @classmethod
    def of(cls, tails: DataFrame, vocabulary: int) -> Statistics:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, totals = np.zeros(vocabulary, np.int64), np.zeros(2, np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, SHARD_DOCS):
                    ids, offsets = _flat(batch.column(0).slice(at, SHARD_DOCS))
                    held += np.bincount(_distinct(ids, offsets, vocabulary)[1], minlength=vocabulary)
                    totals += (len(offsets) - 1, len(ids))
            token = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(np.append([-2, -1], token)), pa.array(np.append(totals, held[token]))], ["token", "n"])

        # A row per token of the vocabulary and two more: bounded by the tokenizer.
        found = {r.token: r.n for r in tails.select("tail").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()}
        docs, tokens = found.pop(-2, 0), found.pop(-1, 0)
        df = np.zeros(vocabulary)
        df[list(found)] = list(found.values())
        # Tokens in half of the documents or more tell nothing: their weight would not be positive.
        return cls(docs, tokens / max(docs, 1), np.maximum(np.log((docs - df + 0.5) / (df + 0.5)), 0))


def signed(tails: DataFrame, stats: Statistics) -> DataFrame:
    """tails with `near1`, `near2`: two min-hashes of their tokens, weighted by document frequency; the first is
    shared by two tails as often as their weighted sets are alike."""
    vocabulary = len(stats.idf)
    rng = np.random.Generator(np.random.PCG64(17))
    with np.errstate(divide="ignore"):
        ranks = np.argsort(np.argsort(rng.exponential(size=(2, vocabulary)) / stats.idf, axis=1), axis=1).astype(np.int32)
    shared = tails.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD_DOCS):
                part = batch.slice(at, SHARD_DOCS)
                ids, offsets = _flat(part.column("tail"))
                near = [pa.array(np.minimum.reduceat(r[ids], offsets[:-1])) for r in shared.value]
                yield pa.RecordBatch.from_arrays([*part.columns, *near], [*part.schema.names, "near1", "near2"])

    kept = tails.select("key", "doc_id", "doc_tokens", "start", "tail")
    return kept.mapInArrow(run, "key long, doc_id long, doc_tokens long, start long, tail binary, near1 int, near2 int")


class Shard:
    """A BM25 index of some tails: the postings of each token, with their weights."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, stats: Statistics):
        vocabulary = len(stats.idf)
        self.n = len(offsets) - 1
        doc, token, count = _distinct(ids, offsets, vocabulary)
        telling = stats.idf[token] > 0
        doc, token, count = doc[telling], token[telling], count[telling]
        self._token, self._first = token, np.searchsorted(doc, np.arange(self.n + 1))
        size = np.diff(offsets)[doc] / stats.mean
        weight = stats.idf[token] * count * (K1 + 1) / (count + K1 * (1 - B + B * size))
        by_token = np.argsort(token, kind="stable")
        self._doc, self._weight = doc[by_token], weight[by_token]
        self._begin = np.append(0, np.cumsum(np.bincount(token, minlength=vocabulary)))

    def tokens(self, doc: int) -> np.ndarray:
        return self._token[self._first[doc] : self._first[doc + 1]]

    def scores(self, tokens: np.ndarray) -> np.ndarray:
        """The BM25 score of each tail for these different tokens."""
        begin, n = self._begin[tokens], self._begin[tokens + 1] - self._begin[tokens]
        ends = np.cumsum(n)
        at = np.repeat(begin - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self._doc[at], self._weight[at], self.n)


@dataclass
class Packer:
    """Fills windows shard by shard; `room` tokens are left in the open one, and `query` are its seed's tokens."""

    length: int
    sequence: int
    room: int = 0
    query: np.ndarray | None = None
    open: list[tuple] = field(default_factory=list)
    closed: list[tuple] = field(default_factory=list)

    def _put(self, row: tuple, ids: np.ndarray, at: int) -> int:
        """Put ids[at:] of a tail into the window as far as they fit; where the rest begins."""
        take = min(len(ids) - at, self.room)
        doc_id, doc_tokens, start = row
        self.open.append((doc_id, start + at, ids[at : at + take], doc_tokens))
        self.room -= take
        if not self.room:
            self._close(self.open)
            self.open, self.query = [], None
        return at + take

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.closed.append((doc_id, start, len(ids), ids.tobytes(), doc_tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 2

    def add(self, rows: list[tuple], tails: list[np.ndarray], stats: Statistics) -> None:
        offsets = np.append(0, np.cumsum([len(t) for t in tails]))
        shard = Shard(np.concatenate(tails), offsets, stats)
        unused, first = np.ones(shard.n, bool), 0
        seed = None  # a tail that was cut, and where its rest begins
        while seed or unused.any():
            if self.query is None:
                if seed is None:
                    while not unused[first]:
                        first += 1
                    unused[first] = False
                    seed = first, 0
                doc, at = seed
                self.room, self.query = self.length, shard.tokens(doc)
                at = self._put(rows[doc], tails[doc], at)
                seed = (doc, at) if at < len(tails[doc]) else None
                continue
            near = np.flatnonzero(unused)
            for doc in near[np.argsort(-shard.scores(self.query)[near], kind="stable")]:
                unused[doc] = False
                at = self._put(rows[doc], tails[doc], 0)
                if self.query is None:
                    seed = (doc, at) if at < len(tails[doc]) else None
                    break

    def end(self) -> None:
        """Cut the open window into sequences whose lengths are powers of two."""
        while self.open:
            size = 1 << (sum(len(p[2]) for p in self.open).bit_length() - 1)
            taken, self.open, rest = [], [], self.open
            for doc_id, start, ids, doc_tokens in rest:
                if k := min(size, len(ids)):
                    taken.append((doc_id, start, ids[:k], doc_tokens))
                    size -= k
                if k < len(ids):
                    self.open.append((doc_id, start + k, ids[k:], doc_tokens))
            self._close(taken)

    def batch(self) -> pa.RecordBatch:
        names = [f.split()[0] for f in _PIECES.split(", ")]
        types = [pa.binary() if c == "ids" else pa.int64() for c in names]
        columns = list(zip(*self.closed, strict=True)) or [()] * len(names)
        self.closed = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def packed_tails(tails: DataFrame, stats: Statistics, parts: int, length: int = LENGTH, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pieces of sequences made of tails (key, doc_id, doc_tokens, start, tail), which are shorter than `length`."""
    shared = tails.sparkSession.sparkContext.broadcast(stats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, 2 * (TaskContext.get().partitionId() << 32) + 1)
        rows: list[tuple] = []
        ids: list[np.ndarray] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "start", "tail")]
            for doc_id, doc_tokens, start, tail in zip(*columns, strict=True):
                rows.append((doc_id, doc_tokens, start))
                ids.append(np.frombuffer(tail, np.uint32))
                if len(rows) == shard_docs:
                    packer.add(rows, ids, shared.value)
                    rows, ids = [], []
                    yield packer.batch()
        if rows:
            packer.add(rows, ids, shared.value)
        packer.end()
        yield packer.batch()

    near = signed(tails, stats)
    return near.repartitionByRange(parts, "near1", "near2", "key").sortWithinPartitions("near1", "near2", "key").mapInArrow(run, _PIECES)


def pack_documents(df: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: a row for each piece of a document.

    df: doc_id, text; other columns are ignored.  A document's ids are those of the tokenizer at `path`, special
    tokens in the text included, then `end_id`; a null text counts as empty and has that id alone.  `start` counts
    the document's ids before the piece, `offset` those of its sequence; `ids` are little-endian unsigned 32-bit
    integers.  Each id is in exactly one piece.  Sequences have `length` ids, or fewer by a power of two where a
    task ends.

    Rows stay apart where ids are repeated or null, and repeated rows are packed each; an empty table has no pieces.
    Texts of any length are encoded whole.  A group of equal tails is dealt out by row, so no task gets more than its
    share.  The packing of one evaluation is whole; another may number and cut sequences differently, so write the
    result before it is used twice.
    """
    encoded = materialize(windows_and_tails(df, path, length, end_id), "encoded")
    tails = encoded.where("tail IS NOT NULL")
    stats = Statistics.of(tails, max(_encoder(_read(path)).size, end_id + 1))
    parts = max(1, round(stats.docs * stats.mean / TASK_TOKENS))
    names = [f.split()[0] for f in _PIECES.split(", ")]
    whole = encoded.where("window IS NOT NULL").select("doc_id", "start", "length", F.col("window").alias("ids"), "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    return whole.select(*names).union(packed_tails(tails, stats, parts, length, shard_docs))
