"""Repeated-phrase removal with sharded Aho-Corasick automata.

A word is removed if it lies in a window of `window` words that also starts
somewhere else in the corpus.  No pass gathers more than a bounded part of the
corpus in one place:

1. Anchors.  Of the short phrases in a window the one of least hash is its
   anchor, so equal windows have equal anchors.  Anchors that occur once are
   done with; the others set bits of a Bloom filter of bounded size.  Anchors
   in very many places set bits of a second one: their windows are counted one
   by one, and those that recur set bits of a third.
2. Passages.  Documents stream past the filters in slices.  A document without
   a window that may recur is finished.  In the others, neighbouring windows of
   one anchor are a passage, which is routed to the shard of its anchor, once
   per slice.  A window of a very frequent anchor is a passage of its own, and
   equal ones are combined before they reach their shard.
3. Location.  Each shard compiles the passages that its window hashes make
   likely to recur into one automaton over words and streams all its passages
   through it.  The matches decide: a window recurs if it is matched in two
   places or more, word by word; hashes only choose what is compiled.
4. Removal.  The slices get back which words of their passages are covered.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import discard, materialize, text_slices
from feedwright.llm.wordhash import flat_utf8, phrase_hashes, phrase_mask, word_hashes, word_spans

WINDOW = 35
ANCHOR = 12
#: Largest anchor filter that is collected and broadcast: 2**27 bits are 16 MB.
MAX_FILTER_BITS = 1 << 27
_ROW_BITS = 32768
#: Places from which on an anchor's windows are routed one by one.
HOT_PLACES = 5_000
#: Passage bytes that a shard is meant to hold, and bytes that a shuffled part is meant to hold.
SHARD_BYTES = 4_000_000
PART_BYTES = 12_000_000
#: Ways the answer to a very frequent window is dealt back.
SALTS = 16


def sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """op over x[i:i+width] for every i, in about log2(width) passes."""
    if len(x) < width:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x, span = op(x[:-span], x[span:]), span * 2
    rest = width - span
    return op(x[: len(x) - rest], x[rest:]) if rest else x


@dataclass
class Slice:
    """Words and windows of a few documents."""

    first: np.ndarray  # words of document d: first[d] : first[d+1]
    words: np.ndarray
    joined: bytes  # the words, each with one space behind it
    at: np.ndarray  # where each word starts in joined, and its length at the end
    starts: np.ndarray  # word positions where a whole window starts
    least: np.ndarray  # anchor of each such window
    anchors: np.ndarray  # hash of every phrase that is an anchor, once per place

    @classmethod
    def of(cls, column: pa.Array, window: int, anchor: int) -> Slice:
        data, offsets = flat_utf8(column)
        begin, end, first = word_spans(data, offsets)
        words = word_hashes(data, begin, end)
        lens = end - begin + 1
        at = np.r_[0, np.cumsum(lens)]
        joined = np.append(data, np.uint8(0x20))[np.arange(at[-1]) + np.repeat(begin - at[:-1], lens)]
        joined[at[1:] - 1] = 0x20
        short, width = phrase_hashes(words, anchor), window - anchor + 1
        whole = phrase_mask(first, window, len(words))
        least = sliding(np.minimum, short, width)[: len(whole)]
        # A phrase is an anchor if it is the least of some window around it: the largest of the
        # minima around it, among whole windows, then is the phrase itself.
        inside = np.zeros(len(short) + width - 1, np.uint64)
        inside[width - 1 : width - 1 + len(least)] = np.where(whole, least, 0)
        around = sliding(np.maximum, inside, width)
        return cls(first, words, joined.tobytes(), at, np.flatnonzero(whole), least[whole], short[(around == short) & (around > 0)])

    def text(self, a: int, b: int) -> bytes:
        """Words a to b, joined by one space."""
        return self.joined[self.at[a] : self.at[b] - 1] if b > a else b""

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1


@dataclass
class Filters:
    """Bits of recurring anchors, of very frequent ones, and of recurring windows of the latter."""

    anchors: np.ndarray
    hot: np.ndarray
    windows: np.ndarray

    @staticmethod
    def has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(bits):
            return np.zeros(len(values), bool)
        at = values & np.uint64(8 * len(bits) - 1)
        return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def candidates(self, part: Slice, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into part.starts, alone): the windows that may recur, and which of them go alone."""
        may, hot = self.has(self.anchors, part.least), self.has(self.hot, part.least)
        if hot.any():
            may &= ~hot | self.has(self.windows, phrase_hashes(part.words, window)[part.starts])
        chosen = np.flatnonzero(may)
        return chosen, hot[chosen]


def bitmap_of(values: DataFrame, max_bits: int) -> np.ndarray:
    """Bloom filter bytes, at most max_bits / 8 of them, over the only column of values; none without values."""
    name, n, bits = values.columns[0], values.count(), _ROW_BITS
    if not n:
        return np.zeros(0, np.uint8)
    while bits < 16 * n and bits < max_bits:
        bits *= 2
    position = F.col(name).bitwiseAND(F.lit(bits - 1))
    rows = values.groupBy(F.shiftright(position, 15).alias("slot")).agg(F.bitmap_construct_agg(position.bitwiseAND(F.lit(_ROW_BITS - 1))).alias("bitmap"))
    out = np.zeros((bits // _ROW_BITS, _ROW_BITS // 8), np.uint8)
    for row in rows.toLocalIterator():
        out[row.slot] = np.frombuffer(row.bitmap, np.uint8)
    return out.ravel()


def _counted(values_of, docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(value, n > 1): what values_of(slice) gives more than once in all of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            found, n = np.unique(values_of(Slice.of(part.column("text"), window, anchor)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["value", "n"])

    return materialize(docs.select("text").mapInArrow(run, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")).where("n > 1"), "recurring")


def filters(docs: DataFrame, window: int, anchor: int, max_bits: int, hot_places: int) -> Filters:
    recurring = _counted(lambda part: part.anchors, docs, window, anchor)
    anchors, hot = bitmap_of(recurring.select("value"), max_bits), bitmap_of(recurring.where(F.col("n") >= hot_places).select("value"), max_bits)
    discard(recurring)
    windows = np.zeros(0, np.uint8)
    if len(hot):
        shared = docs.sparkSession.sparkContext.broadcast(hot)
        recurring = _counted(lambda part: phrase_hashes(part.words, window)[part.starts[Filters.has(shared.value, part.least)]], docs, window, anchor)
        windows = bitmap_of(recurring.select("value"), max_bits)
        discard(recurring)
    return Filters(anchors, hot, windows)


_STREAMED = "kind int, chunk binary, doc_id long, n_words long, sha string, text binary, places binary, no int, shard long, alone boolean, many boolean"


def _batch(fields: str, **columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    n = len(next(iter(columns.values())))
    names = [f.split() for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in names],
        [name for name, _ in names],
    )


def passages(part: Slice, known: Filters, window: int):
    """(first word, end, anchor or window hash, alone) of the passages of a slice."""
    chosen, alone = known.candidates(part, window)
    starts, key = part.starts[chosen], part.least[chosen]
    if alone.any():
        key = np.where(alone, phrase_hashes(part.words, window)[starts], key)
    new = (np.diff(starts) > 1) | (key[1:] != key[:-1]) | alone[1:] | alone[:-1] | (np.diff(part.documents(starts)) > 0)
    opens = np.flatnonzero(np.r_[len(starts) > 0, new])
    closes = np.r_[opens[1:], len(starts)] - 1 if len(opens) else opens
    return starts[opens], starts[closes] + window, key[opens], alone[opens]


def covered_words(texts: list[bytes], many: np.ndarray, window: int, hash_bits: int = 64) -> list[np.ndarray]:
    """For each passage which of its words lie in a window that is matched twice or more.

    many: passages that stand for several places.  Window hashes of hash_bits bits choose what
    is compiled; only words are matched, so their number changes no result."""
    import ahocorasick

    data, offsets = flat_utf8(pa.array(texts, pa.binary()).cast(pa.string()))
    begin, end, first = word_spans(data, offsets)
    words = word_hashes(data, begin, end)
    numbers = np.unique(words, return_inverse=True)[1]
    starts = np.flatnonzero(phrase_mask(first, window, len(words)))
    hashes = phrase_hashes(words, window)[starts] >> np.uint64(64 - hash_bits)
    of = np.searchsorted(first, starts, side="right") - 1
    weight = np.where(many, 2, 1)
    inverse = np.unique(hashes, return_inverse=True)[1]
    starts = starts[np.bincount(inverse, weight[of])[inverse] > 1.5] if len(starts) else starts
    of = np.searchsorted(first, starts, side="right") - 1
    covered = np.zeros(len(words) + 1, np.int64)
    stride, some = window, [(i, tuple(numbers[first[i] : first[i + 1]].tolist())) for i in np.unique(of).tolist()]
    opens = np.flatnonzero(np.r_[len(starts) > 0, (np.diff(starts) > 1) | (np.diff(of) > 0)])
    closes = np.r_[opens[1:], len(starts)] - 1 if len(opens) else opens
    while some:
        compiled: dict[tuple, int] = {}
        for a, b in zip(starts[opens].tolist(), starts[closes].tolist(), strict=True):
            for s in (*range(a, b, stride), b):  # these windows cover the run
                compiled.setdefault(tuple(numbers[s : s + window].tolist()), len(compiled))
        automaton, n = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE), len(compiled)
        for phrase, i in compiled.items():
            automaton.add_word(phrase, i)
        automaton.make_automaton()
        at, which, passage = [], [], []
        for i, text in some:
            found = list(automaton.iter(text))
            at += [e + int(first[i]) + 1 for e, _ in found]
            which += [w for _, w in found]
            passage += [i] * len(found)
        at, which = np.array(at, np.int64), np.array(which, np.int64)
        times = np.bincount(which, weight[passage], n) if len(which) else np.zeros(n)
        if stride > 1 and (times < 1.5).any():
            stride = 1  # two windows share a hash but not their words: every window is matched
            continue
        at = at[times[which] > 1.5]
        np.add.at(covered, at - window, 1)
        np.add.at(covered, at, -1)
        break
    gone = np.cumsum(covered[:-1]) > 0
    return [gone[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def substring_dedup(
    df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
    max_filter_bits: int = MAX_FILTER_BITS, with_text: bool = False, hot_places: int = HOT_PLACES, hash_bits: int = 64,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row.

    Words are the runs of characters other than space and the controls 9 to 13,
    unchanged; null counts as a text without words.  A word goes if a window of
    `window` words around it starts anywhere else too, in the same document or
    another; repeated rows are other documents.  Texts shorter than a window
    keep all their words; a text of any length is one row's work.  Windows are
    judged on the input, not on what is left.  Rows keep their number and ids,
    null ids included; other columns are ignored.  An empty table gives an empty
    result.  hot_places and hash_bits shape the work, not the result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(filters(docs, window, anchor, max_filter_bits, hot_places))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "text"):
            part = Slice.of(rows.column("text"), window, anchor)
            begin, end, key, alone = passages(part, shared.value, window)
            ids, n_words = rows.column("doc_id").to_pylist(), np.diff(part.first).tolist()
            of, chunk = part.documents(begin), uuid.uuid4().bytes
            hit = np.zeros(rows.num_rows, bool)
            hit[of] = True
            whole = [part.text(a, b) for a, b in zip(part.first[:-1].tolist(), part.first[1:].tolist(), strict=True)]
            done, open_ = np.flatnonzero(~hit).tolist(), np.flatnonzero(hit).tolist()
            yield _batch(_STREAMED, kind=[0] * len(done), doc_id=[ids[i] for i in done], n_words=[n_words[i] for i in done],
                         sha=[hashlib.sha256(whole[i]).hexdigest() for i in done], **({"text": [whole[i] for i in done]} if with_text else {}))
            if not open_:
                continue
            # Equal passages of a slice are sent once; each document knows where it has which.
            numbers: dict[tuple, int] = {}
            no = np.array([numbers.setdefault((k, part.text(a, b)), len(numbers)) for k, a, b in zip(key.tolist(), begin.tolist(), end.tolist(), strict=True)], np.int64)
            place = np.stack([begin - part.first[of], no], 1).astype(np.int32)
            cuts = np.searchsorted(of, [*open_, rows.num_rows]).tolist()
            yield _batch(_STREAMED, kind=[1] * len(open_), chunk=[chunk] * len(open_), doc_id=[ids[i] for i in open_], n_words=[n_words[i] for i in open_],
                         text=[whole[i] for i in open_], places=[place[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
            once = np.unique(no, return_index=True)[1]
            yield _batch(_STREAMED, kind=[2] * len(once), chunk=[chunk] * len(once), text=[t for _, t in numbers], no=range(len(once)),
                         shard=key[once].view(np.int64), alone=alone[once], many=np.bincount(no) > 1)

    found = materialize(docs.mapInArrow(stream, _STREAMED), "phrases")
    sizes = {r.kind: r.bytes for r in found.groupBy("kind").agg(F.sum(F.length("text")).alias("bytes")).collect()}
    n_shards = max(256, 2 * (sizes.get(2) or 0) // SHARD_BYTES)
    parts = lambda kind: max(8, (sizes.get(kind) or 0) // PART_BYTES)
    sent = found.where("kind = 2").withColumn("shard", F.pmod("shard", F.lit(n_shards)))
    together = sent.where("NOT alone").select("shard", "chunk", "no", "many", "text")
    single = sent.where("alone").groupBy("text").agg(F.first("shard").alias("shard"), (F.sum(F.when(F.col("many"), 2).otherwise(1)) > 1).alias("many"))
    gathered = together.unionByName(single.where("many"), allowMissingColumns=True)

    def locate(shard: pa.Table) -> pa.Table:
        texts = shard.column("text").to_pylist()
        gone = covered_words(texts, shard.column("many").to_numpy().astype(bool), window, hash_bits)
        hit = [i for i, g in enumerate(gone) if g.any()]
        chunks, numbers = shard.column("chunk").to_pylist(), shard.column("no").to_pylist()
        return pa.table({
            "chunk": pa.array([chunks[i] for i in hit], pa.binary()), "no": pa.array([numbers[i] for i in hit], pa.int32()),
            "text": pa.array([texts[i] if chunks[i] is None else None for i in hit], pa.binary()),
            "gone": pa.array([np.packbits(gone[i]).tobytes() for i in hit], pa.binary())})

    located = gathered.repartition(parts(2), "shard").groupBy("shard").applyInArrow(locate, "chunk binary, no int, text binary, gone binary")
    located = materialize(located, "located")
    # A very frequent window's answer goes back in salted parts.
    dealt = located.where("chunk IS NULL").select("text", "gone", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    uses = sent.where("alone").select("text", "chunk", "no", F.pmod(F.xxhash64("chunk"), F.lit(SALTS)).cast("int").alias("salt"))
    replies = located.where("chunk IS NOT NULL").select("chunk", "no", "gone").unionByName(uses.join(dealt, ["text", "salt"]).select("chunk", "no", "gone"))

    result = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def remove(texts: pa.Table, said: pa.Table) -> pa.Table:
        bits = dict(zip(said.column("no").to_pylist(), said.column("gone").to_pylist(), strict=True))
        out: dict[str, list] = {"n_removed": [], "kept_sha256": [], "kept_text": []}
        for text, n, places in zip(texts.column("text").to_pylist(), texts.column("n_words").to_pylist(), texts.column("places").to_pylist(), strict=True):
            lost = np.zeros(n + 8, bool)
            for at, no in np.frombuffer(places, np.int32).reshape(-1, 2).tolist():
                if no in bits:
                    of = np.unpackbits(np.frombuffer(bits[no], np.uint8)).astype(bool)
                    lost[at : at + len(of)] |= of[: n + 8 - at]
            kept = b" ".join([w for w, g in zip(text.split(b" "), lost.tolist()) if not g]) if lost.any() else text
            out["n_removed"].append(int(lost.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept_text"].append(kept.decode())
        return pa.Table.from_batches([_batch(result, doc_id=texts.column("doc_id").to_pylist(), n_words=texts.column("n_words").to_pylist(), **out)])

    n = parts(1)
    cleaned = (
        found.where("kind = 1").select("chunk", "doc_id", "n_words", "text", "places").repartition(n, "chunk").groupBy("chunk")
        .cogroup(replies.repartition(n, "chunk").groupBy("chunk")).applyInArrow(remove, result)
    )
    finished = found.where("kind = 0").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"),
        *([F.col("text").cast("string").alias("kept_text")] if with_text else []),
    )
    return finished.unionByName(cleaned)
