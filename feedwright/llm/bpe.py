"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pre-token of n symbols has n-1 adjacent pairs.  The leaves of a segment tree
hold their keys (rank, position), or infinity where a pair has no merge; every
inner node holds the smaller of its children, so the root is the leftmost pair
of lowest rank.  A merge changes three leaves, each repaired in logarithmic
time, and encoding ends when the root is infinite.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import bounded_batches, text_slices

#: The split of byte-level BPE pre-tokenisation (a fixed value of the format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens whose ids a worker remembers; it starts anew when full.
CACHE_ENTRIES = 400_000
#: Longer pre-tokens are encoded but not remembered.
CACHE_LENGTH = 64
#: More than any key (rank times length plus position) of a text that fits in memory.
_INFINITE = 1 << 62
#: From this length on the tree is packed: eight bytes a node instead of an object.
PACKED_LENGTH = 10_000


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


@dataclass(frozen=True)
class Vocabulary:
    """first: id of each single byte; merges: pair of ids -> (rank, id); surface: bytes of each id."""

    first: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    surface: list[bytes]
    special: dict[str, int]

    @classmethod
    def from_json(cls, text: str) -> Vocabulary:
        spec = json.loads(text)
        stand_in, ids = byte_symbols(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        surface = [b""] * (1 + max([*ids.values(), *special.values()]))
        for token, i in ids.items():
            surface[i] = bytes(stand_in[c] for c in token)
        for token, i in special.items():
            surface[i] = token.encode()
        first = [0] * 256
        for c, b in stand_in.items():
            first[b] = ids[c]
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges[ids[a], ids[b]] = rank, ids[a + b]
        return cls(first, merges, surface, special)


def merge_all(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols left when no adjacent pair can be merged."""
    n = len(symbols)
    if n < 2:
        return symbols
    get = merges.get
    width = 1 << (n - 2).bit_length()
    pack = (lambda items: array("q", items)) if n >= PACKED_LENGTH else list
    tree = pack([_INFINITE]) * (2 * width)
    at = width
    for pair in zip(symbols, symbols[1:], strict=False):
        if found := get(pair):
            tree[at] = found[0] * n + at - width
        at += 1
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    following, before = pack(range(1, n + 1)), pack(range(-1, n - 1))

    def put(leaf: int, key: int) -> None:
        i = width + leaf
        if tree[i] == key:
            return
        tree[i] = key
        while i > 1:
            other = tree[i ^ 1]
            key = key if key < other else other
            i >>= 1
            if tree[i] == key:
                return
            tree[i] = key

    while (root := tree[1]) != _INFINITE:
        i = root % n
        j = following[i]
        k = following[j]
        symbols[i] = get((symbols[i], symbols[j]))[1]
        symbols[j] = -1
        following[i] = k
        if j < n - 1:
            put(j, _INFINITE)
        if k < n:
            before[k] = i
            found = get((symbols[i], symbols[k]))
            put(i, found[0] * n + i if found else _INFINITE)
        else:
            put(i, _INFINITE)
        if i:
            h = before[i]
            found = get((symbols[h], symbols[i]))
            put(h, found[0] * n + h if found else _INFINITE)
    return [s for s in symbols if s >= 0]


class PairTable:
    """The merges as sorted arrays: rank and new id of many pairs in one search."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = len(vocabulary.surface)
        keys = np.array([a * self.size + b for a, b in vocabulary.merges] or [-1], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in vocabulary.merges.values()] or [0], np.int64)[order]
        self.merged = np.array([i for _, i in vocabulary.merges.values()] or [0], np.int64)
        self.none = np.int64(len(keys) + 1)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, `none` where there is no merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)


def merge_many(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> np.ndarray:
    """merge_all() for many short rows at once: row r has lengths[r] symbols, and
    symbols.shape[1] is a power of two.  One segment tree per row, all in one
    array; each turn merges the root pair of every row that still has one.
    Returns the symbols with -1 where a merge swallowed one.
    """
    n_rows, width = symbols.shape
    none = table.none * width
    tree = np.full((n_rows, 2 * width), none, np.int64)
    places = np.arange(width)
    ranks = table.rank(symbols[:, :-1], symbols[:, 1:])
    inside = places[1:] < lengths[:, None]
    tree[:, width : 2 * width - 1] = np.where(inside & (ranks < table.none), ranks * width + places[:-1], none)
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    following = np.tile(np.arange(1, width + 1), (n_rows, 1))
    before = np.tile(np.arange(-1, width - 1), (n_rows, 1))
    flat, flat_symbols, flat_next, flat_before = tree.ravel(), symbols.ravel(), following.ravel(), before.ravel()

    def put(row: np.ndarray, leaf: np.ndarray, key: np.ndarray) -> None:
        base, i = row * (2 * width), width + leaf
        flat[base + i] = key
        for _ in range(width.bit_length() - 1):
            i >>= 1
            flat[base + i] = np.minimum(flat[base + 2 * i], flat[base + 2 * i + 1])

    def key_of(a: np.ndarray, b: np.ndarray, leaf: np.ndarray, there: np.ndarray) -> np.ndarray:
        rank = table.rank(a, b)
        return np.where(there & (rank < table.none), rank * width + leaf, none)

    row = np.arange(n_rows)
    while True:
        root = flat[row * (2 * width) + 1]
        row, root = row[root < none], root[root < none]
        if not len(row):
            return symbols
        base, i = row * width, root % width
        merged = table.merged[root // width]
        j = flat_next[base + i]
        k = flat_next[base + j]
        more = k < lengths[row]
        kk = np.where(more, k, 0)
        flat_symbols[base + i] = merged
        flat_symbols[base + j] = -1
        flat_next[base + i] = k
        flat_before[(base + kk)[more]] = i[more]
        put(row, j, np.full(len(row), none))
        put(row, i, key_of(merged, flat_symbols[base + kk], i, more))
        left = i > 0
        r, p = row[left], i[left]
        h = flat_before[base[left] + p]
        put(r, h, key_of(flat_symbols[base[left] + h], merged[left], h, np.ones(len(r), bool)))


class Encoder:
    """Text to ids and back; remembers the ids of short pre-tokens."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.vocabulary = vocabulary
        self._split = regex.compile(SPLIT).findall
        special = sorted(vocabulary.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._digits = [str(i) for i in range(len(vocabulary.surface))]
        self._first = np.array(vocabulary.first, np.int64)
        self._pairs = PairTable(vocabulary)
        self._memory: dict[str, bytes] = {}

    def _learn(self, tokens: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens that aren't remembered; short ones are, the others are returned."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        long = {}
        for token in tokens:
            raw = token.encode()
            if len(raw) > CACHE_LENGTH:
                ids = merge_all([self.vocabulary.first[b] for b in raw], self.vocabulary.merges)
                long[token] = np.array(ids, np.uint32).tobytes()
            else:
                by_width.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append((token, raw))
        for width, group in by_width.items():
            for at in range(0, len(group), 8192):
                part = group[at : at + 8192]
                lengths = np.array([len(raw) for _, raw in part])
                filled = np.frombuffer(b"".join(raw.ljust(width, b"\0") for _, raw in part), np.uint8)
                symbols = self._first[filled].reshape(len(part), width)
                symbols[np.arange(width) >= lengths[:, None]] = -1
                symbols = merge_many(symbols, lengths, self._pairs)
                kept = symbols >= 0
                blob = symbols[kept].astype(np.uint32).tobytes()
                ends = np.cumsum(kept.sum(1)) * 4
                begin = 0
                for (token, _), end in zip(part, ends.tolist(), strict=True):
                    self._memory[token] = blob[begin:end]
                    begin = end
        return long

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        if len(self._memory) > CACHE_ENTRIES:
            self._memory.clear()
        special = self.vocabulary.special
        pieces = []
        for text in texts:
            parts = self._special.split(text) if self._special and self._special.search(text) else [text]
            pieces.append([part if i % 2 else self._split(part) for i, part in enumerate(parts)])
        words = set().union(*(p for parts in pieces for p in parts[::2]))
        look_up = self._memory
        if long := self._learn(words.difference(look_up)):
            look_up = {w: long.get(w) or self._memory[w] for w in words}
        find = look_up.__getitem__
        out = []
        for parts in pieces:
            blobs = [
                np.uint32(special[part]).tobytes() if i % 2 else b"".join(map(find, part)) for i, part in enumerate(parts)
            ]
            out.append(np.frombuffer(b"".join(blobs), np.uint32).tolist())
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.vocabulary.surface.__getitem__, ids)).decode("utf-8", "replace")

    def written(self, ids: list[int]) -> str:
        return ",".join(map(self._digits.__getitem__, ids))


_encoders: dict[int, Encoder] = {}


def encoder_for(spec: str) -> Encoder:
    """One encoder for each vocabulary and worker process; it outlives the task."""
    key = hash(spec)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary.from_json(spec))
    return _encoders[key]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_column(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>: the ids of every whole text; null counts as empty and has no ids."""
    spec = df.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(spec.value)
        for part in text_slices(batches, "text"):
            ids = encoder.encode_batch([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = bounded_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode_column(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the decoded text of every array of ids; a null array gives a null text."""
    spec = df.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(spec.value)
        for batch in batches:
            texts = [None if i is None else encoder.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = bounded_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, in one pass without a shuffle.

    Whole texts are encoded and decoded again; null counts as empty.  Rows keep
    their number and ids, repeated and null ones too; other columns are ignored.
    """
    spec = df.sparkSession.sparkContext.broadcast(_read(path))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(spec.value)
        for batch in text_slices(batches, "text"):
            counts, coded, decoded = [], [], []
            for ids in encoder.encode_batch([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids))
                coded.append(digest(encoder.written(ids)))
                decoded.append(digest(encoder.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = bounded_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
