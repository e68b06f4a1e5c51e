"""Token ids of whole Arrow columns as the tokenizers library gives them: each distinct chunk of a slice is encoded once.

A text can be cut before any white space that follows something else: no
pre-token stands on both sides, and each side's pre-tokens are the same as in
the whole.  The chunks of a slice lie one after another in its buffer, so they
are an Arrow array without a copy.  Its distinct chunks are encoded many at a
time, joined again; the bytes of the tokens tell which belong to which chunk,
and one gather gives all ids.  Texts with special tokens or white space beyond
ASCII are encoded whole.  The tokenizer is a byte-level one: a character of a
token in its vocabulary stands for a byte.  Where its ids follow the order of
its merges, tiktoken, which knows just that kind, encodes the joined chunks.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedwright.llm.bpe import SPLIT, byte_symbols
from feedwright.llm.wordhash import flat_utf8

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space of the pre-tokeniser that isn't one of these bytes.
_ODD_SPACE = "\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
#: Chunks that are encoded as one text.
JOINED = 512


def _parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat_utf8(array)
    return np.ascontiguousarray(data), offsets


def ranked(spec: str):
    """tiktoken's form of a byte-level tokenizer; None where its ids don't follow the order of its merges."""
    import tiktoken

    model, stand_in = json.loads(spec)["model"], byte_symbols()
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    order = [model["vocab"][t] for t in merged]
    single = [t for t in model["vocab"] if len(t) == 1]
    if len(single) != 256 or order != sorted(set(order)) or order and order[0] <= max(model["vocab"][t] for t in single):
        return None
    ranks = {bytes(stand_in[c] for c in t): model["vocab"][t] for t in (*single, *merged)}
    return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        self._ranked = ranked(spec)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.size = 1 + max(vocabulary.values())
        self._bytes = np.zeros(self.size, np.int64)
        self._bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        special = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._whole = "|".join([f"[{_ODD_SPACE}]", *special])

    def _encode(self, texts: list[str], plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the number of each); plain: they have no special tokens."""
        if plain and self._ranked:
            found = [np.array(self._ranked.encode_ordinary(t), np.uint32) for t in texts]
        else:
            found = [np.array(e.ids, np.uint32) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array(list(map(len, found)), np.int64)

    def _encode_joined(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks that begin with white space and don't end with it."""
        data, offsets = _parts(chunks)
        at = range(0, len(chunks), JOINED)
        ids, _ = self._encode([data[offsets[i] : offsets[min(i + JOINED, len(chunks))]].tobytes().decode() for i in at], True)
        ends = np.searchsorted(np.cumsum(self._bytes[ids]), offsets[1:]) + 1
        return ids, np.diff(ends, prepend=0)

    def _encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = _parts(chunks)
        joined = _SPACE[data[offsets[:-1]]] & ~_SPACE[data[offsets[1:] - 1]]
        ids, begin, sizes = np.zeros(0, np.uint32), np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        for those, encode in ((joined, self._encode_joined), (~joined, lambda c: self._encode(c.to_pylist()))):
            more, n = encode(chunks.filter(pa.array(those)))
            begin[those], sizes[those] = len(ids) + np.cumsum(n) - n, n
            ids = np.concatenate([ids, more])
        return ids, np.stack([begin, sizes])

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = _parts(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        space = _SPACE[data]
        space[1:] &= ~space[:-1]
        space[offsets[:-1][offsets[:-1] < len(data)]] = True
        edges = np.append(np.flatnonzero(space), len(data))
        chunks = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
        distinct, (begin, sizes) = self._encode_chunks(chunks.dictionary)
        of = chunks.indices.to_numpy()
        n = sizes[of]
        ends = np.cumsum(n)
        ids = distinct[np.repeat(begin[of] - (ends - n), n) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.searchsorted(edges, offsets)]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n + 1 offsets into them); null counts as empty."""
        column = column.fill_null("")
        odd = pc.match_substring_regex(column, self._whole).to_numpy(zero_copy_only=False)
        ids, offsets = self._plain(column.filter(pa.array(~odd)) if odd.any() else column)
        if not odd.any():
            return ids, offsets
        whole, n = self._encode(column.filter(pa.array(odd)).to_pylist())
        sizes = np.zeros(len(column), np.int64)
        sizes[odd], sizes[~odd] = n, np.diff(offsets)
        out = np.zeros(sizes.sum(), np.uint32)
        kind = np.repeat(odd, sizes)
        out[kind], out[~kind] = whole, ids
        return out, np.append(0, np.cumsum(sizes))
